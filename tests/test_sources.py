"""CSV (both dialects, malformed line, timestamp rebuild), JSON messages with
a sentinel and a broken line, and log analytics, on generated fixtures."""
import datetime
import os

from pyspark.sql import functions as F

from flowlens.operators import clean, logs, star
from flowlens.sources import csv as C
from flowlens.sources import logs as LS
from flowlens.sources import messages as M

STD = ("Source IP, Source Port, Destination IP, Destination Port, Protocol, Timestamp, Flow Duration, "
       "Total Fwd Packets, Total Backward Packets, Total Length of Fwd Packets, "
       "Total Length of Bwd Packets, Flow Bytes/s, Flow Packets/s, Label")
ALT = ("Src IP dec,Src Port,Dst IP dec,Dst Port,Protocol,Timestamp,Flow Duration,Total Fwd Packet,"
       "Total Bwd packets,Total Length of Fwd Packet,Total Length of Bwd Packet,Flow Bytes/s,"
       "Flow Packets/s,Label")


def test_csv_two_dialects_and_malformed_line(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "wednesday.csv"), "w") as f:
        f.write(STD + "\n")
        f.write("192.168.1.1,12345,10.0.0.1,80,6,5/7/2017 8:42,1000,10,5,100,50,100.0,10.0,BENIGN\n")
        f.write("192.168.1.2,12345,10.0.0.1,80,6,5/7/2017 8:43,1000,10,5,100,50,Infinity,10.0,DoS Hulk\n")
        f.write("192.168.1.3,1,10.0.0.1,80,6,5/7/2017 8:44,1,1,1,1,1,1,1,BENIGN,EXTRA,FIELDS\n")
        f.write("192.168.1.4,12345,10.0.0.1,80,,5/7/2017 8:45,1000,10,5,100,50,1.0,1.0,\n")
    with open(os.path.join(tmpdir_path, "thursday.csv"), "w") as f:
        f.write(ALT + "\n")
        f.write("3232235777,1,167772161,443,17,6/7/2017 9:00,5,1,1,1,1,1.0,1.0,PortScan\n")
        f.write(",1,167772161,443,x,6/7/2017 9:01,5,1,1,1,1,1.0,1.0,Bot\n")
    raw = C.read_flows(spark, tmpdir_path)
    ev = clean.clean_flows(raw)
    rows = {r.label: r for r in ev.collect()}
    by_id = [r.label for r in sorted(rows.values(), key=lambda r: r.event_id)]
    assert by_id == ["PortScan", "Bot", "BENIGN", "DoS Hulk"] and rows["PortScan"].event_id == 0
    dim = {r.attack_label: r.description for r in star.dim_attack(ev).collect()}
    assert dim["BENIGN"] and dim["DoS Hulk"] and dim["Bot"]   # seeds win
    assert set(rows) == {"BENIGN", "DoS Hulk", "PortScan", "Bot"}   # over-long line and null label gone
    assert rows["DoS Hulk"].flow_bytes_per_sec == 0.0
    assert rows["DoS Hulk"].timestamp == datetime.datetime(2017, 7, 5, 8, 43)
    assert rows["PortScan"].source_ip == "192.168.1.1" and rows["PortScan"].protocol == "UDP"
    assert rows["Bot"].source_ip == "0.0.0.0" and rows["Bot"].protocol == "OTHER"


def test_infinity_and_nan_in_any_number(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "monday.csv"), "w") as f:
        f.write(STD + "\n")
        f.write("1.1.1.1,1,2.2.2.2,80,NaN,3/7/2017 8:42,Infinity,NaN,-Infinity,5,6,NaN,1.0,BENIGN\n")
        f.write('"1.1.1.1",1,"2.2.2.2",80,6,3/7/2017 8:43,1,1,1,5,6,1.0,1.0,"a, b"\n')
    a, b = clean.clean_flows(C.read_flows(spark, tmpdir_path)).orderBy("event_id").collect()
    assert (a.protocol, a.flow_duration, a.fwd_packets, a.bwd_packets, a.fwd_bytes) == ("HOPOPT", 0, 0, 0, 5)
    assert a.flow_bytes_per_sec == 0.0 and b.label == "a, b"


def test_timestamp_rebuild_per_chunk(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "tuesday.csv"), "w") as f:
        f.write(STD + "\n")
        for i in range(7):
            f.write(f"10.0.0.{i},1,10.0.0.9,80,6,01:0{i}.5,1,1,1,1,1,1.0,1.0,BENIGN\n")
    raw = C.read_flows(spark, tmpdir_path, ["tuesday.csv"]).drop("_ip_format")
    ev = clean.clean_flows(raw, chunk_size=4).orderBy("source_ip").collect()
    ts = [r.timestamp for r in ev]
    day = datetime.datetime(2017, 7, 4)
    # chunk 1: 4 rows over 08:00..17:00 (every 3 h), chunk 2: 3 rows (every 4.5 h)
    assert ts[:4] == [day + datetime.timedelta(hours=h) for h in (8, 11, 14, 17)]
    assert ts[4:] == [day + datetime.timedelta(hours=h) for h in (8, 12.5, 17)]


def test_line_numbers_distributed(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "monday.csv")
    with open(p, "w") as f:
        f.write(STD + "\n")
        for i in range(5000):
            f.write(f"10.0.{i // 256}.{i % 256},1,10.0.0.9,80,6,5/7/2017 8:42,{i},1,1,1,1,1.0,1.0,BENIGN\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        raw = C.read_flows(spark, tmpdir_path, ["monday.csv"])
        got = raw.select(F.col("line_no"), F.col("flow_duration").cast("long").alias("d")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.line_no == r.d for r in got) and len(got) == 5000


def test_headers_of_many_files_in_one_job(spark, tmpdir_path):
    """As many jobs for forty files as for two; an empty file is passed over."""
    sc, jobs = spark.sparkContext, {}
    for n in (2, 40):
        folder = os.path.join(tmpdir_path, str(n))
        os.mkdir(folder)
        open(os.path.join(folder, "empty.csv"), "w").close()
        for i in range(n):
            head, address = (STD, "1.1.1.1") if i % 2 else (ALT, "16843009")
            with open(os.path.join(folder, f"f{i:02d}.csv"), "w") as f:
                f.write(f"{head}\n{address},1,{address},80,6,3/7/2017 8:42,{i},1,1,5,6,1.0,1.0,BENIGN\n")
        sc.setJobGroup(f"headers-{n}", "")
        raw = C.read_flows(spark, folder)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"headers-{n}"))
        sc.setJobGroup("rest", "")
        got = clean.clean_flows(raw).orderBy("event_id").collect()
        assert [(r.flow_duration, r.source_ip) for r in got] == [(i, "1.1.1.1") for i in range(n)]
    assert jobs[2] == jobs[40] <= 3


def test_written_flows_are_read_again(spark, tmpdir_path):
    stamp = datetime.datetime(2017, 7, 3, 8, 42, 5)
    kinds = "src_ip_raw bigint, src_port int, dst_ip_raw bigint, dst_port int, protocol_raw string, ts_raw timestamp_ntz, " \
            "flow_duration bigint, fwd_packets int, bwd_packets int, fwd_bytes bigint, bwd_bytes bigint, " \
            "flow_bytes_per_sec double, flow_packets_per_sec double, label_raw string"
    rows = [(16843009, 70000, 0, 80, "x", stamp, 5, 1, 2, 3, 4, float("inf"), 0.1, "a, \"b\" c"),
            (4294967295, 1, 16843009, 80, None, stamp, 6, 1, 2, 3, 4, 1e-7, 1e300, "BENIGN")]
    raw = spark.createDataFrame(rows, kinds)
    want = clean.clean_flows(raw.withColumn("event_id", F.lit(0)), ip_format="decimal").drop("event_id")
    for dialect in C.DIALECTS:
        C.write_flows(raw, f"{tmpdir_path}/{dialect}", dialect)
        got = clean.clean_flows(C.read_flows(spark, f"{tmpdir_path}/{dialect}")).drop("event_id")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), dialect


def test_messages_sentinel_and_dead_letters(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "events.jsonl")
    good = ('{"source_ip":"1.1.1.1","source_port":1,"destination_ip":"2.2.2.2","destination_port":80,'
            '"protocol":"TCP","timestamp":"2017-07-05T10:30:00Z","flow_duration":5000,"fwd_packets":10,'
            '"bwd_packets":5,"fwd_bytes":100,"bwd_bytes":50,"flow_bytes_per_sec":100.5,'
            '"flow_packets_per_sec":10.0,"label":"DoS Hulk","attack_category":"DoS","severity":"HIGH",'
            '"source_country":"China","source_region":"Asia"}')
    with open(p, "w") as f:
        f.write(good + "\n")
        f.write("{broken json\n")
        f.write('{"_sentinel":"END_OF_STREAM","total_records":1}\n')
    parsed = M.read_messages(spark, p)
    assert M.good_events(parsed).count() == 1
    dl = M.dead_letters(parsed).collect()
    assert len(dl) == 1 and dl[0]._error == "not a JSON object"
    ev = M.good_events(parsed).first()
    assert ev.timestamp == datetime.datetime(2017, 7, 5, 10, 30)


def test_message_stream(spark, tables, tmpdir_path):
    from flowlens.streaming import fanout
    source, base = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    M.write_messages(tables["events"], source)
    with open(f"{source}/part-last.txt", "w") as f:
        f.write('{broken json\n{"_sentinel":"END_OF_STREAM","total_records":1}\n')
    q = fanout.fanout_stream(M.stream_messages(spark, source, 3), base, f"{tmpdir_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    fact = spark.read.parquet(f"{base}/fact_network_event")
    assert fact.count() == tables["events"].count() == fact.select("event_id").distinct().count()
    assert [r.value for r in spark.read.parquet(f"{base}/parse_dead_letters").collect()] == ["{broken json"]


def test_messages_sent_again_count_once(spark, tables, tmpdir_path):
    """Every message sent twice, into different batches and over a restart; equal
    flows with ids of their own, messages without an id and broken lines stay."""
    from flowlens.streaming import fanout
    source, base = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    events = tables["events"].limit(300).persist()
    equal = events.limit(1).withColumn("event_id", F.lit(-1).cast("bigint"))  # another flow of the same values
    keyed = M.to_message(events.unionByName(equal), "event_id").select("value").coalesce(2).persist()
    plain = M.to_message(equal).select("value").coalesce(1)

    def run():
        stream = M.counted_once(M.stream_messages(spark, source, 2), "2 hours")
        fanout.fanout_stream(stream, base, f"{tmpdir_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{base}/fact_network_event").count()

    keyed.write.mode("append").text(source)
    keyed.write.mode("append").text(source)
    assert run() == 301
    keyed.write.mode("append").text(source)
    plain.unionByName(plain).coalesce(1).write.mode("append").text(source)
    spark.createDataFrame([("{broken",), ("{broken",)], "value string").coalesce(1).write.mode("append").text(source)
    assert run() == 303 and spark.read.parquet(f"{base}/parse_dead_letters").count() == 2
    counts = {r.model: (r.n_rows, r.n_events) for r in fanout.model_counts(spark, base).collect()}
    assert counts["documents"] == (303, 303) and counts["e_attacked"][1] == counts["doc_hourly_summary"][1] == 303
    assert counts["dim_source"] == (events.select("source_ip", "source_port").distinct().count(), None)


def test_logs(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "producer.log"), "w") as f:
        for i in range(10):
            f.write(f"2024-01-01 00:00:{i:02d},123 [producer] INFO: sent {i}\n")
        f.write("junk line\n")
    with open(os.path.join(tmpdir_path, "consumer.log"), "w") as f:
        f.write("2024-01-01 00:00:30,000 [consumer] ERROR: failed\n")
        f.write("2024-01-01 00:00:31,000 [consumer] WARNING: slow\n")
    lines = LS.read_logs(spark, tmpdir_path)
    parsed = logs.parse_logs(lines)
    assert parsed.count() == 12
    tail = logs.tail_per_service(lines, 3).filter(F.col("service") == "producer").collect()
    assert len(tail) == 3 and any(r.line == "junk line" for r in tail)
    merged = logs.merged_logs(lines, 3).collect()
    assert [r.message for r in merged][0] == "slow"
    only = logs.merged_logs(lines, 200, service="consumer").collect()
    assert {r.service for r in only} == {"consumer"}
    lv = {(r.service, r.level): r["count"] for r in logs.log_level_counts(lines).collect()}
    assert lv[("producer", "INFO")] == 10 and lv[("consumer", "ERROR")] == 1


def test_text_stays_with_broken_lines_alone(spark, tmpdir_path):
    """A stored stream has the text of the lines that don't parse; a sentinel counts however it is escaped."""
    good = '{"timestamp":"2024-01-01T00:00:00","label":"BENIGN","source_ip":"END_OF_STREAM"}'
    end = ['{"_sentinel":"END_OF_STREAM"}', '{"_sentinel":"END\\u005fOF_STREAM"}', '{"_sentinel" : "END_OF_STREAM", "total_records":1}']
    spark.createDataFrame([(v,) for v in [good, "broken", *end]], "value string").write.text(f"{tmpdir_path}/in")
    got = M.store_stream(M.stream_messages(spark, f"{tmpdir_path}/in"), f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
    assert sorted((r.value or "", r._parse_error or "", r.label or "") for r in got.collect()) == \
        [("", "", "BENIGN"), ("broken", "not a JSON object", "")]
