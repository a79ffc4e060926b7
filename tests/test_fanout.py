"""foreachBatch fan-out into every model, keyed change upserts and pull
queries; replaying a batch id does not duplicate rows."""
import collections
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowlens.functions import lookups as L
from flowlens.operators import incremental, star, summaries, upsert
from flowlens.streaming import aggregates as A
from flowlens.streaming import fanout

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def rows_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_fanout_all_models_and_replay(spark, tables, tmpdir_path):
    from flowlens.operators import clean
    from flowlens.sources import adapter
    raw = adapter.events_to_raw_flows(
        spark.readStream.schema(A.RAW_EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 1).parquet(SF_SMALL))
    stream = clean.clean_flows(raw, ip_format="decimal")
    base = os.path.join(tmpdir_path, "wh")
    q = fanout.fanout_stream(stream, base, os.path.join(tmpdir_path, "ck"), trusted_lookups=True) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    fact = spark.read.parquet(f"{base}/fact_network_event")
    assert fact.count() == tables["fact_network_event"].count()
    assert spark.read.parquet(f"{base}/dead_letters").count() == tables["rejected"].count()
    assert spark.read.parquet(f"{base}/documents").count() == tables["documents"].count()
    merged = fanout.merged_edges(spark, base, "e_attacked", ["src_ip", "dst_ip"])
    cols = ["src_ip", "dst_ip", "count", "total_bytes", "first_seen", "last_seen"]
    assert rows(merged.select(*cols)) == rows(tables["e_attacked"].select(*cols))
    for name in fanout.FIRST_WINS:
        got = fanout.merged_first(spark, base, name)
        assert rows_text(got.select(*tables[name].columns)) == rows_text(tables[name]), name
    hourly = fanout.merged_hourly_documents(spark, base)
    assert rows_text(hourly.select(*tables["doc_hourly_summary"].columns)) == rows_text(tables["doc_hourly_summary"])
    assert set(fanout.refresh_summaries(spark, base, 7).values()) == {"ok"}
    for name in summaries.BUILDERS:
        got = incremental.current_summary(spark, f"{base}/summaries", name)
        assert rows_text(got.select(*tables[name].columns)) == rows_text(tables[name]), name
    # replay of batch 0: same directory is overwritten, nothing is duplicated
    batch = stream.sparkSession.read.parquet(SF_SMALL + "/events.parquet")
    again = clean.clean_flows(adapter.events_to_raw_flows(batch), ip_format="decimal")
    status = fanout.write_models(again, 0, base, trusted_lookups=True)
    assert set(status.values()) == {"ok"}
    assert spark.read.parquet(f"{base}/fact_network_event").count() == tables["fact_network_event"].count()


def test_emit_changes_and_pull_query(spark, tables, tmpdir_path):
    stream = A.stream_flow_events_from_table(spark, SF_SMALL)
    agg = A.attack_rate_1min(stream)
    path = os.path.join(tmpdir_path, "attack_rate")
    q = A.emit_changes_to_table(agg, path, ["attack_category", "window_start"],
                                os.path.join(tmpdir_path, "ck2")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = A.pull_query(spark, path)
    want = A.attack_rate_1min(tables["events"])
    cols = ["attack_category", "event_count", "window_start", "window_end"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_first_batch_decides_a_dimension(spark, tmpdir_path):
    for batch, country in ((0, "A"), (1, "B")):
        spark.createDataFrame([(1, country), (batch + 2, country)], "source_key bigint, country string") \
            .write.parquet(f"{tmpdir_path}/dim_source/batch_id={batch}")
    assert rows(fanout.merged_first(spark, tmpdir_path, "dim_source")) == [(1, "A"), (2, "A"), (3, "B")]


def test_summaries_are_refreshed_in_the_stream(spark, tables, tmpdir_path):
    tables["events"].write.parquet(f"{tmpdir_path}/in")
    stream = spark.readStream.schema(tables["events"].schema).parquet(f"{tmpdir_path}/in")
    fanout.fanout_stream(stream, f"{tmpdir_path}/wh", f"{tmpdir_path}/ck", refresh=summaries.RefreshPolicy(1)) \
        .trigger(availableNow=True).start().awaitTermination()
    got = incremental.current_summary(spark, f"{tmpdir_path}/wh/summaries", "summary_protocol_daily")
    assert rows_text(got.select(*tables["summary_protocol_daily"].columns)) == rows_text(tables["summary_protocol_daily"])


def test_endpoint_keys_are_exact(spark):
    df = spark.createDataFrame([("0.0.0.0", 0), ("255.255.255.255", 65535), ("10.1.2.3", 443), ("1.2.3", 5),
                                ("1.2.3.4", 65536), (None, 1), ("1.2.3.4", None)], "ip string, port int")
    k = df.withColumn("k", star.endpoint_key("ip", "port"))
    got = [tuple(r) for r in k.select("k", star.endpoint_ip("k"), star.endpoint_port("k")).where("k is not null").collect()]
    assert got == [(0, "0.0.0.0", 0), ((2**32 - 1) * 65536 + 65535, "255.255.255.255", 65535),
                   ((10 * 2**24 + 2**16 + 2 * 256 + 3) * 65536 + 443, "10.1.2.3", 443)]
    assert k.where("k is null").count() == 4


def test_top_sources_against_brute_force(spark, tables):
    """A tie of labels goes to the smaller one; targets are end points."""
    day, a, b = F.to_timestamp_ntz(F.lit("2024-01-02 03:04:05")), "10.0.0.1", "10.0.0.2"
    say = [(1, a, 5, b, 80, "PortScan"), (2, a, 5, b, 80, "PortScan"), (3, a, 6, b, 81, "DoS Hulk"),
           (4, a, 6, b, 82, "DoS Hulk"), (5, a, 7, b, 80, "BENIGN"), (6, b, 5, a, 80, "BENIGN")]
    one = tables["events"].limit(1).drop("event_id", "source_ip", "source_port", "destination_ip", "destination_port",
                                         "label", "attack_category", "source_country", "timestamp")
    ev = spark.createDataFrame(say, "event_id bigint, source_ip string, source_port int, destination_ip string, "
                                    "destination_port int, label string") \
        .withColumn("attack_category", F.when(F.col("label") == "BENIGN", "Normal").otherwise("DoS")) \
        .withColumn("source_country", F.lit("X")).withColumn("timestamp", day).crossJoin(one)
    from flowlens.plans import model
    got = model.tables_from_events(ev, validated=True)["summary_top_sources"].collect()
    got = {r.source_ip: (r.attack_count, r.distinct_targets, r.primary_attack) for r in got}
    assert got == {a: (4, 3, "DoS Hulk"), b: (0, 1, "BENIGN")}


def test_replace_by_key_replaces(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    incoming = spark.createDataFrame([("b", 5), ("c", 7)], "k string, v int")
    assert rows(upsert.replace_by_key(stored, incoming, ["k"])) == [("a", 1), ("b", 5), ("c", 7)]
    assert rows(upsert.insert_new_keys(stored, incoming, ["k"])) == [("a", 1), ("b", 2), ("c", 7)]


def test_summaries_from_batches_alone(spark, tables, tmpdir_path, monkeypatch):
    """Three batches that touch the same days, a batch of one day, a failing
    summary and a failing refresh: always equal to the batch summaries of what
    has come in, and no day is written that no new batch touches."""
    base = f"{tmpdir_path}/summaries"
    fact = tables["fact_network_event"].persist()
    last = fact.agg(F.max(summaries.day_of_key())).first()[0]
    batch = F.when(summaries.day_of_key() == F.lit(last), 3).otherwise(F.pmod(F.xxhash64("event_id"), F.lit(3))).cast("int")
    facts = fact.withColumn("batch_id", batch).persist()
    dims = {n: tables[n] for n in ("dim_source", "dim_attack", "dim_protocol", "dim_destination", "dim_time")}

    def check(upto):
        want = dict(dims, fact_network_event=facts.filter(F.col("batch_id") <= upto).drop("batch_id"))
        for name, build in summaries.BUILDERS.items():
            got, one = incremental.current_summary(spark, base, name), build(want)
            assert got.select(*one.columns).dtypes == one.dtypes and rows_text(got.select(*one.columns)) == rows_text(one), (name, upto)

    assert set(incremental.refresh_all(dims, facts, base, 0).values()) == {"ok"}
    check(0)
    broken = dict(incremental.BUILDERS, summary_severity_daily=lambda s, t: 1 / 0)
    with monkeypatch.context() as m:
        m.setattr(incremental, "BUILDERS", broken)
        status = incremental.refresh_all(dims, facts, base, 1)
    assert {n for n, s in status.items() if s != "ok"} == {"summary_severity_daily"}
    with monkeypatch.context() as m:  # the states are written, but not the ledger
        m.setattr(incremental, "_commit", lambda *a: 1 / 0)
        try:
            incremental.refresh_all(dims, facts, base, 2)
            raise AssertionError("no failure")
        except ZeroDivisionError:
            pass
    assert set(incremental.refresh_all(dims, facts, base, 2).values()) == {"ok"}
    check(2)
    assert set(incremental.refresh_all(dims, facts, base, 3).values()) == {"ok"}
    check(3)
    for name in ["states/sources", *summaries.BUILDERS]:
        written = [r.day for r in spark.read.parquet(f"{base}/{name}").filter("refresh = 3").select("day").distinct().collect()]
        assert written == [last] or (name in ("summary_severity_daily", "summary_dest_port_daily") and not written), name
    assert set(incremental.refresh_all(dims, facts, base, 9).values()) == {"ok"}  # nothing new
    check(3)


def test_replay_writes_only_what_failed(spark, tables, tmpdir_path, monkeypatch):
    events, write, tried = tables["events"].limit(200).persist(), fanout._write, []

    def failing(df, path, batch_id):
        tried.append(os.path.basename(path))
        if tried[-1] in broken:
            raise OSError("disk gone")
        write(df, path, batch_id)
    monkeypatch.setattr(fanout, "_write", failing)
    broken = {"documents", "e_attacked"}
    status = fanout.write_models(events, 4, tmpdir_path)
    assert {n for n, s in status.items() if s != "ok"} == broken and len(tried) == len(status) + 1
    assert fanout.written_models(spark, tmpdir_path, 4) == set(status) - broken
    broken, before = set(), list(tried)
    status = fanout.write_models(events, 4, tmpdir_path)
    assert set(status.values()) == {"ok"} and sorted(tried[len(before):]) == ["documents", "e_attacked", "ledger"]
    assert spark.read.parquet(f"{tmpdir_path}/documents").count() == spark.read.parquet(f"{tmpdir_path}/fact_network_event").count() == 200
    assert set(fanout.write_models(events, 4, tmpdir_path).values()) == {"ok"} and len(tried) == len(before) + 3
    assert len(fanout.written_models(spark, tmpdir_path, 5)) == 0


def test_summaries_before_the_first_attack(spark, tables, tmpdir_path):
    fact = tables["fact_network_event"]
    facts = fact.withColumn("batch_id", F.when(F.col("is_attack"), 1).otherwise(0)).persist()
    dims = {n: tables[n] for n in ("dim_source", "dim_attack", "dim_protocol")}
    for batch in range(2):
        assert set(incremental.refresh_all(dims, facts, tmpdir_path, batch).values()) == {"ok"}
        want = dict(tables, fact_network_event=facts.filter(F.col("batch_id") <= batch).drop("batch_id"), dim_destination=tables["dim_destination"])
        for name in ("summary_dest_port_daily", "summary_severity_daily", "summary_protocol_daily"):
            one = summaries.BUILDERS[name](want)
            assert rows_text(incremental.current_summary(spark, tmpdir_path, name).select(*one.columns)) == rows_text(one), (name, batch)


def _stream(spark, events, folder, base, files=1):
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    return fanout.fanout_stream(source, base, f"{folder}/ck").trigger(availableNow=True).start()


def test_a_key_is_written_once(spark, tables, tmpdir_path):
    """Dimensions and vertices over a restarted stream of many batches: no key
    twice, and the rows of all events; a key that a bad event had first is new."""
    base, valid = f"{tmpdir_path}/wh", tables["events"].persist()
    bad = valid.filter("event_id % 3 = 1").withColumn("source_port", F.lit(70000)).withColumn("event_id", F.col("event_id") - 10**9)
    middle = valid.approxQuantile("event_id", [0.5], 0)[0]
    late = F.col("event_id") > middle
    for part in (bad.unionByName(valid.filter(~late & (F.col("event_id") % 2 == 0))), valid.filter(~late & (F.col("event_id") % 2 == 1)), valid.filter(late)):
        part.coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")  # a file each; the stream starts again for it
        _stream(spark, valid, tmpdir_path, base).awaitTermination()
    facts = spark.read.parquet(f"{base}/fact_network_event")
    assert facts.select("batch_id").distinct().count() == 3 and facts.count() == valid.count()
    from flowlens.plans import model
    arrived = facts.select("event_id", "batch_id").join(valid, "event_id").withColumn("event_id", F.col("batch_id") * 10**10 + F.col("event_id"))
    want = model.tables_from_events(arrived.drop("batch_id").persist(), validated=True)
    for name, key in fanout.FIRST_WINS.items():
        got = spark.read.parquet(f"{base}/{name}")
        assert got.count() == got.select(key).distinct().count(), name
        assert rows_text(got.select(*want[name].columns)) == rows_text(want[name]), name
    assert {(r.n_rows == r.n_keys) for r in fanout.key_counts(spark, base).collect()} == {True}


def test_a_replayed_batch_is_told_its_keys_again(spark, tables, tmpdir_path, monkeypatch):
    base, events, write = f"{tmpdir_path}/wh", tables["events"], fanout._write
    events.filter("event_id % 2 = 0").coalesce(1).write.parquet(f"{tmpdir_path}/in")
    _stream(spark, events, tmpdir_path, base).awaitTermination()
    events.filter("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")

    def failing(df, path, batch_id):
        if path.endswith(("dim_source", "v_source_ip")):
            raise OSError("disk gone")
        write(df, path, batch_id)
    with monkeypatch.context() as m:
        m.setattr(fanout, "_write", failing)
        with pytest.raises(StreamingQueryException):
            _stream(spark, events, tmpdir_path, base).awaitTermination()
    _stream(spark, events, tmpdir_path, base).awaitTermination()
    for name, key in (("dim_source", "source_key"), ("v_source_ip", "ip"), ("dim_attack", "attack_key")):
        got = spark.read.parquet(f"{base}/{name}")
        assert got.count() == got.select(key).distinct().count() == tables[name].count(), name


def test_seeds_and_missing_protocols_are_written_once(spark, tables, tmpdir_path):
    """A seed that a later batch has for the first time is there already; events
    without a protocol have one key in the dimension, another in the graph."""
    base, one = f"{tmpdir_path}/wh", tables["events"].filter("label = 'BENIGN'").limit(1)
    say = [("BENIGN", None), ("DDoS", "OTHER"), ("Made up", None)]
    for k, (label, protocol) in enumerate(say):
        one.withColumn("label", F.lit(label)).withColumn("protocol", F.lit(protocol).cast("string")).withColumn("event_id", F.lit(k).cast("bigint")) \
            .coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
        _stream(spark, tables["events"], tmpdir_path, base).awaitTermination()
    labels = [r.attack_label for r in spark.read.parquet(f"{base}/dim_attack").collect()]
    assert sorted(labels) == sorted({row[0] for row in L.ATTACK_SEEDS} | {"Made up"})
    protocols = [r.protocol_name for r in spark.read.parquet(f"{base}/dim_protocol").collect()]
    assert collections.Counter(protocols) == collections.Counter({row[0] for row in L.PROTOCOL_SEEDS} | {None, "OTHER"})
    assert rows(spark.read.parquet(f"{base}/v_attack_type").select("label")) == [("BENIGN",), ("DDoS",), ("Made up",)]
    assert rows(spark.read.parquet(f"{base}/v_protocol").select("name")) == [("OTHER",)]


def test_keys_are_distinct_over_several_arrow_batches():
    """A model's keys are told once for the batches held together, as text; null is a key."""
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"a": [1, 2, None], "b": ["x", "x", "y"]})] * (fanout.DISTINCT_OVER + 1)
    told = [r for b in fanout._distinct(iter(batches)) for r in b.to_pylist()]
    once = [("a", "1"), ("a", "2"), ("a", None), ("b", "x"), ("b", "y")]
    assert collections.Counter((r["_model"], r["_key"]) for r in told) == collections.Counter(once * 2)


def test_a_refresh_writes_few_files_a_day(spark, tables, tmpdir_path):
    facts = tables["fact_network_event"].repartition(8).withColumn("batch_id", F.lit(0)).persist()
    dims = {n: tables[n] for n in ("dim_source", "dim_attack", "dim_protocol")}
    assert set(incremental.refresh_all(dims, facts, tmpdir_path, 0).values()) == {"ok"}
    for name in incremental.STATES:
        days = collections.Counter(os.path.dirname(f) for f in spark.read.parquet(f"{tmpdir_path}/states/{name}").inputFiles())
        assert set(days.values()) == {1}, name
