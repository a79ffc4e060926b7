"""Cross-model invariants, exact top-k against brute force, key checks."""
from pyspark.sql import functions as F

from flowlens.operators import validate
from flowlens.plans import queries as Q


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_q1_same_in_every_model(tables):
    ref = as_dict(Q.q1_f(tables), "attack_category", "total_events")
    for fn in (Q.q1_s, Q.q1_d, Q.q1_ds, Q.q1_g):
        assert as_dict(fn(tables), "attack_category", "total_events") == ref


def test_q12_same_in_every_model(tables):
    ref = as_dict(Q.q12_f(tables), "hour_bucket", "bot_events")
    for fn in (Q.q12_s, Q.q12_d, Q.q12_ds):
        assert as_dict(fn(tables), "hour_bucket", "bot_events") == ref


def test_surrogate_keys_unique_and_fact_keys_resolve(tables):
    for dim, key in (("dim_source", ["source_key"]), ("dim_destination", ["dest_key"]),
                     ("dim_attack", ["attack_key"]), ("dim_protocol", ["protocol_key"]),
                     ("dim_time", ["time_key"])):
        assert validate.check_unique(tables[dim], key).count() == 0
        assert validate.check_fk(tables["fact_network_event"], tables[dim], key[0]).count() == 0
    assert validate.check_unique(tables["dim_source"], ["source_ip", "source_port"]).count() == 0


def test_seeds_win_in_dimensions(tables):
    d = as_dict(tables["dim_attack"], "attack_label", "description")
    assert d["DoS Hulk"] == "HTTP GET flood using Hulk tool"
    assert tables["dim_protocol"].count() >= 19


def _brute_q8_f(tables, limit=20):
    ev = tables["events"].filter(F.col("attack_category") != "Normal")
    c = ev.groupBy("source_ip", "source_port", "label").agg(F.count(F.lit(1)).alias("c"))
    a, b = c.alias("a"), c.alias("b")
    cond = (F.col("a.label") == F.col("b.label")) & (
        (F.col("a.source_ip") < F.col("b.source_ip"))
        | ((F.col("a.source_ip") == F.col("b.source_ip")) & (F.col("a.source_port") < F.col("b.source_port"))))
    p = a.join(b, cond).groupBy(F.col("a.source_ip").alias("ip1"), F.col("b.source_ip").alias("ip2"),
                                F.col("a.label").alias("shared_attack")) \
        .agg(F.sum(F.col("a.c") * F.col("b.c")).alias("co_count"))
    return p.orderBy(F.desc("co_count"), "ip1", "ip2", "shared_attack").limit(limit)


def test_q8_f_exact_against_brute_force(tables):
    for limit in (1, 5, 20, 50):
        got = [tuple(r) for r in Q.q8_f(tables, limit).collect()]
        want = [tuple(r) for r in _brute_q8_f(tables, limit).collect()]
        assert got == want


def _brute_q8_g(tables, limit=20):
    ipl = tables["e_used_attack"].select("src_ip", "label").distinct()
    a, b = ipl.alias("a"), ipl.alias("b")
    p = (a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.src_ip") < F.col("b.src_ip")))
         .groupBy(F.col("a.src_ip").alias("ip1"), F.col("b.src_ip").alias("ip2"))
         .agg(F.count(F.lit(1)).alias("shared_count"),
              F.array_sort(F.collect_list("a.label")).alias("shared_attacks")))
    return p.orderBy(F.desc("shared_count"), "ip1", "ip2").limit(limit)


def test_q8_g_exact_against_brute_force(tables):
    for limit in (1, 20, 60):
        got = [(r.ip1, r.ip2, r.shared_count, list(r.shared_attacks)) for r in Q.q8_g(tables, limit).collect()]
        want = [(r.ip1, r.ip2, r.shared_count, list(r.shared_attacks))
                for r in _brute_q8_g(tables, limit).collect()]
        assert got == want


def test_q8_f_plan_limits_before_shuffle(tables):
    plan = Q.q8_f(tables)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_threat_score_text_vs_rank(tables):
    from flowlens.operators.summaries import summary_top_sources
    text = summary_top_sources(tables, "text").count()
    rank = summary_top_sources(tables, "rank").count()
    assert text == rank


def test_quarantine_split_is_complete(tables):
    n = tables["flow_events"].count()
    assert tables["events"].count() + tables["rejected"].count() == n
    errs = {r["_error"] for r in tables["rejected"].select("_error").distinct().collect()}
    assert errs <= {"source_port out of range 0-65535"}


def test_connected_to_threshold_matches_brute_force(tables):
    ipl = tables["e_used_attack"].select("src_ip", "label").distinct()
    a, b = ipl.alias("a"), ipl.alias("b")
    brute = (a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.src_ip") < F.col("b.src_ip")))
             .groupBy(F.col("a.src_ip").alias("ip1"), F.col("b.src_ip").alias("ip2"))
             .agg(F.count(F.lit(1)).alias("shared_count")))
    for k in (2, 4):
        got = sorted((r.ip1, r.ip2, r.shared_count) for r in Q.connected_pairs(tables, k).collect())
        want = sorted(tuple(r) for r in brute.filter(F.col("shared_count") >= k).collect())
        assert got == want


def test_connected_to_is_lossless(tables):
    """Expanding the factored relation gives every pair of the brute force."""
    got = sorted((r.ip1, r.ip2, r.shared_count, list(r.shared_attacks)) for r in Q.connected_pairs(tables, 1).collect())
    want = sorted((r.ip1, r.ip2, r.shared_count, list(r.shared_attacks)) for r in _brute_q8_g(tables, 10**7).collect())
    assert got == want and len(got) > 0
    assert tables["e_connected_to"].agg(F.sum("n_pairs")).first()[0] == len(want)


def test_q8_g_of_few_large_and_lonely_label_sets(spark):
    from flowlens.operators import graph
    used = [(f"10.0.0.{i:03d}", x) for i in range(200) for x in ("a", "b", "c")[: 1 + i % 3]] + [("9.9.9.9", "z"), ("8.8.8.8", "c"), ("7.7.7.7", "c")]
    e = spark.createDataFrame(used + used[:5], "src_ip string, label string")
    members = graph.e_has_label_set(e)
    t = {"e_used_attack": e, "e_has_label_set": members, "e_connected_to": graph.e_connected_to(graph.v_label_set(members)),
         "v_source_ip": e.select(F.col("src_ip").alias("ip"), F.lit("x").alias("country")).distinct()}
    for limit in (1, 3, 50, 5000):
        got = [(r.ip1, r.ip2, r.shared_count) for r in Q.q8_g(t, limit).collect()]
        assert got == [(r.ip1, r.ip2, r.shared_count) for r in _brute_q8_g(t, limit).collect()]
    assert "e_used_attack" in t and Q.q8_g(dict(t, e_connected_to=t["e_connected_to"].limit(0))).count() == 0


def test_clean_stats_observed_in_one_pass(spark):
    from pyspark.sql import Observation

    from flowlens.operators import clean
    from flowlens.sources import adapter
    from conftest import SF_SMALL
    obs = (Observation("before"), Observation("after"))
    df = clean.clean_flows(adapter.raw_flows(spark, SF_SMALL), ip_format="decimal", observations=obs)
    n = df.count()
    st = clean.clean_stats(obs)
    assert st["rows_after"] == n and st["rows_before"] == spark.read.parquet(
        SF_SMALL + "/events.parquet").count()
    assert st["rows_dropped"] > 0


def test_q2_day_filter_same_in_every_model(tables):
    day = "2024-01-05"
    f = {(str(r.hour_bucket), r.attack_category): r.event_count for r in Q.q2_f(tables, day).collect()}
    s = {(str(r.hour_bucket), r.attack_category): r.event_count for r in Q.q2_s(tables, day).collect()}
    g = {(r.hour_bucket.replace("T", " "), r.attack_category): r.event_count
         for r in Q.q2_g(tables, day).collect()}
    assert f and f == s == g
    assert all(k[0].startswith(day) for k in f)


def test_stored_layout_by_day(spark, tables, tmpdir_path):
    """A query of one day reads that day's partition; the stored tables are the
    lazy ones, and a day's files are in time order."""
    from flowlens.plans import model, queries
    path, names = f"{tmpdir_path}/wh", ["fact_network_event", "documents", "summary_attack_hourly", "doc_hourly_summary", "dim_attack"]
    model.write_tables(tables, path, names)
    stored = model.read_tables(spark, path, names)
    for name in names:
        assert stored[name].columns == tables[name].columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, tables[name].collect())), name
    day = str(tables["events"].selectExpr("max(to_date(timestamp))").first()[0])
    for fn in (queries.q2_f, queries.q2_d, queries.q2_s, queries.q2_ds):
        got, want = fn(stored, day), fn(tables, day)
        assert got.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), fn
        plan = got._jdf.queryExecution().executedPlan().toString()
        if fn in (queries.q2_f, queries.q2_d):
            assert "PartitionFilters: [isnotnull(_day" in plan
    one = spark.read.parquet(f"{path}/fact_network_event/_day={day}").select("time_key", F.input_file_name().alias("f"),
                                                                        F.monotonically_increasing_id().alias("at"))
    by_file = {}
    for r in sorted(one.collect(), key=lambda r: r["at"]):
        by_file.setdefault(r.f, []).append(r.time_key)
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_reconcile_finds_planted_changes(spark, tables):
    """Nothing differs between the models; one changed row of each is found, with
    its keys alone, from the few buckets that it touches."""
    from flowlens.plans import reconcile as R
    held = {n: tables[n].persist() for n in ("fact_network_event", "documents", "dim_attack", "dim_protocol", *R.VIEWS)}
    assert {r["agree"] for r in R.reconcile_events(held, 64).collect()} == {True} and R.differing_keys(held, 64).count() == 0
    doc = held["documents"].orderBy("event_id").first()
    lost = dict(held, documents=held["documents"].filter(F.col("event_id") != doc.event_id))
    got = {(r["view"], r.a, r.b): (r.n_events_star, r.n_events_document, r.n_events_graph) for r in R.differing_keys(lost, 64).collect()}
    src, dst, label, protocol = doc.source.ip, doc.destination.ip, doc.attack.label, doc.protocol.name
    hour = doc.timestamp.strftime("%Y-%m-%dT%H:00:00")
    keys = {("e_attacked", src, dst), ("e_used_attack", src, label), ("e_targeted_by", dst, label), ("e_used_protocol", src, protocol),
            ("e_active_in", label, hour)}
    assert set(got) == keys and all(s == g and (d or 0) == s - 1 for s, d, g in got.values())
    assert R.bucket_checksums(lost, 64).filter("differs").count() <= 5
    one = (F.col("src_ip") == src) & (F.col("dst_ip") == dst)
    moved = dict(held, e_attacked=held["e_attacked"].withColumn("total_bytes", F.when(one, F.col("total_bytes") + 1).otherwise(F.col("total_bytes"))))
    found = R.differing_keys(moved, 64).collect()
    assert [(r["view"], r.a, r.b, r.total_bytes_graph - r.total_bytes_star) for r in found] == [("e_attacked", src, dst, 1)]
    fact = held["fact_network_event"].withColumn("attack_key", F.when(F.col("event_id") == doc.event_id, 0).otherwise(F.col("attack_key")))
    assert {r["view"] for r in R.differing_keys(dict(held, fact_network_event=fact), 64).collect()} == {"e_used_attack", "e_targeted_by", "e_active_in"}


def test_a_query_writes_only_what_it_reads(spark, tmpdir_path):
    """Tables are stored when first read, with what they are built from, once;
    a query of raw flows stores none."""
    import os

    from flowlens.plans import model
    from flowlens.plans.registry import registry
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", 100 + i % 7, ("error", "view", "signup")[i % 3], 1.5 * i, f'{{"k": {i % 11}}}') for i in range(200)]
    spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmpdir_path}/in/events.parquet")
    t, lazy = model.StoredTables(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/wh"), model.build_tables(spark, f"{tmpdir_path}/in")
    queries = registry()

    def held():
        return set(os.listdir(f"{tmpdir_path}/wh")) if os.path.exists(f"{tmpdir_path}/wh") else set()

    want = set()
    for name, stored in (("protocol_share", set()), ("log_level_counts", set()), ("e_attacked", {model.CHECKED, "e_attacked"}),
                         ("edge_merge_two_batches", set()), ("q2_s", {"summary_attack_hourly", "dim_attack"}),
                         ("v_label_set", {"v_label_set", "e_has_label_set", "e_used_attack"})):
        got = sorted(map(str, queries[name](t).collect()))
        assert held() == (want := want | stored), name
        assert got and got == sorted(map(str, queries[name](lazy).collect())), name
    assert t.cleaning["rows_before"] == 200 and t.cleaning["rows_after"] == t["flow_events"].count()
