"""Dense serial keys over batches, distinct counts by bitmaps, the audit of keys
and arrival ids."""
import random

from pyspark.sql import functions as F

from flowlens.operators import serial, summaries, validate
from flowlens.sources import messages


def batches(spark, n=3):
    rng = random.Random(1)
    rows = [[(rng.randint(0, 400) if rng.random() < 0.6 else 7, f"k{k}", 1000 * k + i) for i in range(500)] for k in range(n)]
    return rows, [spark.createDataFrame(r, "a int, b string, seq bigint").repartition(4) for r in rows]


def brute(rows):
    out = {}
    for batch in rows:
        first = {}
        for a, _, seq in batch:
            first[a] = min(seq, first.get(a, seq))
        for a, seq in sorted(first.items(), key=lambda x: (x[1], x[0])):
            if a not in out:
                out[a] = (len(out) + 1, seq)
    return out


def test_serials_over_batches(spark, tmpdir_path):
    rows, frames = batches(spark)
    for k, df in enumerate(frames):
        new = serial.extend_serials(df, ["a"], "seq", tmpdir_path, k)
        want = brute(rows[: k + 1])
        got = {r.a: (r.serial, r.first_arrival) for r in serial.serials(spark, tmpdir_path).collect()}
        assert got == want and sorted(s for s, _ in got.values()) == list(range(1, len(want) + 1))
        assert new.count() == len(want) - len(brute(rows[:k]))
    before = {r.a: r.serial for r in serial.serials(spark, tmpdir_path).collect()}
    serial.extend_serials(frames[1], ["a"], "seq", tmpdir_path, 1)  # replayed
    assert {r.a: r.serial for r in serial.serials(spark, tmpdir_path).collect()} == before
    assert validate.check_unique(serial.serials(spark, tmpdir_path), ["a"]).count() == 0
    assert serial.extend_serials(frames[0].limit(0), ["a"], "seq", tmpdir_path, 3).count() == 0
    assert serial.serials(spark, f"{tmpdir_path}/none") is None


def test_bitmaps_merge_over_hours_and_batches(spark, tables, tmpdir_path):
    fact = tables["fact_network_event"].persist()
    numbers = serial.extend_serials(fact, ["source_key"], "event_id", tmpdir_path, 0)
    numbers = numbers.withColumn("serial", F.col("serial") * 977)  # over several stretches
    hourly = serial.hourly_source_bitmaps(fact, numbers)
    want = {(r.hour_bucket, r.attack_key): r.n for r in fact.groupBy(summaries.hour_of_key().alias("hour_bucket"), "attack_key")
            .agg(F.count_distinct("source_key").alias("n")).collect()}
    assert {(r.hour_bucket, r.attack_key): r.unique_sources for r in serial.distinct_sources(hourly, ["hour_bucket", "attack_key"]).collect()} == want
    parts = [serial.hourly_source_bitmaps(fact.filter(F.col("event_id") % 2 == k), numbers) for k in range(2)]
    both = serial.merge_bitmaps(parts[0].unionByName(parts[1]), ["hour_bucket", "attack_key"])
    assert {(r.hour_bucket, r.attack_key): r.unique_sources for r in serial.distinct_sources(both, ["hour_bucket", "attack_key"]).collect()} == want
    assert serial.distinct_sources(both.withColumn("all", F.lit(1)), ["all"]).first().unique_sources == fact.select("source_key").distinct().count()


def test_bitmaps_are_not_shuffled(tables, tmpdir_path):
    """Numbers are dealt out once by label and stretch; hours and days are made of them there."""
    fact = tables["fact_network_event"]
    numbers = serial.extend_serials(fact, ["source_key"], "event_id", tmpdir_path, 0)
    daily = serial.hourly_source_bitmaps(fact, numbers).withColumn("day", F.to_date("hour_bucket"))
    merged = serial.merge_bitmaps(daily, ["day", "attack_key"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan and "Exchange" not in plan[:plan.index("partial_bitmap_construct_agg")], plan
    got = {(r.day, r.attack_key): r.unique_sources for r in serial.distinct_sources(daily, ["day", "attack_key"]).collect()}
    assert got == {(r.day, r.attack_key): r.n for r in fact.groupBy(summaries.day_of_key().alias("day"), "attack_key")
                   .agg(F.count_distinct("source_key").alias("n")).collect()}


def test_audit_finds_planted_faults(spark, tables):
    keys = {"dim_time": "time_key", "dim_source": "source_key", "dim_attack": "attack_key"}
    dims = {n: (tables[n], k) for n, k in keys.items()}
    fact = tables["fact_network_event"]
    n = fact.count()
    clean = {r.dimension: r for r in validate.audit_keys(fact, dims).collect()}
    assert set(clean) == set(keys) and all((r.n_duplicated, r.n_orphans, r.n_fact_rows, r.n_orphan_rows) == (0, 0, n, 0) for r in clean.values())
    gone = fact.groupBy("source_key").count().orderBy("source_key").first()
    one = dims["dim_attack"][0].limit(1)
    faulty = dict(dims, dim_source=(dims["dim_source"][0].filter(F.col("source_key") != gone["source_key"]), "source_key"),
                  dim_attack=(dims["dim_attack"][0].unionByName(one), "attack_key"))
    late = fact.withColumn("time_key", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("time_key")))
    got = {r.dimension: r for r in validate.audit_keys(late, faulty).collect()}
    assert (got["dim_source"].n_orphans, got["dim_source"].n_orphan_rows) == (1, gone["count"])
    assert got["dim_attack"].n_duplicated == 1 and got["dim_attack"].n_orphans == 0
    assert got["dim_time"].n_orphans == 1 and got["dim_time"].n_orphan_rows == fact.filter("event_id % 5 = 0").count()


def test_arrival_ids(spark):
    df = spark.range(1000).repartition(7)
    for batch_id in (0, 5, 1 << 21, (1 << 31) - 1):  # 2^20 batches once ended the stream
        ids = sorted(r.event_id for r in messages.sequenced(df, batch_id).collect())
        assert ids == list(range(batch_id << 32, (batch_id << 32) + 1000))
    assert messages.sequenced(df.limit(0), 3).count() == 0
