"""The six summaries kept up to date from new batches alone.

What a summary needs of the fact is kept as mergeable partial states, one set of
rows a day: counts and sums by (hour, label, source), by (source, target), by
(target, label) and by protocol.  States of two batches merge by adding up rows
of one key; distinct sources and targets are the numbers of keys, so they merge
too, which finished distinct counts don't.

A refresh reads the fact rows of the batches since the last one, adds their
states to those of the days they touch, and replaces the rows of these days in
each summary; other days are neither read nor written.  Every write goes to a
folder of its own (``refresh=<n>/day=<d>``) and counts only once the ledger
names it, so a refresh that fails half-way leaves the last state in place and is
simply repeated.  Each summary has its own ledger: one that fails keeps what it
has and catches up on the days it missed at the next refresh.

Days are a calendar: lists of days are all that reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..session import read_or_none
from . import star, summaries, upsert
from .summaries import _exact, day_of_key, hour_of_key, total_bytes, with_threat_score

#: The columns of the fact that states are made from.
FACT_COLUMNS = ["time_key", "source_key", "dest_key", "attack_key", "protocol_key", "fwd_bytes", "bwd_bytes", "flow_duration", "is_attack"]

STATES = {
    "sources": ["hour_bucket", "attack_key", "source_key"],
    "targets": ["source_key", "dest_key"],
    "ports": ["dest_key", "attack_key"],
    "protocols": ["protocol_key"],
}


def partial_states(fact: DataFrame) -> dict[str, DataFrame]:
    """The states of some fact rows."""
    f = fact.withColumns({"day": day_of_key(), "hour_bucket": hour_of_key()})
    n, a = F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("a")
    return {
        "sources": f.groupBy("day", *STATES["sources"]).agg(n, a, F.sum(total_bytes()).alias("bytes"), F.sum("flow_duration").alias("duration")),
        "targets": f.groupBy("day", *STATES["targets"]).agg(n),
        "ports": f.filter("is_attack").groupBy("day", *STATES["ports"]).agg(n),
        "protocols": f.groupBy("day", *STATES["protocols"]).agg(n, a),
    }


def merge_states(stored: DataFrame, incoming: DataFrame, name: str) -> DataFrame:
    keys = ["day", *STATES[name]]
    return upsert.merge_additive(stored, incoming, keys, sums=[c for c in incoming.columns if c not in keys])


# ------------------------------------------------- summaries from merged states

def _attack_hourly(s: dict, t: dict) -> DataFrame:
    agg = s["sources"].groupBy("day", "hour_bucket", "attack_key").agg(
        F.sum("n").alias("event_count"), F.sum("bytes").alias("total_bytes"),
        F.round(_exact(F.sum("duration"), F.sum("n") * 1000), 2).cast("decimal(12,2)").alias("avg_duration_ms"),
        F.count(F.lit(1)).alias("unique_sources"))
    return agg.join(t["dim_attack"].select("attack_key", "attack_category", "attack_label"), "attack_key").drop("attack_key")


def _top_sources(s: dict, t: dict) -> DataFrame:
    ds, da = t["dim_source"].select("source_key", "country"), t["dim_attack"].select("attack_key", "attack_label", "severity")
    source = ["day", "source_ip", "country"]
    ip = star.endpoint_ip("source_key").alias("source_ip")
    by_label = (s["sources"].groupBy("day", "source_key", "attack_key").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
                .join(ds, "source_key").join(da, "attack_key").groupBy("day", ip, "country", "attack_label", "severity")
                .agg(F.sum("n").alias("n"), F.sum("a").alias("a")))
    g = by_label.groupBy(*source).agg(
        F.sum("a").alias("attack_count"), F.sum("n").alias("n"), F.max("severity").alias("max_severity"),
        F.min_by("attack_label", F.struct((-F.col("n")).alias("n"), "attack_label")).alias("primary_attack"))
    targets = (s["targets"].join(ds, "source_key").select("day", ip, "country", "dest_key").distinct()
               .groupBy(*source).agg(F.count(F.lit(1)).alias("distinct_targets")))
    return with_threat_score(g.join(targets, source), "day").withColumn("day_bucket", F.col("day"))


def _protocol_daily(s: dict, t: dict) -> DataFrame:
    ratio = _exact(F.col("a"), F.col("n"))
    return s["protocols"].join(t["dim_protocol"].select("protocol_key", "protocol_name"), "protocol_key").select(
        "day", F.col("day").alias("day_bucket"), "protocol_name", F.col("n").alias("total_events"), F.col("a").alias("attack_events"),
        F.round(ratio, 4).cast("decimal(5,4)").alias("attack_ratio"))


def _severity_daily(s: dict, t: dict) -> DataFrame:
    rows = s["sources"].filter("a > 0").join(t["dim_attack"].select("attack_key", "severity"), "attack_key") \
        .groupBy("day", "severity", "source_key").agg(F.sum("a").alias("a"))
    return rows.groupBy("day", "severity").agg(F.sum("a").alias("event_count"), F.count(F.lit(1)).alias("unique_sources")) \
        .withColumn("day_bucket", F.col("day"))


def _dest_port_daily(s: dict, t: dict) -> DataFrame:
    port = star.endpoint_port("dest_key")
    return (s["ports"].join(t["dim_attack"].select("attack_key", "attack_category"), "attack_key")
            .groupBy("day", port.alias("dest_port"), S.service_name(port).alias("service_name"), "attack_category")
            .agg(F.sum("n").alias("event_count")).withColumn("day_bucket", F.col("day")))


def _weekend_days(s: dict, t: dict) -> DataFrame:
    """By day; the summary adds the days up when it is read."""
    return (s["sources"].groupBy("day", "attack_key").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
            .join(t["dim_attack"].select("attack_key", "attack_category"), "attack_key")
            .groupBy("day", "attack_category").agg(F.sum("n").alias("n"), F.sum("a").alias("a")))


BUILDERS = {
    "summary_attack_hourly": _attack_hourly,
    "summary_top_sources": _top_sources,
    "summary_protocol_daily": _protocol_daily,
    "summary_severity_daily": _severity_daily,
    "summary_dest_port_daily": _dest_port_daily,
    "summary_weekend_weekday": _weekend_days,
}


# ------------------------------------------------------------ ledger and tables

def _ledger(spark: SparkSession, base: str, name: str) -> dict[dt.date, int]:
    """The refresh that counts for each day of a table."""
    rows = read_or_none(spark, f"{base}/ledger/{name}")
    return {} if rows is None else {r["day"]: r["refresh"] for r in rows.groupBy("day").agg(F.max("refresh").alias("refresh")).collect()}


def _commit(spark: SparkSession, base: str, name: str, days: list[dt.date], refresh: int) -> None:
    spark.createDataFrame([(d,) for d in days], "day date").coalesce(1).write.mode("overwrite").parquet(f"{base}/ledger/{name}/refresh={refresh}")


def _days(spark: SparkSession, base: str, name: str, versions: dict[dt.date, int]) -> DataFrame:
    """The rows of the given days, each from its refresh: a filter on the two
    partition columns, so no other folder is read."""
    schema = spark.read.parquet(f"{base}/schema/{name}").schema.add("refresh", T.IntegerType())
    rows = spark.read.schema(schema).parquet(f"{base}/{name}")
    named = [f"{refresh}/{day.isoformat()}" for day, refresh in versions.items()]
    return rows.filter(F.concat_ws("/", F.col("refresh").cast("string"), F.col("day").cast("string")).isin(named)).drop("refresh")


def _write(df: DataFrame, base: str, name: str, refresh: int) -> None:
    """The columns are kept apart: a table without rows yet (no attack has come
    in) has no file to read them from.  Rows are brought together by day before
    they are written (a busy day is several files): else each task of a shuffle
    writes a file for each day, and the next refresh and the summaries read
    tasks times days of them."""
    spark = df.sparkSession
    if read_or_none(spark, f"{base}/schema/{name}") is None:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{base}/schema/{name}")
    df.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{base}/{name}/refresh={refresh}")


def refresh_all(t: dict[str, DataFrame], batches: DataFrame, base: str, refresh: int, parallel: int = 4) -> dict[str, str]:
    """Bring all six summaries under ``base`` up to the batches up to ``refresh``.

    ``batches`` holds the fact rows of all batches with their ``batch_id``, of
    which only those after the last refresh are read; ``t`` has the dimensions.
    ``refresh`` has to rise (a batch id does).  Returns {summary: 'ok' | error
    text}; what fails is made up for by the next refresh.  The new rows are read
    once, for all states; the writes of the states, and then of the summaries, are
    independent jobs, ``parallel`` of them submitted at a time.
    """
    spark = batches.sparkSession
    states = _ledger(spark, base, "states")
    fresh = batches.filter((F.col("batch_id") > max(states.values(), default=-1)) & (F.col("batch_id") <= refresh)).select(*FACT_COLUMNS).persist()
    try:
        days = [r["day"] for r in fresh.select(day_of_key().alias("day")).distinct().collect()]
        if days:
            old = {d: states[d] for d in days if d in states}

            def add(name: str, part: DataFrame) -> None:
                if old:
                    part = merge_states(_days(spark, base, f"states/{name}", old).select(*part.columns), part, name)
                _write(part, base, f"states/{name}", refresh)
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                list(pool.map(lambda held: add(*held), partial_states(fresh).items()))
            _commit(spark, base, "states", days, refresh)
            states |= dict.fromkeys(days, refresh)
    finally:
        fresh.unpersist()

    def build(name: str) -> str:
        have = _ledger(spark, base, name)
        due = {d: r for d, r in states.items() if have.get(d, -1) < r}
        try:
            if due:
                merged = _Lazy(spark, base, due)
                _write(BUILDERS[name](merged, t), base, name, refresh)
                _commit(spark, base, name, list(due), refresh)
            return "ok"
        except Exception as e:  # noqa: BLE001 - one summary must not stop the others
            return str(e)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(BUILDERS, pool.map(build, BUILDERS)))


class _Lazy(dict):
    """Merged states of some days, read when asked for."""

    def __init__(self, spark: SparkSession, base: str, versions: dict[dt.date, int]):
        super().__init__()
        self._at = spark, base, versions

    def __missing__(self, name: str) -> DataFrame:
        spark, base, versions = self._at
        return _days(spark, base, f"states/{name}", versions)


def current_summary(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A summary as its latest refresh left it."""
    rows = _days(spark, base, name, _ledger(spark, base, name))
    if name != "summary_weekend_weekday":
        return rows.drop("day")
    weekend = S.is_weekend(F.col("day").cast("timestamp_ntz")).alias("is_weekend")
    return summaries.with_attack_rate(rows.groupBy(weekend, "attack_category").agg(F.sum("n").alias("total_events"), F.sum("a").alias("attack_events")))
