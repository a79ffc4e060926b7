"""Dashboard data operators, quarantine reports and profiling entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..operators.logs import browse_limit
from ..functions import scalars as S
from ..operators import profile as P
from . import common as C
from . import queries as Q


def kpis(t) -> DataFrame:
    """Totals from the hourly summary; unique sources are the SUM of hourly
    distinct counts, as the original reports them."""
    s = t["summary_attack_hourly"]
    nn = F.col("attack_category") != "Normal"
    g = s.agg(F.sum("event_count").alias("total"),
              F.sum(F.when(nn, F.col("event_count"))).alias("attacks"),
              F.sum(F.when(nn, F.col("unique_sources"))).alias("sources"))
    return g.select(
        F.coalesce("total", F.lit(0)).cast("bigint").alias("total_events"),
        F.coalesce("attacks", F.lit(0)).cast("bigint").alias("attack_events"),
        F.when(F.col("total") > 0, C.pct_half_up("attacks", "total")).otherwise(F.lit(0.0))
         .alias("attack_rate"),
        F.coalesce("sources", F.lit(0)).cast("bigint").alias("unique_sources"))


def _hour_attrs(t, align: str) -> DataFrame:
    """Hourly attack counts with weekday, hour, time of day, ISO week, year.

    ``align='minute'`` (default) joins hour buckets to ``dim_time`` on its
    minute timestamp, as the original does - hours without an event in minute
    :00 find no partner and drop out.  ``align='hour'`` derives the calendar
    parts from the hour itself and loses nothing.
    """
    s = t["summary_attack_hourly"].filter(F.col("attack_category") != "Normal") \
        .select("hour_bucket", "attack_category", "event_count")
    if align == "hour":
        cal = S.calendar_columns("hour_bucket")
        return s.select("*", *[cal[k].alias(k) for k in ("day_of_week", "hour", "time_of_day",
                                                         "week", "year")])
    dt = t["dim_time"].select(F.col("timestamp").alias("hour_bucket"), "day_of_week", "hour",
                              "time_of_day", "week", "year")
    return s.join(dt, "hour_bucket")


def day_of_week_heatmap(t, align: str = "minute") -> DataFrame:
    return (_hour_attrs(t, align).groupBy("day_of_week", "hour")
            .agg(F.sum("event_count").alias("event_count")).orderBy("day_of_week", "hour"))


def heatmap_pivot(t, align: str = "minute") -> DataFrame:
    """Weekday x 24 hours, zero-filled, Monday first (columns h0..h23)."""
    h = day_of_week_heatmap(t, align)
    wide = (h.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.sum("event_count")))
    wide = wide.select("day_of_week", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("bigint").alias(f"h{i}")
                                        for i in range(24)])
    order = S.lookup({d: i for i, d in enumerate(L.DAY_NAMES)}, F.col("day_of_week"), 99)
    return wide.withColumn("day_order", order).orderBy("day_order").drop("day_order")


def time_of_day_distribution(t, align: str = "minute") -> DataFrame:
    return (_hour_attrs(t, align).groupBy("time_of_day", "attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy(F.desc("event_count"), "time_of_day", "attack_category"))


def weekly_trend(t, align: str = "minute") -> DataFrame:
    g = (_hour_attrs(t, align).groupBy("year", "week", "attack_category")
         .agg(F.sum("event_count").alias("event_count")))
    return (g.withColumn("week_label", F.format_string("%d-W%02d", "year", "week"))
            .orderBy("year", "week", "attack_category"))


def country_summary(t) -> DataFrame:
    return (t["summary_top_sources"].groupBy("country")
            .agg(F.sum("attack_count").alias("attack_events"),
                 F.count_distinct("source_ip").alias("unique_ips"))
            .orderBy(F.desc("attack_events"), "country"))


def top_countries(t, limit: int = 10) -> DataFrame:
    return C.top(country_summary(t), limit, F.desc("attack_events"), "country")


def severity_totals(t) -> DataFrame:
    """Events by severity from the daily severity summary, fixed display order."""
    g = (Q.q10_s(t).groupBy(F.coalesce(S.py_strip("severity"), F.lit("Unknown")).alias("severity"))
         .agg(F.sum("event_count").alias("events")))
    rank = S.lookup({s: i for i, s in enumerate(L.SEVERITY_DISPLAY_ORDER)}, F.col("severity"), 99)
    return g.orderBy(rank, "severity")


def available_dates(t) -> DataFrame:
    return t["dim_time"].select(F.to_date("timestamp").alias("day")).distinct().orderBy("day")


def distinct_categories(t) -> DataFrame:
    return t["dim_attack"].select("attack_category").distinct().orderBy("attack_category")


def distinct_protocols(t) -> DataFrame:
    return t["dim_protocol"].select("protocol_name").distinct().orderBy("protocol_name")


def distinct_severities(t) -> DataFrame:
    return t["dim_attack"].select("severity").distinct().orderBy("severity")


def weekend_label(t) -> DataFrame:
    return Q.q11_s(t).withColumn(
        "period", F.when(F.col("is_weekend"), F.lit("Weekend")).otherwise(F.lit("Weekday")))


def record_count(t) -> DataFrame:
    return t["documents"].agg(F.count(F.lit(1)).alias("record_count"))


def model_reconcile(t, query: str = "q1") -> DataFrame:
    """The same question answered by each model, side by side; rows where
    the answers differ carry ``agree = false``."""
    forms = {"q1": (["attack_category"], "total_events",
                    [Q.q1_s, Q.q1_f, Q.q1_d, Q.q1_g]),
             "q4": (["attack_category"], "event_count", [Q.q4_s, Q.q4_f, Q.q4_d, Q.q4_g]),
             "q12": (["hour_bucket"], "bot_events", [Q.q12_s, Q.q12_f, Q.q12_d])}
    keys, val, fns = forms[query]
    out = None
    for fn in fns:
        model = fn.__name__.split("_")[-1]
        df = fn(t).select(*keys, F.col(val).alias(f"{val}_{model}"))
        out = df if out is None else out.join(df, keys, "full_outer")
    cols = [c for c in out.columns if c.startswith(val + "_")]
    same = F.lit(True)
    for c in cols[1:]:
        same = same & F.coalesce(F.col(c) == F.col(cols[0]), F.lit(False))
    return out.withColumn("agree", same)


def dlq_report(t) -> DataFrame:
    return (t["rejected"].groupBy("_error", "source_ip", "label")
            .agg(F.count(F.lit(1)).alias("count")))


def dlq_browse(t, limit: int = L.BROWSE_DEFAULT_LIMIT) -> DataFrame:
    """First ``limit`` (1..5000) dead letters in arrival order."""
    return C.top(t["rejected"], browse_limit(limit), F.col("event_id"))


def _describe(t) -> DataFrame:
    """Moments as shown: four digits, beyond which the order of summation matters."""
    d = P.profile_describe(t["raw_flows"])
    return d.select(*[F.round(c, 4).alias(c) if c not in ("column_name", "count") else F.col(c) for c in d.columns])


def registry() -> dict[str, Callable]:
    r = {fn.__name__: fn for fn in (
        kpis, day_of_week_heatmap, heatmap_pivot, time_of_day_distribution, weekly_trend,
        country_summary, top_countries, severity_totals, available_dates, distinct_categories,
        distinct_protocols, distinct_severities, weekend_label, record_count, model_reconcile,
        dlq_report, dlq_browse)}
    r["day_of_week_heatmap_hour"] = lambda t: day_of_week_heatmap(t, "hour")
    r["weekly_trend_hour"] = lambda t: weekly_trend(t, "hour")
    r["time_of_day_distribution_hour"] = lambda t: time_of_day_distribution(t, "hour")
    r["summary_top_sources_rank"] = lambda t: C.decimals_to_double(
        __import__("flowlens.operators.summaries", fromlist=["x"]).summary_top_sources(t, "rank"))
    r["q8_g"] = lambda t: Q.q8_g(t).withColumn("shared_attacks", F.array_join("shared_attacks", ","))
    # profiling of the raw flow rows
    r["profile_shape"] = lambda t: P.profile_shape(t["raw_flows"])
    r["profile_describe"] = _describe
    r["label_counts"] = lambda t: P.label_counts(t["raw_flows"])
    r["protocol_share"] = lambda t: P.protocol_share(t["raw_flows"])
    r["null_profile"] = lambda t: P.null_profile(t["raw_flows"])
    r["inf_profile"] = lambda t: P.inf_profile(t["raw_flows"])
    r["ts_range"] = lambda t: P.ts_range(t["raw_flows"])
    r["top_attack_ips"] = lambda t: P.top_attack_ips(t["raw_flows"])
    return r
