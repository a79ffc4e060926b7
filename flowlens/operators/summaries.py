"""The six pre-aggregated summaries, built from the star schema.

Pattern: aggregate the fact on its surrogate keys first (map-side partial
aggregation keeps the shuffle to one row per key and task), then join the
small aggregate to the dimensions.  Calendar attributes are derived from the
smart time key, so no summary joins ``dim_time``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalars as S


def hour_of_key(time_key="time_key") -> Column:
    k = S._c(time_key)
    return S.key_to_minute(k - F.pmod(k, F.lit(60)))


def day_of_key(time_key="time_key") -> Column:
    return F.to_date(S.key_to_minute(time_key))


def total_bytes() -> Column:
    return F.col("fwd_bytes") + F.col("bwd_bytes")


def _exact(num: Column, den: Column) -> Column:
    """num / den on DECIMAL(20,0): 18 fractional digits, so ROUND is exact."""
    return num.cast("decimal(20,0)") / F.nullif(den.cast("decimal(20,0)"), F.lit(0))


def avg_ms(duration="flow_duration") -> Column:
    """AVG(duration / 1000.0) on DECIMAL, never DOUBLE."""
    d = S._c(duration)
    return _exact(F.sum(d), F.count(d) * 1000)


def severity_weight(sev: Column) -> Column:
    w = None
    for name, weight in L.SEVERITY_WEIGHT.items():
        w = F.when(sev == name, F.lit(weight)) if w is None else w.when(sev == name, F.lit(weight))
    return w.otherwise(F.lit(1))


SEVERITY_RANK = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}


def summary_attack_hourly(t: dict[str, DataFrame]) -> DataFrame:
    f = t["fact_network_event"]
    agg = (f.groupBy(hour_of_key().alias("hour_bucket"), "attack_key")
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.sum(total_bytes()).alias("total_bytes"),
                F.round(avg_ms(), 2).cast("decimal(12,2)").alias("avg_duration_ms"),
                F.count_distinct("source_key").alias("unique_sources")))
    da = t["dim_attack"].select("attack_key", "attack_category", "attack_label")
    return agg.join(da, "attack_key").select(
        "hour_bucket", "attack_category", "attack_label", "event_count", "total_bytes",
        "avg_duration_ms", "unique_sources")


def summary_top_sources(t: dict[str, DataFrame], severity_order: str = "text") -> DataFrame:
    """Per day and source address.  ``severity_order='text'`` keeps the
    original MAX over severity text (MEDIUM > LOW > HIGH > CRITICAL);
    ``'rank'`` takes the most severe level instead.

    The fact is aggregated on its keys before it is joined.  The joined
    aggregate is then grouped once by label and once by target; both kinds of
    partial rows meet in the last grouping, so a source with a large share of
    all rows is spread by its labels and targets until then.
    """
    f = t["fact_network_event"].groupBy(day_of_key().alias("day_bucket"), "source_key", "dest_key", "attack_key") \
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("a"))
    ds = t["dim_source"].select("source_key", "source_ip", "country")
    da = t["dim_attack"].select("attack_key", "attack_label", "severity")
    j = f.join(ds, "source_key").join(da, "attack_key")
    day, ip, country, label, severity, target = (
        F.col(c) for c in ("day_bucket", "source_ip", "country", "attack_label", "severity", "dest_key"))
    parts = j.groupingSets([[day, ip, country, label, severity], [day, ip, country, target]],
                           day, ip, country, label, severity, target) \
        .agg(F.sum("n").alias("n"), F.sum("a").alias("a"), (F.grouping("dest_key") == 1).alias("by_label"))
    if severity_order == "rank":
        rank = S.lookup(SEVERITY_RANK, F.col("severity"), 0)
        max_sev = F.max_by("severity", rank)
    else:
        max_sev = F.max("severity")
    most = F.when(F.col("by_label"), F.struct((-F.col("n")).alias("n"), "attack_label"))
    g = parts.groupBy("day_bucket", "source_ip", "country").agg(
        F.sum(F.when(F.col("by_label"), F.col("a"))).alias("attack_count"),
        F.sum(F.when(F.col("by_label"), F.col("n"))).alias("n"),
        F.count_if(~F.col("by_label")).alias("distinct_targets"),
        F.min_by("attack_label", most).alias("primary_attack"),
        max_sev.alias("max_severity"))
    return with_threat_score(g, "day_bucket")


def with_threat_score(g: DataFrame, day: str) -> DataFrame:
    """Threat score of a source's day: attacks times targets times the weight
    of its severity, by its events."""
    score = _exact(F.col("attack_count").cast("decimal(20,0)") * F.col("distinct_targets")
                   * severity_weight(F.col("max_severity")), F.col("n"))
    return g.select(
        day, "source_ip", "country", "attack_count", "distinct_targets", "primary_attack",
        F.round(score, 2).cast("decimal(12,2)").alias("threat_score"))


def summary_protocol_daily(t: dict[str, DataFrame]) -> DataFrame:
    f = t["fact_network_event"]
    agg = (f.groupBy(day_of_key().alias("day_bucket"), "protocol_key")
           .agg(F.count(F.lit(1)).alias("total_events"),
                F.count_if("is_attack").alias("attack_events")))
    dp = t["dim_protocol"].select("protocol_key", "protocol_name")
    ratio = _exact(F.col("attack_events"), F.col("total_events"))
    return agg.join(dp, "protocol_key").select(
        "day_bucket", "protocol_name", "total_events", "attack_events",
        F.round(ratio, 4).cast("decimal(5,4)").alias("attack_ratio"))


def summary_severity_daily(t: dict[str, DataFrame]) -> DataFrame:
    f = t["fact_network_event"].filter("is_attack")
    da = t["dim_attack"].select("attack_key", "severity")
    # distinct sources are not additive across attack keys: join, then count
    return (f.select(day_of_key().alias("day_bucket"), "attack_key", "source_key")
            .join(da, "attack_key")
            .groupBy("day_bucket", "severity")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.count_distinct("source_key").alias("unique_sources")))


def summary_dest_port_daily(t: dict[str, DataFrame]) -> DataFrame:
    f = t["fact_network_event"].filter("is_attack")
    agg = (f.groupBy(day_of_key().alias("day_bucket"), "dest_key", "attack_key")
           .agg(F.count(F.lit(1)).alias("n")))
    dd = t["dim_destination"].select("dest_key", "dest_port", "service_name")
    da = t["dim_attack"].select("attack_key", "attack_category")
    return (agg.join(dd, "dest_key").join(da, "attack_key")
            .groupBy("day_bucket", "dest_port", "service_name", "attack_category")
            .agg(F.sum("n").alias("event_count")))


def summary_weekend_weekday(t: dict[str, DataFrame]) -> DataFrame:
    f = t["fact_network_event"]
    agg = (f.groupBy(S.is_weekend(S.key_to_minute("time_key")).alias("is_weekend"), "attack_key")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("a")))
    da = t["dim_attack"].select("attack_key", "attack_category")
    g = (agg.join(da, "attack_key").groupBy("is_weekend", "attack_category")
         .agg(F.sum("n").alias("total_events"), F.sum("a").alias("attack_events")))
    return with_attack_rate(g)


def with_attack_rate(g: DataFrame) -> DataFrame:
    rate = _exact(F.col("attack_events") * 100, F.col("total_events"))
    return g.select("is_weekend", "attack_category", "total_events", "attack_events",
                    F.round(rate, 2).cast("decimal(5,2)").alias("attack_rate_pct"))


BUILDERS = {
    "summary_attack_hourly": summary_attack_hourly,
    "summary_top_sources": summary_top_sources,
    "summary_protocol_daily": summary_protocol_daily,
    "summary_severity_daily": summary_severity_daily,
    "summary_dest_port_daily": summary_dest_port_daily,
    "summary_weekend_weekday": summary_weekend_weekday,
}


class RefreshPolicy:
    """Refresh after every ``every_rows`` inserted rows; the count starts anew
    with a restarted stream."""

    def __init__(self, every_rows: int = L.SUMMARY_REFRESH_ROWS):
        self.every_rows = every_rows
        self.pending = 0

    def add(self, rows: int) -> bool:
        self.pending += rows
        if self.pending >= self.every_rows:
            self.pending = 0
            return True
        return False
