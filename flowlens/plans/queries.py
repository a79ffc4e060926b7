"""Decision queries Q1-Q12 over each model.

Suffixes: ``_s`` summaries, ``_f`` star fact, ``_d`` documents (``_ds`` the
document hourly summary), ``_g`` graph.  Every function takes the table dict
of :mod:`flowlens.plans.model` and returns a DataFrame with the output
columns of SURVEY §2.15.  Star queries aggregate the fact on surrogate keys
first and only join that (small) aggregate to the dimensions.  Top-k outputs
carry natural-key tie-breakers so they are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import graph, star
from ..operators.summaries import day_of_key, hour_of_key
from . import common as C

def _non_normal():
    return F.col("attack_category") != F.lit("Normal")


def _date_range(col: str, target_date: str | None):
    """Half-open [day, day+1) range so parquet pruning / pushdown applies."""
    if not target_date:
        return F.lit(True)
    d = _dt.date.fromisoformat(str(target_date))
    lo = _dt.datetime(d.year, d.month, d.day)
    hi = lo + _dt.timedelta(days=1)
    return (F.col(col) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(col) < F.lit(hi).cast("timestamp_ntz"))


def _one_day(t, name: str, target_date: str | None, in_day):
    """The rows of ``target_date`` (all rows without one): the day's partition of
    a stored table, else by the condition ``in_day``."""
    stored = getattr(t, "by_day", {}).get(name)
    if target_date and stored is not None:
        return stored.filter(F.col("_day") == F.lit(_dt.date.fromisoformat(str(target_date)))).drop("_day")
    return t[name].filter(in_day)


def _attack_dim(t, *cols):
    return t["dim_attack"].select("attack_key", *cols)


# ============================================================ summaries (_s)

def q1_s(t):
    s = t["summary_attack_hourly"].filter(_non_normal())
    return (s.groupBy("attack_category").agg(F.sum("event_count").alias("total_events"))
            .orderBy(F.desc("total_events"), "attack_category"))


def q2_s(t, target_date: str | None = None):
    s = t["summary_attack_hourly"].filter(_non_normal() & _date_range("hour_bucket", target_date))
    return (s.groupBy("hour_bucket", "attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy("hour_bucket", "attack_category"))


def q3_s(t, limit: int = 10):
    """Reference file form: MAX(threat_score)."""
    s = t["summary_top_sources"].filter(F.col("attack_count") > 0)
    g = s.groupBy("source_ip", "country").agg(
        F.sum("attack_count").alias("total_attacks"),
        F.sum("distinct_targets").alias("total_targets"),
        F.max("threat_score").cast("double").alias("max_threat_score"))
    return C.top(g, limit, F.desc("total_attacks"), "source_ip", "country")


def q3_s_avg(t, limit: int = 10):
    """Connector form: ROUND(AVG(threat_score), 2)."""
    s = t["summary_top_sources"].filter(F.col("attack_count") > 0)
    cents = (F.col("threat_score") * 100).cast("bigint")
    g = s.groupBy("source_ip", "country").agg(
        F.sum("attack_count").alias("total_attacks"),
        F.sum("distinct_targets").alias("total_targets"),
        C.q_half_up(F.sum(cents), F.count(cents) * 100, 2).alias("threat_score"))
    return C.top(g, limit, F.desc("total_attacks"), "source_ip", "country")


def _with_pct(df, count_col):
    # total over <= (number of categories) rows: a single-partition window on
    # an already aggregated frame, as cheap as a scalar subquery
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn("pct", C.pct_half_up(F.col(count_col), total))


def q4_s(t):
    g = t["summary_attack_hourly"].groupBy("attack_category").agg(
        F.sum("event_count").alias("event_count"))
    return _with_pct(g, "event_count").orderBy(F.desc("event_count"), "attack_category")


def q5_s(t):
    g = t["summary_protocol_daily"].groupBy("protocol_name").agg(
        F.sum("total_events").alias("total_events"), F.sum("attack_events").alias("attack_events"))
    return (g.withColumn("attack_pct", C.pct_half_up("attack_events", "total_events"))
            .orderBy(F.desc("total_events"), "protocol_name"))


def q6_s(t, limit: int = 15):
    g = t["summary_dest_port_daily"].groupBy("dest_port", "service_name").agg(
        F.sum("event_count").alias("attack_count"))
    return C.top(g, limit, F.desc("attack_count"), "dest_port", "service_name")


def q7_s(t):
    """Weights the stored (rounded) hourly averages, as the original does."""
    s = t["summary_attack_hourly"].filter(_non_normal())
    cents_n = (F.col("avg_duration_ms") * 100).cast("bigint") * F.col("event_count")
    g = s.groupBy("attack_label", "attack_category").agg(
        F.sum("event_count").alias("event_count"),
        C.q_half_up(F.sum(cents_n), F.sum("event_count") * 100, 2).alias("avg_duration_ms"),
        C.q_half_up(F.sum("total_bytes"), F.sum("event_count"), 2).alias("avg_total_bytes"))
    return g.orderBy(F.desc("avg_duration_ms"), "attack_label")


def q9_s(t):
    s = t["summary_top_sources"]
    cents = (F.col("threat_score") * 100).cast("bigint")
    g = s.groupBy("country").agg(
        F.sum("attack_count").alias("attack_events"),
        F.count_distinct("source_ip").alias("unique_ips"),
        C.q_half_up(F.sum(cents), F.count(cents) * 100, 2).alias("avg_threat_score"))
    return g.orderBy(F.desc("attack_events"), "country")


def q10_s(t):
    return (t["summary_severity_daily"]
            .select(F.col("day_bucket").alias("day"), "severity", "event_count")
            .orderBy("day", "severity"))


def q11_s(t):
    return (C.decimals_to_double(t["summary_weekend_weekday"].select(
        "is_weekend", "attack_category", "total_events", "attack_events", "attack_rate_pct"))
        .orderBy("is_weekend", F.desc("attack_events"), "attack_category"))


def q12_s(t):
    s = t["summary_attack_hourly"].filter(F.col("attack_category") == "Botnet")
    return (s.groupBy("hour_bucket").agg(
        F.sum("event_count").alias("bot_events"),
        F.sum("unique_sources").cast("bigint").alias("unique_bot_sources"),
        F.sum("total_bytes").alias("total_bytes")).orderBy("hour_bucket"))


# ============================================================ star fact (_f)

def _fact(t):
    return t["fact_network_event"]


def q1_f(t):
    agg = _fact(t).filter("is_attack").groupBy("attack_key").agg(F.count(F.lit(1)).alias("n"))
    return (agg.join(_attack_dim(t, "attack_category"), "attack_key")
            .groupBy("attack_category").agg(F.sum("n").alias("total_events"))
            .orderBy(F.desc("total_events"), "attack_category"))


def _key_range(target_date: str | None):
    """Day filter on the smart time key (minutes since the epoch): a plain
    range on a stored column, so parquet statistics can skip row groups."""
    if not target_date:
        return F.lit(True)
    d = _dt.date.fromisoformat(str(target_date))
    lo = (d - _dt.date(1970, 1, 1)).days * 1440
    return (F.col("time_key") >= F.lit(lo)) & (F.col("time_key") < F.lit(lo + 1440))


def q2_f(t, target_date: str | None = None):
    f = _one_day(t, "fact_network_event", target_date, _key_range(target_date)).filter("is_attack")
    f = f.withColumn("hour_bucket", hour_of_key())
    agg = f.groupBy("hour_bucket", "attack_key").agg(F.count(F.lit(1)).alias("n"))
    return (agg.join(_attack_dim(t, "attack_category"), "attack_key")
            .groupBy("hour_bucket", "attack_category").agg(F.sum("n").alias("event_count"))
            .orderBy("hour_bucket", "attack_category"))


def q3_f(t, limit: int = 10):
    agg = _fact(t).filter("is_attack").groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
    ds = t["dim_source"].select("source_key", "source_ip", "country")
    g = agg.join(ds, "source_key").groupBy("source_ip", "country").agg(
        F.sum("n").alias("total_attacks"))
    return C.top(g, limit, F.desc("total_attacks"), "source_ip", "country")


def q4_f(t):
    agg = _fact(t).groupBy("attack_key").agg(F.count(F.lit(1)).alias("n"))
    g = (agg.join(_attack_dim(t, "attack_category"), "attack_key")
         .groupBy("attack_category").agg(F.sum("n").alias("event_count")))
    return _with_pct(g, "event_count").orderBy(F.desc("event_count"), "attack_category")


def q5_f(t):
    agg = _fact(t).groupBy("protocol_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("a"))
    dp = t["dim_protocol"].select("protocol_key", "protocol_name")
    g = agg.join(dp, "protocol_key").groupBy("protocol_name").agg(
        F.sum("n").alias("total_events"), F.sum("a").alias("attack_events"))
    return (g.withColumn("attack_pct", C.pct_half_up("attack_events", "total_events"))
            .orderBy(F.desc("total_events"), "protocol_name"))


def q6_f(t, limit: int = 15):
    agg = _fact(t).filter("is_attack").groupBy("dest_key").agg(F.count(F.lit(1)).alias("n"))
    dd = t["dim_destination"].select("dest_key", "dest_port", "service_name")
    g = agg.join(dd, "dest_key").groupBy("dest_port", "service_name").agg(
        F.sum("n").alias("attack_count"))
    return C.top(g, limit, F.desc("attack_count"), "dest_port", "service_name")


def q7_f(t):
    f = _fact(t).filter("is_attack")
    agg = f.groupBy("attack_key").agg(
        F.count(F.lit(1)).alias("event_count"),
        C.avg_ms_half_up("flow_duration").alias("avg_duration_ms"),
        C.avg_half_up(F.col("fwd_bytes") + F.col("bwd_bytes")).alias("avg_total_bytes"))
    return (agg.join(_attack_dim(t, "attack_label", "attack_category"), "attack_key")
            .select("attack_label", "attack_category", "event_count", "avg_duration_ms",
                    "avg_total_bytes")
            .orderBy(F.desc("avg_duration_ms"), "attack_label"))




def q8_f(t, limit: int = 20):
    """Co-attacking address pairs on the same label, top ``limit``.

    co_count(ip1, ip2, label) counts pairs of attack events with
    (ip1, port1) < (ip2, port2).  For ip1 < ip2 that is a1 * a2 (a = attack
    events of the address on the label); for one address through two ports it
    is (a^2 - sum of squared per-port counts) / 2.  No pair list is built:
    a pair can only reach the top ``limit`` if both addresses are among the
    first ``limit + 1`` of their label by (a desc, ip) - any other address
    has at least ``limit`` strictly better partners - so pairs are formed only
    among those.  The per-label ranking is a window with a row-number filter,
    which Spark runs as a partial WindowGroupLimit before the shuffle, so a
    label holding a third of all rows costs no more than any other label.
    """
    k = max(limit, 1) + 1
    f = _fact(t).filter("is_attack").groupBy("source_key", "attack_key").agg(
        F.count(F.lit(1)).cast("decimal(19,0)").alias("c"))  # products go beyond BIGINT
    per = (f.join(_attack_dim(t, "attack_label"), "attack_key")
           .groupBy(star.endpoint_ip("source_key").alias("source_ip"), "attack_label")
           .agg(F.sum("c").cast("decimal(19,0)").alias("a"), F.sum(F.col("c") * F.col("c")).alias("sq")))
    self_pairs = (per.select(F.col("source_ip").alias("ip1"), F.col("source_ip").alias("ip2"),
                             F.col("attack_label").alias("shared_attack"),
                             ((F.col("a") * F.col("a") - F.col("sq")) / 2).cast("decimal(38,0)").alias("co_count"))
                  .filter(F.col("co_count") > 0))
    w = Window.partitionBy("attack_label").orderBy(F.desc("a"), "source_ip")
    cand = per.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).drop("rn", "sq")
    a1, a2 = cand.alias("x"), cand.alias("y")
    cross = (a1.join(a2, (F.col("x.attack_label") == F.col("y.attack_label"))
                     & (F.col("x.source_ip") < F.col("y.source_ip")))
             .select(F.col("x.source_ip").alias("ip1"), F.col("y.source_ip").alias("ip2"),
                     F.col("x.attack_label").alias("shared_attack"),
                     (F.col("x.a") * F.col("y.a")).cast("decimal(38,0)").alias("co_count")))
    return C.top(cross.unionByName(self_pairs), limit,
                 F.desc("co_count"), "ip1", "ip2", "shared_attack")


def q9_f(t):
    agg = _fact(t).filter("is_attack").groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
    ds = t["dim_source"].select("source_key", "source_ip", "country")
    return (agg.join(ds, "source_key").groupBy("country").agg(
        F.sum("n").alias("attack_events"), F.count_distinct("source_ip").alias("unique_ips"))
        .orderBy(F.desc("attack_events"), "country"))


def q10_f(t):
    agg = (_fact(t).filter("is_attack").groupBy(day_of_key().alias("day_bucket"), "attack_key")
           .agg(F.count(F.lit(1)).alias("n")))
    return (agg.join(_attack_dim(t, "severity"), "attack_key")
            .groupBy("day_bucket", "severity").agg(F.sum("n").alias("event_count"))
            .orderBy("day_bucket", "severity"))


def q11_f(t):
    agg = (_fact(t).groupBy(S.is_weekend(S.key_to_minute("time_key")).alias("is_weekend"),
                            "attack_key")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("a")))
    g = (agg.join(_attack_dim(t, "attack_category"), "attack_key")
         .groupBy("is_weekend", "attack_category")
         .agg(F.sum("n").alias("total_events"), F.sum("a").alias("attack_events")))
    return (g.withColumn("attack_rate_pct", C.pct_half_up("attack_events", "total_events"))
            .orderBy("is_weekend", F.desc("attack_events"), "attack_category"))


def q12_f(t):
    bot = _attack_dim(t, "attack_category").filter(F.col("attack_category") == "Botnet")
    agg = (_fact(t).groupBy(hour_of_key().alias("hour_bucket"), "attack_key")
           .agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.col("fwd_bytes") + F.col("bwd_bytes")).alias("b")))
    return (agg.join(bot, "attack_key").groupBy("hour_bucket")
            .agg(F.sum("n").alias("bot_events"), F.sum("b").alias("total_bytes"))
            .orderBy("hour_bucket"))


# ============================================================ documents (_d)

def _docs(t):
    return t["documents"]


def _attack_doc():
    return F.col("attack.is_attack")


def q1_d(t):
    return (_docs(t).filter(_attack_doc()).groupBy(F.col("attack.category").alias("attack_category"))
            .agg(F.count(F.lit(1)).alias("total_events"))
            .orderBy(F.desc("total_events"), "attack_category"))


def q1_ds(t):
    s = t["doc_hourly_summary"].filter(_non_normal())
    return (s.groupBy("attack_category").agg(F.sum("event_count").alias("total_events"))
            .orderBy(F.desc("total_events"), "attack_category"))


def q2_d(t, target_date: str | None = None):
    docs = _one_day(t, "documents", target_date, _date_range("timestamp", target_date))
    return (docs.filter(_attack_doc())
            .groupBy(S.trunc_ntz("hour", "timestamp").alias("hour_bucket"),
                     F.col("attack.category").alias("attack_category"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy("hour_bucket", "attack_category"))


def q2_ds(t, target_date: str | None = None):
    s = t["doc_hourly_summary"].filter(_non_normal() & _date_range("hour_bucket", target_date))
    return (s.groupBy("hour_bucket", "attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy("hour_bucket", "attack_category"))


def q3_d(t, limit: int = 10):
    g = (_docs(t).filter(_attack_doc()).groupBy(F.col("source.ip").alias("source_ip"))
         .agg(F.count(F.lit(1)).alias("total_attacks"),
              F.min_by("source.country", "event_id").alias("country")))
    return C.top(g.select("source_ip", "country", "total_attacks"), limit,
                 F.desc("total_attacks"), "source_ip")


def q4_d(t):
    return (_docs(t).groupBy(F.col("attack.category").alias("attack_category"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), "attack_category"))


def q4_ds(t):
    return (t["doc_hourly_summary"].groupBy("attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy(F.desc("event_count"), "attack_category"))


def q5_d(t):
    g = (_docs(t).groupBy(F.col("protocol.name").alias("protocol_name"))
         .agg(F.count(F.lit(1)).alias("total_events"),
              F.count_if(_attack_doc()).alias("attack_events")))
    return (g.withColumn("attack_pct", C.pct_half_even("attack_events", "total_events"))
            .orderBy(F.desc("total_events"), "protocol_name"))


def q6_d(t, limit: int = 15):
    g = (_docs(t).filter(_attack_doc())
         .groupBy(F.col("destination.port").alias("dest_port"),
                  F.col("destination.service_name").alias("service_name"))
         .agg(F.count(F.lit(1)).alias("attack_count")))
    return C.top(g, limit, F.desc("attack_count"), "dest_port", "service_name")


def q7_d(t):
    g = (_docs(t).filter(_attack_doc())
         .groupBy(F.col("attack.label").alias("attack_label"),
                  F.col("attack.category").alias("attack_category"))
         .agg(F.count(F.lit(1)).alias("event_count"),
              C.avg_ms_half_even("metrics.flow_duration").alias("avg_duration_ms"),
              C.avg_half_even(F.col("metrics.fwd_bytes") + F.col("metrics.bwd_bytes"))
              .alias("avg_total_bytes")))
    return g.orderBy(F.desc("avg_duration_ms"), "attack_label")


def q9_d(t):
    return (_docs(t).filter(_attack_doc()).groupBy(F.col("source.country").alias("country"))
            .agg(F.count(F.lit(1)).alias("attack_events"),
                 F.count_distinct("source.ip").alias("unique_ips"))
            .orderBy(F.desc("attack_events"), "country"))


def q10_d(t):
    return (_docs(t).filter(_attack_doc())
            .groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day"),
                     F.col("attack.severity").alias("severity"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy("day", "severity"))


def q11_d(t):
    g = (_docs(t).groupBy(F.col("time.is_weekend").alias("is_weekend"),
                          F.col("attack.category").alias("attack_category"))
         .agg(F.count(F.lit(1)).alias("total_events"),
              F.count_if(_attack_doc()).alias("attack_events")))
    return (g.withColumn("attack_rate_pct", C.pct_half_even("attack_events", "total_events"))
            .orderBy("is_weekend", F.desc("attack_events"), "attack_category"))


def q12_d(t):
    return (_docs(t).filter(F.col("attack.category") == "Botnet")
            .groupBy(S.trunc_ntz("hour", "timestamp").alias("hour_bucket"))
            .agg(F.count(F.lit(1)).alias("bot_events"),
                 F.sum(F.col("metrics.fwd_bytes") + F.col("metrics.bwd_bytes")).alias("total_bytes"))
            .orderBy("hour_bucket"))


def q12_ds(t):
    s = t["doc_hourly_summary"].filter(F.col("attack_category") == "Botnet")
    return (s.groupBy("hour_bucket").agg(F.sum("event_count").alias("bot_events"),
                                         F.sum("total_bytes").alias("total_bytes"))
            .orderBy("hour_bucket"))


# ============================================================ graph (_g)

def _used_attack(t):
    at = t["v_attack_type"].select("label", F.col("category").alias("attack_category"),
                                   "severity")
    return t["e_used_attack"].join(at, "label")


def _active_in(t):
    at = t["v_attack_type"].select("label", F.col("category").alias("attack_category"),
                                   "severity")
    return t["e_active_in"].join(at, "label")


def q1_g(t):
    return (_used_attack(t).filter(_non_normal()).groupBy("attack_category")
            .agg(F.sum("count").alias("total_events"))
            .orderBy(F.desc("total_events"), "attack_category"))


def q2_g(t, target_date: str | None = None):
    e = _active_in(t).filter(_non_normal())
    if target_date:
        e = e.filter(F.col("hour_bucket").startswith(str(target_date)))
    return (e.groupBy("hour_bucket", "attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy("hour_bucket", "attack_category"))


def q3_g(t, limit: int = 10):
    per_src = (_used_attack(t).filter(_non_normal()).groupBy("src_ip")
               .agg(F.sum("count").alias("total_attacks")))
    v = t["v_source_ip"].select(F.col("ip").alias("src_ip"), "country")
    g = per_src.join(v, "src_ip").select(F.col("src_ip").alias("source_ip"), "country",
                                         "total_attacks")
    return C.top(g, limit, F.desc("total_attacks"), "source_ip")


def q4_g(t):
    return (_used_attack(t).groupBy("attack_category")
            .agg(F.sum("count").alias("event_count"))
            .orderBy(F.desc("event_count"), "attack_category"))


def q5_g(t):
    p = t["v_protocol"].select(F.col("name").alias("protocol"))
    return (t["e_used_protocol"].join(p, "protocol")
            .groupBy(F.col("protocol").alias("protocol_name"))
            .agg(F.sum("count").alias("total_events"))
            .orderBy(F.desc("total_events"), "protocol_name"))


def q6_g(t, limit: int = 15):
    """Per destination address over all flows (the edge has no attack filter)."""
    per_dst = t["e_attacked"].groupBy("dst_ip").agg(F.sum("count").alias("attack_count"))
    v = t["v_destination_ip"].select(F.col("ip").alias("dst_ip"), "service_name")
    g = per_dst.join(v, "dst_ip").select(F.col("dst_ip").alias("dest_ip"), "service_name",
                                         "attack_count")
    return C.top(g, limit, F.desc("attack_count"), "dest_ip")


def top_attacked_destinations(t, limit: int = 10):
    per_dst = t["e_attacked"].groupBy("dst_ip").agg(F.sum("count").alias("hit_count"))
    v = t["v_destination_ip"].select(F.col("ip").alias("dst_ip"), "service_name")
    g = per_dst.join(v, "dst_ip").select(F.col("dst_ip").alias("dest_ip"), "service_name",
                                         "hit_count")
    return C.top(g, limit, F.desc("hit_count"), "dest_ip")


def q7_g(t):
    return (_active_in(t).filter(_non_normal())
            .groupBy(F.col("label").alias("attack_label"), "attack_category")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy(F.desc("event_count"), "attack_label"))


def q9_g(t):
    per_src = (_used_attack(t).filter(_non_normal()).groupBy("src_ip")
               .agg(F.sum("count").alias("n")))
    v = t["v_source_ip"].select(F.col("ip").alias("src_ip"), "country")
    return (per_src.join(v, "src_ip").groupBy("country")
            .agg(F.sum("n").alias("attack_events"), F.count(F.lit(1)).alias("unique_ips"))
            .orderBy(F.desc("attack_events"), "country"))


def q10_g(t):
    return (_active_in(t).filter(_non_normal())
            .groupBy(F.substring("hour_bucket", 1, 10).alias("day"), "severity")
            .agg(F.sum("event_count").alias("event_count"))
            .orderBy("day", "severity"))


def q11_g(t):
    """Counts all events (no category filter), as the graph form does."""
    tw = t["v_time_window"].select("hour_bucket", F.col("day_of_week").isin(5, 6).alias("is_weekend"))
    return (_active_in(t).join(tw, "hour_bucket").groupBy("is_weekend", "attack_category")
            .agg(F.sum("event_count").alias("attack_events"))
            .orderBy("is_weekend", F.desc("attack_events"), "attack_category"))


def q12_g(t):
    return (_active_in(t).filter(F.col("attack_category") == "Botnet")
            .groupBy("hour_bucket").agg(F.sum("event_count").alias("bot_events"))
            .orderBy("hour_bucket"))


def q8_g(t, limit: int = 20) -> DataFrame:
    """Address pairs sharing attack labels (any label, BENIGN included), top
    ``limit`` by number of shared labels, then (ip1, ip2).

    Answered from the factored CONNECTED_TO relation in one plan.  Sources of
    one label set differ only in their order, so of each set only the
    ``limit + 1`` smallest can be in the answer (a partial WindowGroupLimit
    before the shuffle: a set with a third of all sources costs no more).  Each
    two sets are then ranked by their overlap and by their smallest pair; a pair
    of sets beyond the first ``limit`` has ``limit`` better pairs, the smallest
    ones of those before it.  Only the pairs of the first ``limit`` are expanded.
    """
    w = Window.partitionBy("label_set").orderBy("src_ip")
    few = (t["e_has_label_set"].select("src_ip", "label_set").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit + 1)
           .groupBy("label_set").agg(F.array_sort(F.collect_list("src_ip")).alias("ips")))
    ranked = (t["e_connected_to"].join(few.toDF("set_a", "ips_a"), "set_a").join(few.toDF("set_b", "ips_b"), "set_b")
              .withColumn("same", F.col("set_a") == F.col("set_b"))
              .withColumn("other", F.when(F.col("same"), F.get("ips_b", F.lit(1))).otherwise(F.get("ips_b", F.lit(0)))))
    first, second = F.least(F.get("ips_a", F.lit(0)), "other"), F.greatest(F.get("ips_a", F.lit(0)), "other")
    best = C.top(ranked, limit, F.desc("shared_count"), first, second)
    pairs = (best.select("same", "shared_attacks", "shared_count", F.explode("ips_a").alias("x"), "ips_b")
             .select("same", "shared_attacks", "shared_count", "x", F.explode("ips_b").alias("y")).filter("NOT same OR x < y")
             .select(F.least("x", "y").alias("ip1"), F.greatest("x", "y").alias("ip2"), "shared_attacks", "shared_count"))
    pairs = C.top(pairs, limit, F.desc("shared_count"), "ip1", "ip2")
    v = t["v_source_ip"].select("ip", "country")
    out = (pairs.join(v.select(F.col("ip").alias("ip1"), F.col("country").alias("country1")), "ip1")
           .join(v.select(F.col("ip").alias("ip2"), F.col("country").alias("country2")), "ip2")
           .select("ip1", "country1", "ip2", "country2", "shared_attacks", "shared_count"))
    return out.orderBy(F.desc("shared_count"), "ip1", "ip2")


def connected_pairs(t, min_shared: int) -> DataFrame:
    """CONNECTED_TO edges as address pairs (ip1 < ip2) sharing at least
    ``min_shared`` labels.  The work follows the size of the answer; a low
    threshold asks for (nearly) every pair of a label, which is quadratic by
    definition - ask ``e_connected_to`` for numbers of pairs and :func:`q8_g`
    for the first ones instead.
    """
    overlaps = t["e_connected_to"].filter(F.col("shared_count") >= max(int(min_shared), 1))
    return graph.expand_connected(overlaps, t["e_has_label_set"])
