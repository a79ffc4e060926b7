"""Property graph as vertex and edge DataFrames.

Vertices keep the properties of their first appearance
(``min_by(.., event_id)``); edges are aggregates keyed by their two ends, so
each is one hash aggregation with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def _first(cols: list[str], seq: str = "event_id"):
    return F.min_by(F.struct(*cols), F.col(seq))


def hour_text(ts) -> F.Column:
    """Hour bucket as ISO text, e.g. 2024-01-05T13:00:00."""
    return F.date_format(S._c(ts), "yyyy-MM-dd'T'HH:00:00")


def graph_input(events: DataFrame) -> DataFrame:
    """Event columns the graph needs, with defaults for missing values."""
    return events.select(
        "event_id", "timestamp",
        F.coalesce("source_ip", F.lit("0.0.0.0")).alias("src_ip"),
        F.coalesce("destination_ip", F.lit("0.0.0.0")).alias("dst_ip"),
        F.coalesce("label", F.lit("BENIGN")).alias("label"),
        F.coalesce("attack_category", F.lit("Normal")).alias("category"),
        F.coalesce("severity", F.lit("LOW")).alias("severity"),
        F.coalesce("protocol", F.lit("OTHER")).alias("protocol"),
        F.coalesce("source_country", F.lit("Unknown")).alias("country"),
        F.coalesce("source_region", F.lit("Unknown")).alias("region"),
        S.service_name(F.coalesce("destination_port", F.lit(0))).alias("service_name"),
        S.service_type(F.coalesce("destination_port", F.lit(0))).alias("service_type"),
        (F.coalesce("fwd_bytes", F.lit(0)) + F.coalesce("bwd_bytes", F.lit(0))).alias("total_bytes"),
        hour_text("timestamp").alias("hour_bucket"),
    )


# ------------------------------------------------------------------ vertices

def v_source_ip(g: DataFrame) -> DataFrame:
    return (g.groupBy(F.col("src_ip").alias("ip")).agg(_first(["country", "region"]).alias("p"))
            .select("ip", "p.country", "p.region"))


def v_destination_ip(g: DataFrame) -> DataFrame:
    return (g.groupBy(F.col("dst_ip").alias("ip"))
            .agg(_first(["service_name", "service_type"]).alias("p"))
            .select("ip", "p.service_name", "p.service_type"))


def v_attack_type(g: DataFrame) -> DataFrame:
    return (g.groupBy("label").agg(_first(["category", "severity"]).alias("p"))
            .select("label", "p.category", "p.severity"))


def v_protocol(g: DataFrame) -> DataFrame:
    return (g.groupBy(F.col("protocol").alias("name"))
            .agg(F.first(F.lit(1)).alias("_"))
            .select("name", S.transport_layer("name").alias("transport_layer")))


def v_time_window(g: DataFrame) -> DataFrame:
    first = _first(["timestamp"])
    return (g.groupBy("hour_bucket").agg(first.alias("p"))
            .select("hour_bucket",
                    S.weekday0("p.timestamp").alias("day_of_week"),
                    F.month("p.timestamp").alias("month"),
                    F.year("p.timestamp").alias("year")))


# ------------------------------------------------------------------ edges

def e_attacked(g: DataFrame) -> DataFrame:
    """src -> dst over all flows (benign included): count, bytes, first/last."""
    return g.groupBy("src_ip", "dst_ip").agg(
        F.count(F.lit(1)).alias("count"), F.sum("total_bytes").alias("total_bytes"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))


def e_used_attack(g: DataFrame) -> DataFrame:
    return g.groupBy("src_ip", "label").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))


def e_targeted_by(g: DataFrame) -> DataFrame:
    return g.groupBy("dst_ip", "label").agg(F.count(F.lit(1)).alias("count"))


def e_used_protocol(g: DataFrame) -> DataFrame:
    return g.groupBy("src_ip", "protocol").agg(F.count(F.lit(1)).alias("count"))


def e_active_in(g: DataFrame) -> DataFrame:
    return g.groupBy("label", "hour_bucket").agg(F.count(F.lit(1)).alias("event_count"))


# ------------------------------------------- CONNECTED_TO, in factored form
#
# Two sources are connected if they share a label, whatever their events: the
# relation depends on their label sets alone.  So it is kept as the distinct
# label sets, the overlap of each two of them, and which sources have which
# set.  Label sets come from a catalogue of a few dozen labels and don't grow
# with the sources; the address pairs, quadratic in the sources of a label, are
# never made unless a caller expands them (``expand_connected``).

def e_has_label_set(used: DataFrame) -> DataFrame:
    """Membership: the label set of each source, as its sorted labels in one text."""
    return (used.groupBy("src_ip").agg(F.array_sort(F.collect_set("label")).alias("labels"))
            .select("src_ip", F.array_join("labels", "|").alias("label_set"), "labels"))


def v_label_set(members: DataFrame) -> DataFrame:
    """The distinct label sets with their number of sources."""
    return (members.groupBy("label_set").agg(F.first("labels").alias("labels"), F.count(F.lit(1)).alias("n_sources"))
            .select("label_set", "labels", F.size("labels").alias("n_labels"), "n_sources"))


def e_connected_to(label_sets: DataFrame) -> DataFrame:
    """Overlap of each two label sets (``set_a <= set_b``) that share a label:
    the shared labels and the number of address pairs connected by them.

    Sets meet by label; of the labels that two share only the first one makes
    their row, so no pair has to be deduplicated.
    """
    rows = label_sets.select("label_set", "labels", "n_sources", F.explode("labels").alias("label"))
    a, b = rows.alias("a"), rows.alias("b")
    shared = F.array_intersect("a.labels", "b.labels")
    same = F.col("a.label_set") == F.col("b.label_set")
    one, two = F.col("a.n_sources").cast("decimal(19,0)"), F.col("b.n_sources").cast("decimal(19,0)")
    return (a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.label_set") <= F.col("b.label_set")))
            .filter(shared[0] == F.col("a.label"))
            .select(F.col("a.label_set").alias("set_a"), F.col("b.label_set").alias("set_b"), shared.alias("shared_attacks"),
                    F.size(shared).cast("bigint").alias("shared_count"),
                    F.when(same, one * (one - 1) / 2).otherwise(one * two).cast("decimal(38,0)").alias("n_pairs"))
            .filter("n_pairs > 0"))


def expand_connected(overlaps: DataFrame, members: DataFrame) -> DataFrame:
    """Address pairs (ip1 < ip2) of the given overlaps: as many rows as their
    ``n_pairs`` add up to, so filter the overlaps first."""
    a = members.select(F.col("src_ip").alias("x"), F.col("label_set").alias("set_a"))
    b = members.select(F.col("src_ip").alias("y"), F.col("label_set").alias("set_b"))
    return (overlaps.join(a, "set_a").join(b, "set_b").filter((F.col("set_a") != F.col("set_b")) | (F.col("x") < F.col("y")))
            .select(F.least("x", "y").alias("ip1"), F.greatest("x", "y").alias("ip2"), "shared_attacks", "shared_count"))
