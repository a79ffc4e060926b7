"""Nested event documents and the additive hourly document summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def flow_document(events: DataFrame) -> DataFrame:
    """One nested row per event: time, source, destination, attack,
    protocol and metrics sub-structures (a pure projection)."""
    ts = F.col("timestamp")
    cal = S.calendar_columns(ts)
    return events.select(
        "event_id",
        ts.alias("timestamp"),
        F.struct(*[cal[k].alias(k) for k in
                   ("hour", "day", "week", "month", "year", "day_of_week", "is_weekend",
                    "time_of_day")]).alias("time"),
        F.struct(F.coalesce("source_ip", F.lit("0.0.0.0")).alias("ip"),
                 F.coalesce("source_port", F.lit(0)).alias("port"),
                 F.coalesce("source_country", F.lit("Unknown")).alias("country"),
                 F.coalesce("source_region", F.lit("Unknown")).alias("region")).alias("source"),
        F.struct(F.coalesce("destination_ip", F.lit("0.0.0.0")).alias("ip"),
                 F.coalesce("destination_port", F.lit(0)).alias("port"),
                 S.service_name("destination_port").alias("service_name"),
                 S.service_type("destination_port").alias("service_type")).alias("destination"),
        F.struct(F.coalesce("label", F.lit("BENIGN")).alias("label"),
                 F.coalesce("attack_category", F.lit("Normal")).alias("category"),
                 F.coalesce("severity", F.lit("LOW")).alias("severity"),
                 S.is_attack("attack_category").alias("is_attack")).alias("attack"),
        F.struct(F.coalesce("protocol", F.lit("OTHER")).alias("name"),
                 S.transport_layer(F.coalesce("protocol", F.lit("OTHER"))).alias("transport_layer"))
         .alias("protocol"),
        F.struct(F.col("flow_duration").alias("flow_duration"),
                 F.col("fwd_packets").alias("fwd_packets"),
                 F.col("bwd_packets").alias("bwd_packets"),
                 F.col("fwd_bytes").alias("fwd_bytes"),
                 F.col("bwd_bytes").alias("bwd_bytes"),
                 F.col("flow_bytes_per_sec").alias("flow_bytes_per_sec"),
                 F.col("flow_packets_per_sec").alias("flow_pkts_per_sec")).alias("metrics"),
    )


def flatten_document(docs: DataFrame) -> DataFrame:
    """Flat view of the documents (one column per leaf, ``sub_field`` names)."""
    cols = [F.col("event_id"), F.col("timestamp")]
    for f in docs.schema.fields:
        if f.name in ("event_id", "timestamp"):
            continue
        for sub in f.dataType.fields:
            cols.append(F.col(f"{f.name}.{sub.name}").alias(f"{f.name}_{sub.name}"))
    return docs.select(*cols)


def hourly_document_summary(docs: DataFrame) -> DataFrame:
    """Per (hour, label): additive counts and bytes; category and severity
    of the latest arrival (the update sets them last-write-wins)."""
    return (docs.groupBy(S.trunc_ntz("hour", "timestamp").alias("hour_bucket"),
                         F.col("attack.label").alias("attack_label"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.sum(F.col("metrics.fwd_bytes") + F.col("metrics.bwd_bytes")).alias("total_bytes"),
                 F.max_by("attack.category", "event_id").alias("attack_category"),
                 F.max_by("attack.severity", "event_id").alias("severity"),
                 F.max("event_id").alias("last_seq")))
