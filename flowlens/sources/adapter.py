"""Deterministic adapter from the generic ``events`` table to raw flow rows.

The test data has no network-flow files, so raw flows are derived from
``events`` with fixed arithmetic (documented in FIXTURES.md §3).  Each rule
also seeds one kind of dirty input the cleaning steps must handle: zero
addresses, out-of-range ports, non-numeric / missing protocols, infinite
rates and missing labels.  It is a pure projection: no shuffle, and parquet
column pruning reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: destination port by event_id % 8, protocol text by
# event_id % 6, and label by (event_type, k % 5).
DEST_PORTS = [80, 443, 22, 21, 53, 3389, 8080, 55555]
PROTOCOL_TEXT = ["17", "1", "0", "254", "6", "6"]
BENIGN_TYPES = ["view", "click"]
ATTACK_LABELS = {
    "signup": ["DoS Hulk", "DoS slowloris", "DDoS", "Heartbleed", "DoS Hulk - Attempted"],
    "purchase": ["Web Attack - Brute Force", "Web Attack - XSS", "Infiltration",
                 "FTP-Patator", "SSH-Patator"],
    "error": ["Bot", "PortScan", "CompletelyNewAttack", "Botnet - Attempted",
              "Web Attack - Sql Injection"],
}

RAW_FLOW_COLUMNS = [
    "event_id", "source_file", "ts_raw", "src_ip_raw", "dst_ip_raw", "src_port", "dst_port",
    "protocol_raw", "flow_duration", "fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes",
    "flow_bytes_per_sec", "flow_packets_per_sec", "label_raw",
]


def _pick(index: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_to_raw_flows(events: DataFrame) -> DataFrame:
    # parse the JSON field once; the optimizer keeps this projection separate
    # because ``k`` is used many times and is not cheap to recompute
    events = events.select("event_id", "ts", "user_id", "event_type", "value",
                           F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    e = F.col("event_id")
    k = F.col("k")
    v = F.col("value")
    label = F.when(F.col("event_type").isin(*BENIGN_TYPES), F.lit("BENIGN"))
    for etype, labels in ATTACK_LABELS.items():
        label = label.when(F.col("event_type") == etype, _pick(F.pmod(k, F.lit(5)), labels))
    return events.select(
        e.alias("event_id"),
        F.lit("events").alias("source_file"),
        F.col("ts").alias("ts_raw"),
        F.when(F.pmod(e, F.lit(89)) == 5, F.lit(0).cast("bigint"))
         .otherwise(F.lit(1) + F.pmod(F.col("user_id") * F.lit(2654435761), F.lit(4294967294)))
         .alias("src_ip_raw"),
        (F.lit(3232235776) + k).alias("dst_ip_raw"),
        F.when(F.pmod(e, F.lit(127)) == 9, F.lit(70000))
         .otherwise(F.lit(1024) + F.pmod(e, F.lit(16))).cast("int").alias("src_port"),
        _pick(F.pmod(e, F.lit(8)), DEST_PORTS).cast("int").alias("dst_port"),
        F.when(F.pmod(e, F.lit(83)) == 11, F.lit("x"))
         .when(F.pmod(e, F.lit(79)) == 2, F.lit(None).cast("string"))
         .otherwise(_pick(F.pmod(e, F.lit(6)), PROTOCOL_TEXT)).alias("protocol_raw"),
        F.floor(v * 1000).cast("bigint").alias("flow_duration"),
        F.pmod(e, F.lit(50)).cast("int").alias("fwd_packets"),
        F.pmod(k, F.lit(20)).cast("int").alias("bwd_packets"),
        F.floor(v * 10).cast("bigint").alias("fwd_bytes"),
        (k * 100).cast("bigint").alias("bwd_bytes"),
        F.when(F.pmod(e, F.lit(97)) == 3, F.lit(float("inf"))).otherwise(v * 100)
         .alias("flow_bytes_per_sec"),
        v.alias("flow_packets_per_sec"),
        F.when(F.pmod(e, F.lit(101)) == 7, F.lit(None).cast("string")).otherwise(label)
         .alias("label_raw"),
    )


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flows (decimal addresses, text protocol, raw label) from ``events``."""
    return events_to_raw_flows(read_events(spark, sf_dir))
