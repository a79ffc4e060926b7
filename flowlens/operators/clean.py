"""Cleaning of raw flow rows into flow events.

The order of the steps is part of the contract (a missing protocol becomes 0
and therefore HOPOPT before decoding; a missing decimal address becomes
0.0.0.0 before rows with missing addresses are dropped).  All steps are
narrow projections and filters; the only window is the optional timestamp
rebuild, which is bounded to one read chunk per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lookups as L
from ..functions import scalars as S

EVENT_COLUMNS = [
    "event_id", "source_ip", "source_port", "destination_ip", "destination_port", "protocol",
    "timestamp", "flow_duration", "fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes",
    "flow_bytes_per_sec", "flow_packets_per_sec", "label", "attack_category", "severity",
    "source_country", "source_region",
]

NUMERIC_RAW = ["src_port", "dst_port", "flow_duration", "fwd_packets", "bwd_packets",
               "fwd_bytes", "bwd_bytes", "flow_bytes_per_sec", "flow_packets_per_sec"]


def _to_ip(col: str, ip_format: str, numeric: bool = False) -> Column:
    if ip_format == "by row":
        return F.when(F.col("_ip_format") == "decimal", S.decimal_to_ip(col)).otherwise(_to_ip(col, "auto"))
    if ip_format == "decimal":
        return S.decimal_to_ip(col, numeric)
    if ip_format == "dotted":
        return S.py_strip(F.col(col).cast("string"))
    return F.when(S.looks_decimal_ip(col), S.decimal_to_ip(col)).otherwise(
        S.py_strip(F.col(col).cast("string")))


def _finite(col: str) -> Column:
    d = S.tc(F.col(col), "double") if not isinstance(col, Column) else col
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)).otherwise(d)


def rebuilt_timestamps(df: DataFrame, chunk_size: int = L.READ_CHUNK_ROWS,
                       start_hour: int = L.REBUILD_START_HOUR,
                       end_hour: int = L.REBUILD_END_HOUR) -> Column:
    """Even spacing of truncated 'MM:SS.S' stamps over the working day.

    Needs ``line_no`` (position of the accepted line in its file) and
    ``source_file``.  Rows of one read chunk (``line_no div chunk_size``) that
    survived cleaning are spaced evenly from ``start_hour`` to ``end_hour`` on
    the weekday named by the file (default Monday).  The window is bounded:
    at most ``chunk_size`` rows per group.
    """
    chunk = F.floor(F.col("line_no") / F.lit(chunk_size))
    w = Window.partitionBy("source_file", chunk, "_trunc")
    pos = F.row_number().over(w.orderBy("line_no")) - 1
    n = F.count(F.lit(1)).over(w)
    stem = F.lower(F.regexp_extract(F.col("source_file"), r"^([^-_.]*)", 1))
    base = F.coalesce(S.lookup(L.FILE_DAY_DATES, stem), F.lit(L.DEFAULT_FILE_DATE))
    start = F.to_timestamp_ntz(F.concat(base, F.lit(f" {start_hour:02d}:00:00")))
    span_us = (end_hour - start_hour) * 3600 * 1_000_000
    offset = F.when(n <= 1, F.lit(0)).otherwise(
        F.round(pos * F.lit(span_us) / (n - 1)).cast("bigint"))
    return F.timestamp_add("MICROSECOND", offset, start)


def clean_flows(raw: DataFrame, ip_format: str = "auto", chunk_size: int = L.READ_CHUNK_ROWS,
                observations: tuple[Observation, Observation] | None = None) -> DataFrame:
    """Raw flows -> typed flow events (18 fields + event_id).

    ``raw`` has the columns of ``sources.adapter.RAW_FLOW_COLUMNS`` (plus an
    optional ``line_no`` when text stamps may need rebuilding).  Pass two
    ``Observation`` objects (before, after) to count rows in the same pass
    as the cleaning; read them with :func:`clean_stats`.
    """
    df = raw
    if ip_format == "auto" and "_ip_format" in raw.columns:  # files of both dialects: each row by its file's
        ip_format = "by row"
    if observations is not None:
        df = df.observe(observations[0], F.count(F.lit(1)).alias("rows_before"))
    # 1. addresses: decimal -> dotted quad (a missing decimal becomes 0.0.0.0)
    def numeric(c):
        return isinstance(raw.schema[c].dataType, (T.LongType, T.IntegerType, T.DoubleType))
    df = df.withColumns({"source_ip": _to_ip("src_ip_raw", ip_format, numeric("src_ip_raw")),
                         "destination_ip": _to_ip("dst_ip_raw", ip_format, numeric("dst_ip_raw"))})
    # 2. +-Infinity (and NaN, also as text) -> null
    inexact = (T.StringType, T.DoubleType, T.FloatType)
    df = df.withColumns({c: _finite(c) for c in NUMERIC_RAW if isinstance(raw.schema[c].dataType, inexact)})
    if isinstance(raw.schema["protocol_raw"].dataType, inexact):
        number = S.tc(F.col("protocol_raw"), "double")
        df = df.withColumn("protocol_raw", F.when(number.isNull() | _finite(number).isNotNull(), F.col("protocol_raw")))
    # 3. drop rows without addresses, label or timestamp
    ts_is_text = isinstance(raw.schema["ts_raw"].dataType, T.StringType)
    ts_missing = F.col("ts_raw").isNull()
    if ts_is_text:
        ts_missing = ts_missing | (S.py_strip(F.col("ts_raw")) == "")
    df = df.filter(F.col("source_ip").isNotNull() & F.col("destination_ip").isNotNull()
                   & F.col("label_raw").isNotNull() & ~ts_missing)
    # 4. remaining nulls -> 0
    fills = {c: F.coalesce(S.tc(F.col(c), "double"), F.lit(0.0)) for c in NUMERIC_RAW}
    fills["protocol_raw"] = F.coalesce(F.col("protocol_raw").cast("string"), F.lit("0"))
    df = df.withColumns(fills)
    # 5. timestamps: typed as is; text parsed day-first, truncated stamps rebuilt
    if ts_is_text:
        df = df.withColumn("_trunc", S.is_truncated_stamp("ts_raw"))
        if "line_no" in df.columns:
            df = df.withColumn("timestamp", F.when(F.col("_trunc"), rebuilt_timestamps(df, chunk_size))
                               .otherwise(S.parse_flow_timestamp("ts_raw")))
        else:
            df = df.withColumn("timestamp", S.parse_flow_timestamp("ts_raw"))
        df = df.filter(F.col("timestamp").isNotNull()).drop("_trunc")
    else:
        df = df.withColumn("timestamp", F.col("ts_raw").cast("timestamp_ntz"))
    # 6. protocol number -> name (text that is not a number -> OTHER)
    df = df.withColumn("protocol", S.protocol_name(S.protocol_code("protocol_raw")))
    # 7. label variants, category, severity
    # (key / base / geo are their own columns so each is evaluated once)
    df = df.withColumn("label", S.normalise_label(F.col("label_raw").cast("string")))
    df = df.withColumn("_key", S.label_key("label"))
    df = df.withColumn("_base", S.label_base("_key"))
    df = df.withColumn("attack_category", S.category_from_key("_key", "_base"))
    df = df.withColumn("severity", S.severity_from_key("_key", "attack_category"))
    # 8. pseudo geolocation
    df = df.withColumn("_geo", S.geo("source_ip"))
    df = df.withColumns({"source_country": F.col("_geo.country"),
                         "source_region": F.col("_geo.region")})
    out = to_event(df)
    if observations is not None:
        out = out.observe(observations[1], F.count(F.lit(1)).alias("rows_after"))
    return out


def clean_stats(observations: tuple[Observation, Observation]) -> dict:
    """rows before / after / dropped, once an action ran on the cleaned frame."""
    before = observations[0].get.get("rows_before", 0)
    after = observations[1].get.get("rows_after", 0)
    return {"rows_before": before, "rows_after": after, "rows_dropped": before - after}


def _trunc_int(col: str, dtype: str) -> Column:
    # python int(): truncate toward zero; out of range -> null (validation rule)
    return S.tc(F.col(col), dtype)


def to_event(df: DataFrame) -> DataFrame:
    """Project to the 18 typed event fields plus the arrival sequence."""
    return df.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("source_ip").cast("string").alias("source_ip"),
        _trunc_int("src_port", "int").alias("source_port"),
        F.col("destination_ip").cast("string").alias("destination_ip"),
        _trunc_int("dst_port", "int").alias("destination_port"),
        F.col("protocol"),
        F.col("timestamp"),
        _trunc_int("flow_duration", "bigint").alias("flow_duration"),
        _trunc_int("fwd_packets", "int").alias("fwd_packets"),
        _trunc_int("bwd_packets", "int").alias("bwd_packets"),
        _trunc_int("fwd_bytes", "bigint").alias("fwd_bytes"),
        _trunc_int("bwd_bytes", "bigint").alias("bwd_bytes"),
        F.col("flow_bytes_per_sec").cast("double"),
        F.col("flow_packets_per_sec").cast("double"),
        F.col("label"), F.col("attack_category"), F.col("severity"),
        F.col("source_country"), F.col("source_region"),
    )


def sort_chunk(events: DataFrame) -> DataFrame:
    """Order events by time inside each partition before publishing."""
    return events.sortWithinPartitions("timestamp")
