"""Structured Streaming: typed event stream and the windowed aggregates.

Windows are tumbling and on event time by default (``time_col``); the
watermark bounds state.  Spark only accepts watermarks on TIMESTAMP (not
TIMESTAMP_NTZ), so the NTZ wall-clock time is read as UTC TIMESTAMP (session
time zone UTC) and window bounds are cast back to NTZ.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lookups as L
from ..operators import clean, validate
from ..session import checkpoint_dir, read_or_none
from ..sources import adapter

EVENT_SCHEMA = T.StructType([
    T.StructField("source_ip", T.StringType()), T.StructField("source_port", T.IntegerType()),
    T.StructField("destination_ip", T.StringType()), T.StructField("destination_port", T.IntegerType()),
    T.StructField("protocol", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("flow_duration", T.LongType()), T.StructField("fwd_packets", T.IntegerType()),
    T.StructField("bwd_packets", T.IntegerType()), T.StructField("fwd_bytes", T.LongType()),
    T.StructField("bwd_bytes", T.LongType()), T.StructField("flow_bytes_per_sec", T.DoubleType()),
    T.StructField("flow_packets_per_sec", T.DoubleType()), T.StructField("label", T.StringType()),
    T.StructField("attack_category", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("source_country", T.StringType()), T.StructField("source_region", T.StringType()),
])

RAW_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def stream_flow_events_from_table(spark: SparkSession, sf_dir: str,
                                  max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over ``events.parquet`` -> adapter -> clean -> valid rows."""
    r = spark.readStream.schema(RAW_EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = adapter.events_to_raw_flows(r.parquet(sf_dir))
    return validate.valid_events(clean.clean_flows(raw, ip_format="decimal"), trusted_lookups=True)


def _event_time(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("_et", F.col(time_col).cast("timestamp"))


def _window_cols(w: str = "window"):
    return (F.col(f"{w}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{w}.end").cast("timestamp_ntz").alias("window_end"))


def attack_rate_1min(events: DataFrame, watermark: str = "1 day", time_col: str = "timestamp",
                     window: str = "1 minute") -> DataFrame:
    """Attacks per category per tumbling window (non-Normal only)."""
    e = _event_time(events, time_col).withWatermark("_et", watermark)
    g = (e.filter(F.col("attack_category") != "Normal")
         .groupBy(F.window("_et", window), "attack_category").agg(F.count(F.lit(1)).alias("event_count")))
    ws, we = _window_cols()
    return g.select("attack_category", "event_count", ws, we)


def protocol_rate_1min(events: DataFrame, watermark: str = "1 day", time_col: str = "timestamp",
                       window: str = "1 minute") -> DataFrame:
    """Events per protocol per tumbling window; rows without a protocol are
    left out (no group key)."""
    e = _event_time(events, time_col).withWatermark("_et", watermark)
    g = (e.filter(F.col("protocol").isNotNull())
         .groupBy(F.window("_et", window), "protocol").agg(F.count(F.lit(1)).alias("event_count")))
    ws, _ = _window_cols()
    return g.select("protocol", "event_count", ws)


def high_volume_sources(events: DataFrame, threshold: int = L.HIGH_VOLUME_THRESHOLD,
                        watermark: str = "1 day", time_col: str = "timestamp",
                        window: str = "5 minutes") -> DataFrame:
    """Attack sources with more than ``threshold`` events in a window."""
    e = _event_time(events, time_col).withWatermark("_et", watermark)
    g = (e.filter(F.col("attack_category") != "Normal")
         .groupBy(F.window("_et", window), "source_ip").agg(F.count(F.lit(1)).alias("attack_count"))
         .filter(F.col("attack_count") > threshold))
    ws, _ = _window_cols()
    return g.select("source_ip", "attack_count", ws)


def emit_changes_to_table(agg: DataFrame, path: str, keys: list[str], checkpoint: str,
                          mode: str = "update", time_col: str = "window_start"):
    """Continuous change output kept as a keyed table.

    The table is partitioned by the day of ``time_col``; each micro-batch
    reads only the days it touches, replaces the rows with the same key,
    cuts lineage with a reliable ``checkpoint()`` (it reads the directory it
    is about to overwrite) and overwrites just those day partitions
    (dynamic partition overwrite).  A replayed batch id writes the same
    rows again, so the table is idempotent.
    """
    from ..operators.upsert import replace_by_key

    def upsert(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        checkpoint_dir(spark)          # registers spark.checkpoint.dir for checkpoint()
        b = batch.withColumn("_day", F.to_date(F.col(time_col))).persist()  # the state is computed once
        try:
            stored = read_or_none(spark, path)
            if stored is None:
                merged = b
            else:
                touched = b.select("_day").distinct()
                old = stored.join(touched, "_day", "left_semi").select(*b.columns)
                merged = replace_by_key(old, b, keys + ["_day"]).checkpoint()
            (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_day").parquet(path))
        finally:
            b.unpersist()

    return (agg.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(upsert))


def pull_query(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Current content of a table kept by :func:`emit_changes_to_table`.  With
    the aggregate's ``schema``, a table without rows yet is empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop("_day")
