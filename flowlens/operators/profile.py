"""Data profiling of raw flow rows.

Column statistics are computed as one wide aggregation (every column's
aggregates in the same job, map-side partial), then turned into rows with
``unpivot``; nothing is collected to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lookups as L
from ..functions import scalars as S
from ..session import scratch_path

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, type, and the table's row count."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    cols = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"))
                     for i, f in enumerate(df.schema.fields)])
    return n.select(F.inline(cols), "n_rows").withColumn("n_columns", F.lit(len(df.columns)))


def _finite(c: str):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def ranked_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, x, n, before): every distinct finite value of each column, how often
    it occurs and how many values of its column are smaller.

    Values are counted first (map-side partials, so a value that half the rows
    share is one row), then range-partitioned and written; the totals of the
    ranges are the offsets of the running sums inside each range.
    """
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), _finite(c).alias("x")) for c in cols])).alias("v")) \
        .select("v.c", "v.x").filter(F.col("x").isNotNull())
    counts = long.groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, f"profile/{uuid.uuid4().hex[:12]}")
    counts.repartitionByRange("c", "x").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("c", "part").agg(F.sum("n").alias("s")) \
        .select("c", "part", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("c", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    return (ranges.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(offsets, ["c", "part"])
            .select("c", "x", "n", (F.col("offset") + F.col("inside")).alias("before")))


def profile_describe(df: DataFrame, cols: list[str] | None = None,
                     probs: tuple[float, float, float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation between order
    statistics, as a data-frame describe does), max for each numeric column;
    infinities are left out.  Moments are one wide aggregation; the order
    statistics are picked by rank from :func:`ranked_values`."""
    cols = cols or numeric_columns(df)
    names = ("q25", "q50", "q75")
    aggs = []
    for c in cols:
        fin = _finite(c)
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(fin).alias("count"), F.avg(fin).alias("mean"),
                             F.stddev_samp(fin).alias("std"), F.min(fin).alias("min"), F.max(fin).alias("max")).alias(c))
    moments = df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
    ranked = ranked_values(df, cols).join(moments.select(F.col("column_name").alias("c"), "count"), "c")
    picks = []
    for name, p in zip(names, probs):
        at = (F.col("count") - 1) * F.lit(p)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(holds, F.col("x"))).alias(f"{name}_{side}"))
    order = ranked.groupBy(F.col("c").alias("column_name")).agg(*picks)
    out = moments.join(order, "column_name", "left")
    quartiles = []
    for name, p in zip(names, probs):
        at = (F.col("count") - 1) * F.lit(p)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        quartiles.append((lo + (at - F.floor(at)) * (hi - lo)).alias(name))
    return out.select("column_name", "count", "mean", "std", "min", *quartiles, "max")


def label_counts(df: DataFrame, col: str = "label_raw") -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("label"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "label"))


def protocol_share(df: DataFrame, col: str = "protocol_raw") -> DataFrame:
    """Counts and share (%) under the notebook's own short protocol map."""
    code = S.tc(F.col(col), "int")
    name = S.lookup(L.PROFILE_PROTOCOL_NAMES, code, "OTHER")
    g = df.groupBy(name.alias("protocol_name")).agg(F.count(F.lit(1)).alias("count"))
    from ..plans.common import q_half_up
    # the total is a window over the handful of aggregated rows
    total = F.sum("count").over(Window.partitionBy())
    return g.withColumn("pct", q_half_up(F.col("count") * 100, total, 1))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and % per column, only columns that have any."""
    n = F.count(F.lit(1))
    aggs = [n.alias("__n")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    long = wide.select("__n", F.inline(rows))
    from ..plans.common import q_half_up
    return (long.filter(F.col("nulls") > 0)
            .select("column_name", "nulls", q_half_up(F.col("nulls") * 100, F.col("__n"), 2).alias("pct")))


def inf_profile(df: DataFrame) -> DataFrame:
    cols = [c for c in numeric_columns(df)]
    aggs = [F.count_if(F.abs(F.col(c).cast("double")) == F.lit(float("inf"))).alias(c) for c in cols]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("inf_count")) for c in cols])
    return wide.select(F.inline(rows)).filter(F.col("inf_count") > 0)


def ts_range(df: DataFrame, col: str = "ts_raw") -> DataFrame:
    ts = F.col(col)
    g = df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
    span = F.unix_micros(F.col("latest").cast("timestamp")) - F.unix_micros(F.col("earliest").cast("timestamp"))
    return g.select("earliest", "latest", (span / 1_000_000).alias("span_seconds"))


def top_attack_ips(df: DataFrame, ip: str = "src_ip_raw", label: str = "label_raw",
                   limit: int = 10) -> DataFrame:
    """Top sources of rows whose label is not BENIGN (a missing label counts
    as not BENIGN, as a pandas comparison does)."""
    rows = df.filter(F.col(label).isNull() | (F.col(label) != F.lit("BENIGN")))
    g = rows.groupBy(F.col(ip).cast("string").alias("source_ip")).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.desc("count"), "source_ip").limit(limit)
