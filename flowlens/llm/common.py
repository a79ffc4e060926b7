"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path

# functions travel to the executors by value, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__package__])

def prepare(spark: SparkSession) -> None:
    """Settings every operator here assumes.  Arrow batches are kept small, so
    a batch of very long texts still fits a Python worker."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read again:
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def crc32_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and an order-free sum that change when the edge set does."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u and v > m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b) of any ordered type.

    Alternating large- and small-star rounds; every round is joins and
    partial aggregates over the edges and is written before the next, so
    nothing but two numbers a round reaches the driver.  Returns (node, label)
    with the smallest node of the component as label; isolated nodes have no
    row.  Fails, rather than give a wrong answer, if it hasn't settled after
    ``rounds`` rounds (it halves paths, so 60 are enough for any graph).
    """
    now = stored(edges.where("a is not null and b is not null and a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    before = _fingerprint(now)
    for k in range(rounds):
        if not before[0]:
            break
        now = stored(_small_star(_large_star(now)), f"{name}-round{k}")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"{name}: components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


def spread(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``h``, the md5 hex text of the ``key`` columns (null apart
    from any text), for use as a pseudo-random order.

    Rows equal in the whole key are interchangeable, but many of them would
    land in one place; where a key repeats n times, its rows get one of n
    further hashes each by their place in the (stored) input.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in key]
    rows = rows.withColumn("h0", F.md5(F.concat_ws("|", *parts))).withColumn("at", F.monotonically_increasing_id())
    often = rows.groupBy("h0").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    salted = F.md5(F.concat_ws("|", "h0", F.col("at") % F.col("copies")))
    return (rows.join(often, "h0", "left")
            .withColumn("h", F.when(F.col("copies").isNull(), F.col("h0")).otherwise(salted)).drop("h0", "copies"))


def leading_bits(h: str, bits: int) -> Column:
    """The first ``bits`` (a multiple of 4) of a hex text as a number."""
    return F.conv(F.substring(h, 1, bits // 4), 16, 10).cast("bigint")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
