"""Dense serial keys by first arrival, and exact distinct counts as bitmaps over them.

Keys are numbered by a range sort on their first arrival: every range numbers its
rows from 0 and is shifted by the sizes of the ranges before it, so nothing is
numbered in one task and the numbers have no gaps.  A batch numbers only keys
that no batch before it has, above the largest number given so far; numbers
never change.  Each batch writes its new keys to a folder of its own, and reads
only those of smaller batches, so a replayed batch writes the same rows again.

Dense numbers make distinct counts mergeable: the numbers of a group are kept as
bitmaps of 32,768 bits, one for each stretch of numbers that occurs in the group.
Bitmaps of hours, days and batches are joined by OR, where finished counts could
not be added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read_or_none
from .summaries import hour_of_key

ROW_BITS = 33  # of monotonically_increasing_id; the bits above are the partition
TASK_ROWS = 1 << 16  # rows that a task makes bitmaps of, so at most as many bitmaps (of 4 KB each)


def numbered(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... in ``order``, without gaps), written to
    ``path``: a range sort may cut differently when it is computed again, so
    the places are taken from what was written.  ``order`` has to tell all rows
    apart for the places to be the same each time."""
    spark = rows.sparkSession
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path))
    written = spark.read.parquet(path)
    part = F.shiftright("_at", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")) \
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (written.withColumn("_part", part).join(F.broadcast(sizes), "_part")  # as many rows as ranges
            .withColumn("place", F.col("_before") + F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)).drop("_part", "_before", "_at"))


def serials(spark: SparkSession, base: str, before: int | None = None) -> DataFrame | None:
    """All numbered keys (of batches below ``before``), or None without any."""
    rows = read_or_none(spark, f"{base}/keys")
    if rows is None:
        return None
    return (rows if before is None else rows.filter(F.col("batch_id") < before)).drop("batch_id")


def extend_serials(batch: DataFrame, keys: list[str], arrival: str, base: str, batch_id: int) -> DataFrame:
    """Number the keys that ``batch`` is the first to have: ``serial`` from 1, by
    the least ``arrival`` of each key (ties by the keys).  Returns the new rows."""
    spark = batch.sparkSession
    fresh = batch.groupBy(*keys).agg(F.min(arrival).alias("first_arrival"))
    known = serials(spark, base, batch_id)
    largest = 0
    if known is not None:
        largest = known.agg(F.max("serial")).first()[0] or 0
        fresh = fresh.join(known.select(*keys), keys, "left_anti")
    placed = numbered(fresh, ["first_arrival", *keys], f"{base}/ranges/batch_id={batch_id}")
    path = f"{base}/keys/batch_id={batch_id}"
    placed.select(*keys, "first_arrival", (F.col("place") + largest + 1).alias("serial")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --------------------------------------------------------- distinct as bitmaps

def source_bitmaps(fact: DataFrame, numbers: DataFrame, by: dict[str, Column], together: list[str] | None = None) -> DataFrame:
    """The sources of each group as bitmaps: the group's columns, ``stretch`` and
    ``sources``.  ``numbers`` holds source_key and serial.  Rows are reduced to
    distinct keys before they meet the numbers.

    A bitmap takes 4 KB for a few sources, so the numbers are shuffled and not the
    bitmaps: groups alike in ``together`` (all of ``by``) and ``stretch`` are dealt to
    one task, where coarser groups by these columns merge without a shuffle.  The
    tasks rise with the rows; their memory doesn't."""
    distinct = fact.select(*[c.alias(n) for n, c in by.items()], "source_key").distinct()
    numbered = distinct.join(numbers.select("source_key", "serial"), "source_key") \
        .withColumn("stretch", F.bitmap_bucket_number("serial"))
    tasks = -(-fact.count() // TASK_ROWS) or 1
    return (numbered.repartition(tasks, *(by if together is None else together), "stretch").groupBy(*by, "stretch")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("serial")).alias("sources")))


def merge_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several batches."""
    return bitmaps.groupBy(*by, "stretch").agg(F.bitmap_or_agg("sources").alias("sources"))


def distinct_sources(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Number of distinct sources of each group: stretches don't overlap."""
    return merge_bitmaps(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("sources")).alias("unique_sources"))


def hourly_source_bitmaps(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    return source_bitmaps(fact, numbers, {"hour_bucket": hour_of_key(), "attack_key": F.col("attack_key")}, ["attack_key"])

