"""Mixing sources to target weights, cut at each source's exact budget.

Every document has a pseudo-random key, the md5 of its id and text, so a
source's documents have a random order that any run repeats.  Keys are dealt
out by range: 2^12 cells of key ranges in each source.  Word totals per cell
and their running sums within the source (at most 2^12 rows a source) give the
offset of each cell, a window inside each cell the offset of each document: a
distributed prefix sum in which no task holds a whole source.  A document's
words then lie at [before, before + size) of its source's order, and the budget
cuts that order at an exact word.  Budgets above the source's size go round
again: the second epoch repeats the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import leading_bits, spread, stored, table, unused

WEIGHTS = (5, 2, 1)
SHARE, MOST_EPOCHS = 1.5, 2
CELL_BITS = 12
WORD, WORDLESS = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Weights repeat over the sources in code point order, null last.  Water
    filling: by rising size per weight, a source whose share reaches
    MOST_EPOCHS times its size stops there, and the rest is shared by weight
    among those after it.  There is one row a source here, a catalogue that one
    task holds.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1)
    ranked = sources.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * float(MOST_EPOCHS))
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    ranked = (ranked.withColumn("all_words", F.sum("source_size").over(every) * SHARE)
              .withColumn("left", F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
              .withColumn("full", F.col("left") / F.sum("weight").over(after) * F.col("weight") >= F.col("most")))
    level = ((F.first("all_words").over(every) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(every))
             / F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every))
    return ranked.select("source", "source_size", F.when(F.col("full"), F.col("most"))
                         .otherwise(F.col("weight") * level).alias("target"))


def mixture(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size
    (words), source_size, target, taken (words that the mix takes, repeats
    counted), text_md5 and, where ``row`` names a column, that as row.

    A null text has no words; texts without words are never taken.  The null
    source is a source of its own, the empty string another.  Rows equal in
    doc_id and text are interchangeable and spread over the order.  An empty
    table gives an empty result; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.md5(text.cast("binary")).alias("text_md5"),
                       (F.col(row) if row else F.lit(None).cast("bigint")).alias("row"))
    rows = spread(stored(rows, "mix-rows"), "doc_id", "text_md5")
    # a source's name as a key that is never null
    rows = rows.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))) \
        .withColumn("cell", leading_bits("h", CELL_BITS).cast("int"))
    cells = stored(rows.groupBy("src", "cell").agg(F.first("source").alias("source"), F.sum("size").alias("words")), "mix-cells")
    sources = targets(cells.groupBy("src").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
                      .select("source", "source_size")) \
        .withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")
    earlier = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_before", F.coalesce(F.sum("words").over(earlier), F.lit(0))) \
        .select("src", "cell", "cell_before").join(sources, "src")
    inside = Window.partitionBy("src", "cell").orderBy("h", "doc_id", "at").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(cells, ["src", "cell"]) \
        .withColumn("before", F.col("cell_before") + F.col("inside"))
    budget = F.floor(F.col("target") + 0.5)
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), budget - epoch * F.col("source_size") - F.col("before")))
                 for epoch in range(MOST_EPOCHS)), F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"),
                         "text_md5", "row")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed rows of ``docs``, all columns: a document appears once for each
    epoch that takes it, whole, but for the one document of each source at
    which the budget ends; of that one, the budget's words remain (joined by
    single spaces, with n_chars, if there, counted again).  Documents that the
    mix doesn't take are left out.
    """
    row = unused(docs, "mix_row")
    docs_ = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    whole, part = unused(docs, "mix_whole"), unused(docs, "mix_part")
    took = mixture(docs_, row).where("taken > 0").select(
        F.col("row").alias(row), F.expr("taken div size").cast("int").alias(whole), F.expr("taken % size").cast("int").alias(part))
    pieces = F.concat(F.array_repeat(F.lit(0), F.col(whole)), F.when(F.col(part) > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    mixed = docs_.join(took, row).withColumn(part, F.explode(pieces))
    words = F.filter(F.split("text", WORDLESS), lambda w: w != "")
    cut = F.col(part) > 0
    mixed = mixed.withColumn("text", F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col(part)), " ")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return mixed.select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).drop("text_md5", "row")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce("text", ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS size,
         md5('=' || doc_id || '|=' || md5(coalesce("text", ''))) AS h
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, sum(source_size) OVER () * 1.5::DOUBLE AS all_words,
         coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_,
         sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM totals),
capped AS (SELECT *, (all_words - before_) / rest * weight >= most AS is_full FROM ranked),
target AS (
  SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * (
           (first(all_words) OVER () - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())
           / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ()) END AS target
  FROM capped),
placed AS (
  SELECT s.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (greatest(0, least(size, budget - before_)) + greatest(0, least(size, budget - source_size - before_)))::BIGINT AS taken
FROM placed
"""
