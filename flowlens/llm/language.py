"""Language by compression: the language whose dictionary compresses a text best.

1. From labelled rows that are not held out, SAMPLE documents of each language
   (those with the smallest hash of their id) each give a window of WINDOW
   characters at a hash-chosen place; together they are the raw-content
   dictionary of that language for zstandard.
2. Every whole text, reduced to lower-case letters and single spaces, is
   compressed with each dictionary, in pieces of PIECE characters that each
   start from the dictionary alone (pieces of up to SHORT bytes with more
   effort, as they leave less to tell languages apart); the smallest sum of
   sizes names the language.  Of equal ones the language with more learned rows is
   taken, then the smaller name.
3. ``score`` is 1 - smallest / second smallest.  A text whose score is below
   MARGIN is rejected: ``lang`` is "und", while ``lang_pred`` still tells the
   best guess.

Dictionaries tell languages by the words, word parts and word pairs they share
with a text, not by how frequent single letters are.  The dictionaries (languages x SAMPLE x WINDOW characters) are all that reaches
the driver; languages are a catalogue.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

SAMPLE, WINDOW = 256, 512
LEVEL, SHORT, SHORT_LEVEL = 6, 512, 11
MARGIN = 0.01
UNKNOWN = "und"
#: Characters that are compressed at once: within a longer piece a text would
#: become its own dictionary, and the language's would no longer count.
PIECE = 4096

_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    """Languages, the more frequent first, and a dictionary for each."""

    languages: list[str] = field(default_factory=list)
    contents: list[bytes] = field(default_factory=list)


def held_out() -> Column:
    """True for rows that nothing is learned from; rows without doc_id too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def letters(text: str | None) -> str:
    """``text`` in lower case with one space for each run of other characters;
    empty if there is no letter in it."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return words if any(map(str.isalpha, words)) else ""


def train(docs: DataFrame, sample: int = SAMPLE, window: int = WINDOW) -> Model:
    """Dictionaries from ``docs`` (doc_id, text, lang).  Rows that are held out,
    have no doc_id, language or text are left out."""
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND length(trim(text)) > 0").where(~held_out())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    first = Window.partitionBy("lang").orderBy("h", "at", "part")
    h = F.xxhash64("doc_id", F.lit(13))
    at = F.pmod(F.xxhash64("doc_id", F.lit(14)), F.greatest(F.length("text") - window + 1, F.lit(1))).cast("int")
    chosen = (known.withColumn("h", h).withColumn("at", at).select("lang", "h", "at", F.expr(f"substring(text, at + 1, {window})").alias("part"))
              .withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample).collect())
    by_lang: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["r"])):
        by_lang.setdefault(r["lang"], []).append(letters(r["part"]))
    order = sorted((lang for lang in by_lang if any(by_lang[lang])), key=lambda lang: (-counts[lang], lang))
    return Model(order, [" ".join(by_lang[lang]).encode() for lang in order])


class Judge:
    """Language and score of a text."""

    def __init__(self, model: Model):
        self.languages = model.languages
        self.coders = {level: [self._coder(c, level) for c in model.contents] for level in (LEVEL, SHORT_LEVEL)}

    @staticmethod
    def _coder(content: bytes, level: int) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level)
        return zstandard.ZstdCompressor(dict_data=known, write_checksum=False, write_content_size=False)

    def _sizes(self, text: str) -> list[int]:
        """Compressed sizes of the whole text, by language."""
        total, some = [0] * len(self.languages), False
        for at in range(0, len(text), PIECE):
            part = letters(text[at:at + PIECE]).encode()
            if part:
                some = True
                coders = self.coders[SHORT_LEVEL if len(part) <= SHORT else LEVEL]
                total = [n + len(c.compress(part)) for n, c in zip(total, coders)]
        return total if some else []

    def __call__(self, text: str | None) -> tuple[str, float]:
        sizes = self._sizes(text) if text else []
        if not sizes:
            return UNKNOWN, 0.0
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1:]
        return self.languages[best], 1 - sizes[best] / min(others) if others else 1.0


def _judged(model: Model):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Judge(model)
        for batch in batches:
            found = [one(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return judge


def identify(docs: DataFrame, model: Model | None = None, margin: float = MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score and lang of every row of ``docs``
    (doc_id, text, and lang unless a ``model`` is given).

    A null text or one without a letter gets "und" with score 0, as do all
    texts where nothing was learned.  With a single learned language the score
    is 1.  Rows that repeat are judged alike; ties as above.  An empty table
    gives an empty result; other columns are not read.
    """
    model = train(docs) if model is None else model
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    judged = rows.mapInArrow(_judged(model), "doc_id bigint, held_out boolean, lang_pred string, score double")
    return judged.withColumn("lang", F.when(F.col("score") >= margin, F.col("lang_pred")).otherwise(UNKNOWN))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
