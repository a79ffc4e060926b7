"""Spelling variants: words of a corpus that are one edit apart.

1. Every text's runs of letters are counted by word in Arrow batches (one map
   of words a task, flushed at HELD words), then summed: the shuffle moves
   distinct words, not occurrences.
2. Near words by asymmetric q-chunks.  Of a pair the shorter word r (of length
   L) gives two disjoint chunks, its halves; the other word, of length L or
   L + 1, gives its positional grams of the chunks' lengths.  One edit lies
   within one half, so the other half is a gram of the longer word, shifted by
   one if the insertion came before it: only grams within shift one of a
   chunk's place can match, and only those are emitted.  Chunks and grams meet
   by a hash of (L, half, gram) in an equi-join.
3. A chunk that many words share (a frequent prefix, say) would make all pairs
   of its words.  Where a bucket holds more than CROWD candidates, its words
   are not paired but chunked again: the edit is known to lie in the other
   half, whose halves are the next chunks.  The rounds end when no bucket is
   crowded or the part that holds the edit has a single letter; nothing is
   dropped, and no bucket makes more than CROWD candidates but those of a single letter.
4. Every candidate is verified by edit distance.

Forms (the much more frequent near word) are followed to their roots by pointer
doubling: every form is at least RATIO times as frequent, so a path has at most
log(2^63) / log(RATIO) steps.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, union_all

LETTERS, OCCURRENCES, RATIO = 7, 2, 10
DAMAGED = 31
CROWD = 256
#: Words held by a task before they are passed on; bytes of a text read at once.
HELD, PIECE = 1 << 17, 1 << 20

#: Runs of [A-Za-zÀ-ÿ] in UTF-8, after A-Z are lowered.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_BETWEEN = re.compile(rb"[\x00-`{-\x7f]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between runs."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def damaged(word: bytes, h: int) -> bytes:
    """``word`` without its code point h % length."""
    points = word.decode()
    at = h % len(points)
    return (points[:at] + points[at + 1:]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            seed = zlib.crc32(b"" if doc is None else b"%d" % doc)
            seed = zlib.crc32(b":", seed)
            for piece in _pieces((text.as_py() or b"").lower()):
                for word, n in Counter(_RUN.findall(piece)).items():
                    if len(word) < LETTERS:  # bytes are no fewer than code points
                        continue
                    h = zlib.crc32(word, seed)
                    total[damaged(word, h) if h % DAMAGED == 0 else word] += n
            if len(total) >= HELD:
                yield out()
                total.clear()
    if total:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of LETTERS code points and OCCURRENCES or more."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return (rows.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= OCCURRENCES) & (F.char_length("word") >= LETTERS)))


def _halved(rows: DataFrame) -> DataFrame:
    """Two rows for each: the half of the part [lo, hi) that is kept joins the
    key, the other half is the part that is left.  ``late`` is 1 for the longer
    word of a pair, whose second half lies one place later."""
    halves = F.expr("""explode(array(
        struct(xxhash64(key, 0, substring(word, lo + 1, mid - lo)) AS key, mid AS lo, hi AS hi),
        struct(xxhash64(key, 1, substring(word, mid + 1 + late, hi - mid)) AS key, lo AS lo, mid AS hi)))""")
    return (rows.withColumn("mid", F.expr("(lo + hi) div 2").cast("int")).select("word", "n", "late", halves.alias("h"))
            .select("h.key", "h.lo", "h.hi", "late", "word", "n"))


def _near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): every unordered pair of ``words`` (word, n) one edit
    apart, perhaps more than once."""
    start = F.expr("explode(array(struct(len AS hi, 0 AS late), struct(len - 1 AS hi, 1 AS late)))")
    rows = (words.withColumn("len", F.char_length("word")).select("word", "n", start.alias("s"))
            .select("word", "n", "s.hi", "s.late", F.lit(0).alias("lo"), F.xxhash64("s.hi").alias("key")))
    found = []
    while True:
        rows = stored(_halved(rows), "spelling-chunks")
        buckets = rows.groupBy("key").agg(F.sum(F.lit(1) - F.col("late")).alias("short"), F.sum("late").alias("long"), F.max(F.col("hi") - F.col("lo")).alias("part"))
        pairs = F.expr("CAST(short AS DOUBLE) * (short - 1) / 2 + CAST(short AS DOUBLE) * long")
        buckets = buckets.withColumn("crowded", (pairs > CROWD) & (F.col("part") > 1)).where(pairs > 0).select("key", "crowded")
        rows = stored(rows.join(buckets, "key"), "spelling-buckets")
        few = rows.where("NOT crowded")
        one = few.where("late = 0").select("key", F.col("word").alias("a"), F.col("n").alias("na"))
        two = few.select("key", "late", F.col("word").alias("b"), F.col("n").alias("nb"))
        found.append(stored(one.join(two, "key").where("(late = 1 OR a < b) AND levenshtein(a, b, 1) = 1").select("a", "na", "b", "nb"), "spelling-pairs"))
        rows = rows.where("crowded").drop("crowded")
        if rows.isEmpty():
            return union_all(found)


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: every word with each word one edit apart."""
    pairs = _near_pairs(words)
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root for every word of ``forms`` (word, form)."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    steps = math.log(2**63) / math.log(RATIO)
    for _ in range(math.ceil(math.log2(steps))):
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(up, "root", "left_semi").isEmpty():
            break
        now = stored(now.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return now


def variants(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near,
    form_n.

    Null and empty texts have no words; a null doc_id counts as empty text in
    the hash that damages words.  Rows that repeat count again.  Ties between
    near words go to the smallest in code-point order.  An empty table gives an
    empty result; other columns of ``docs`` are not read.  A run of letters of
    any length is one word.
    """
    words = stored(vocabulary(docs), "spelling-words")
    best = (near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")))
    judged = words.join(best, "word", "left").withColumn("far", F.coalesce(F.col("near_n") >= RATIO * F.col("n"), F.lit(False)))
    judged = stored(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("far"), F.col("near")).alias("form"),
                                  F.when(F.col("far"), F.col("near_n")).alias("form_n")), "spelling-forms")
    return judged.join(roots(judged.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
