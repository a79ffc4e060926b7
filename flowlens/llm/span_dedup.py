"""Substring deduplication by sliding spans of consecutive sentence parts.

A part ends at . ! ? … , ; : | (or their ideographic, Khmer and Burmese kin) or a
line end.  Chinese, Japanese, Thai, Lao, Khmer and Burmese are written without
spaces, so there each character stands as a word that counts for less (two make a
word of the first two, four of the others); any other run between white space
and marks is one word, however long.  Where WINDOW words in a row have
no such end, a part ends after the one with the least checksum (the last of
equal ones), so every part has WINDOW words at most, and whether it ends after a
word depends on the WINDOW - 1 words on either side alone, not on how the
sentence around goes on.  From each part on, the fewest consecutive parts that
hold WORDS words at least make a span; every span is hashed (words only, so
spacing within a line doesn't matter).

Every run of 3 * WINDOW + WORDS - 3 = 51 words holds a whole span that every copy
of the run has too, wherever the run starts: a part starts at word WINDOW at the
latest (from 0), its span's last word is 2 * WINDOW + WORDS - 2 at the latest,
and the WINDOW - 1 words from there on settle that no copy ends it earlier.
Shorter repeats are found if they start and end at marks, otherwise by chance.

The first place of a span, by doc_id and then place, keeps its text.  All
parts covered by any span that is not the first are removed.

Keys that repeat come from a count over 64 bits of the hash with map-side
partials, so the one key of a very common passage is combined before the shuffle;
all spans are joined with those few, where a hot key's rows can be split.  Only
what repeats is then held against its first place, by 96 bits.  Places travel as
the span's number in its text; texts that lose something are divided again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

WORDS, WINDOW = 24, 10
MARKS = ".!?…,;:|。｡．！？，、､；：｜។៕၊။"
#: Letters of scripts without spaces, by how many make a word.
TWO = "\u3005-\u3007\u3031-\u3035\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
FOUR = "\u0e00-\u0eff\u1000-\u1049\u104c-\u109f\u1780-\u17d3\u17d6-\u17ff"
_TOKEN = re.compile(rf"[^\s{MARKS}{TWO}{FOUR}]+[{MARKS}]*\s*|[{TWO}{FOUR}][{MARKS}]*\s*|[{MARKS}]+\s*|\s+")
_MARKS, _TWO, _FOUR = frozenset(MARKS), re.compile(f"[{TWO}]"), re.compile(f"[{FOUR}]")
LAST_ID = 2**63 - 1


def sentences(text: str) -> list[tuple[int, list[str]]]:
    """End and words of each part; the ends cover the whole text."""
    pieces = _TOKEN.findall(text)
    if pieces and pieces[0].isspace():
        pieces[:2] = ["".join(pieces[:2])]
    ends = list(accumulate(map(len, pieces)))
    words = [p.strip() for p in pieces]
    if not words or not words[0]:
        return []
    out: list[tuple[int, list[str]]] = []
    start = 0
    for i in [*(i for i, w in enumerate(words) if w[-1] in _MARKS or "\n" in pieces[i]), len(words) - 1]:
        if i < start:
            break
        for k in _cuts(words, start, i) if i - start >= WINDOW else ():
            out.append((ends[k], words[start:k + 1]))
            start = k + 1
        if start <= i:
            out.append((ends[i], words[start:i + 1]))
            start = i + 1
    return out


def _cuts(words: list[str], start: int, stop: int) -> list[int]:
    """Words after which a part ends, of those from ``start`` to ``stop``, which
    have no mark."""
    sums = [zlib.crc32(w.encode()) for w in words[start:stop]]
    out: list[int] = []
    least = -WINDOW
    for k, x in enumerate(sums):
        if least <= k - WINDOW:
            least = min(range(max(0, k - WINDOW + 1), k + 1), key=lambda j: (sums[j], -j))
        elif x <= sums[least]:
            least = k
        if k >= WINDOW - 1 and (not out or out[-1] != start + least):
            out.append(start + least)
    return out


def _quarters(words: list[str]) -> int:
    """What the words count for, in quarters of a word."""
    text = "".join(words)
    return 4 * len(words) - (0 if text.isascii() else 2 * len(_TWO.findall(text)) + 3 * len(_FOUR.findall(text)))


def _runs(parts: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int]]:
    """First part and end of the span from each part on."""
    before = [0, *accumulate(_quarters(words) for _, words in parts)]
    j = 0
    for i in range(len(parts)):
        while j <= len(parts) and before[j] - before[i] < 4 * WORDS:
            j += 1
        if j > len(parts):
            return
        yield i, j


def text_spans(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and digest of the span from each part on."""
    parts = sentences(text)
    coded = [" ".join(words).encode() for _, words in parts]
    joined = b" ".join(coded)
    at = [0, *accumulate(len(c) + 1 for c in coded)]
    for i, j in _runs(parts):
        yield parts[i - 1][0] if i else 0, parts[j - 1][0], xxhash.xxh3_128_digest(joined[at[i]:at[j] - 1])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column("text")]
        found = [np.frombuffer(b"".join(d for _, _, d in text_spans(t)), "<i8") for t in texts]
        offsets = pa.array(np.cumsum([0, *(len(x) // 2 for x in found)]), pa.int32())
        hashes = np.concatenate(found) if found else np.empty(0, "<i8")
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), pa.array([xxhash.xxh64_intdigest(t) - 2**63 for t in texts], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(hashes[::2])),
            pa.ListArray.from_arrays(offsets, pa.array((hashes[1::2] >> 32).astype("<i4")))],
            names=["doc", "version", "h1", "h2"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, chars = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("gone")):
            text, gone = text.as_py(), gone.as_py()
            merged: list[list[int]] = []
            parts = sentences(text) if gone else []
            runs = list(_runs(parts))
            for i, j in (runs[k] for k in sorted(gone or ())):
                start, end = parts[i - 1][0] if i else 0, parts[j - 1][0]
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            kept, at = [], 0
            for start, end in merged:
                kept.append(text[at:start])
                at = end
            texts.append("".join(kept) + text[at:] if merged else text)
            counts.append(len(merged))
            chars.append(sum(end - start for start, end in merged))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(chars, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_removed", "removed_chars", "text"])


def _version(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        version = [xxhash.xxh64_intdigest(t.as_py() or "") - 2**63 for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(version, pa.int64())], names=[*batch.schema.names, "version"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_removed (stretches), removed_chars and the text that is left,
    for every row of ``docs`` (doc_id, text).

    Null texts stay null; texts with fewer than WORDS words have no spans and
    stay whole.  Rows without doc_id come after all others in the order.  Rows
    that repeat a doc_id are told apart by their text; rows equal in both are
    one document and get the same result.  An empty table gives an empty
    result; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("doc", F.coalesce("doc_id", F.lit(LAST_ID)))
    hashed = stored(rows.select("doc", "text").mapInArrow(
        _spans, "doc bigint, version bigint, h1 array<bigint>, h2 array<int>"), "span-hashes")
    # written, so that the join has its own shuffle, where a hot span's rows can be split
    repeated = stored(hashed.select(F.explode("h1").alias("h1")).groupBy("h1").agg(F.count(F.lit(1)).alias("n"))
                      .where("n > 1").select("h1"), "span-keys")
    # the second hash and the span's number share one column, for a narrower shuffle
    spans = hashed.select("doc", "version", F.posexplode(F.arrays_zip("h1", "h2")).alias("nth", "s")).select(
        "s.h1", F.shiftleft(F.col("s.h2").cast("bigint"), 31).bitwiseOR(F.col("nth").cast("bigint")).alias("x"), "doc", "version")
    again = stored(spans.join(repeated, "h1").select(
        "h1", F.shiftright("x", 31).cast("int").alias("h2"), "doc", "version",
        F.col("x").bitwiseAND(F.lit(2**31 - 1)).cast("int").alias("nth")), "span-repeats")
    place = F.struct("doc", "version", "nth")
    firsts = stored(again.groupBy("h1", "h2").agg(F.min(place).alias("first")), "span-firsts")
    again = again.join(firsts, ["h1", "h2"]).where(place != F.col("first"))
    gone = again.groupBy("doc", "version").agg(F.collect_set("nth").alias("gone"))  # at most a text's own spans
    versioned = rows.mapInArrow(_version, "doc_id bigint, text string, doc bigint, version bigint")
    return versioned.join(gone, ["doc", "version"], "left").select("doc_id", "text", "gone") \
        .mapInArrow(_cut, "doc_id bigint, n_removed bigint, removed_chars bigint, text string")


def op3_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
