"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact check.

A document's set holds its distinct five-word shingles (words are runs of
anything but ASCII white space, A-Z lowered; a shorter text is one shingle).
Documents whose sets have a Jaccard similarity of 0.75 or more are linked.

1. One pass over the texts gives each document the size and a 128-bit digest of
   its set, 32 band keys of 4 MinHash values each (a pair at 0.75 shares none
   with probability 5e-6), and an odd sketch: the 128 samples folded into a
   512-bit parity bitmap.
2. Documents with the same digest are one class, numbered when it is written;
   from here on only classes count, so thousands of copies cost one row.  Band
   keys that two or more classes share are written once, as (key, band, number);
   all later steps read those rows.
3. In every band's bucket the member with the most neighbours over all bands is
   paired with the others (a star, linear in the bucket); a text that many
   copies were made from is such a member.  Pairs whose sketches differ in too
   many bits are dropped (the bound lies 6.5 standard deviations from 0.75),
   the rest are confirmed on the full sets, and components are formed.
4. Only pairs that cross components remain to be tested: buckets inside one
   component vanish, the others are compared whole, in blocks of BLOCK classes
   dealt over many tasks.  Sketches tell which members have a possible partner
   at all; for those the full sets are brought along, and each pair is
   confirmed in the task, closest sketches first, unless the two have met in
   one component by then.  A pair in several buckets is tested in the first.
   What leaves the task are the edges of a forest, not pairs.  No pair is
   skipped: two members of a bucket that end in different components have been
   compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stored, table, unused

WORDS = 5
SAMPLES, ROWS = 128, 4
BANDS = SAMPLES // ROWS
SKETCH_BITS = 512
BLOCK = 256
PERCENT = 75
#: Pairs whose sketches estimate less than this are not confirmed.
LEAST_ESTIMATE = 0.5

_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_STEP = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURE = "doc_id bigint, version bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>"


def most_differing_bits(estimate: float = LEAST_ESTIMATE) -> int:
    """Differing bits that two odd sketches show on average at a similarity."""
    return int(np.ceil(SKETCH_BITS * (1 - np.exp(-4 * SAMPLES * (1 - estimate) / SKETCH_BITS)) / 2))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a UTF-8 text's shingles.  bytes.lower
    and bytes.split touch ASCII only, which is the definition of a word here."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for k in range(WORDS):
        total += _mix(h[k:k + n] + _STEP[k]) * _STEP[k]
    return np.unique(_mix(total))


def _signature(x: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 4096):  # a very long text costs 4 MB, not its length times 128
        low = np.minimum(low, (x[at:at + 4096, None] * _MUL + _ADD).min(axis=0))
    which = np.arange(SAMPLES, dtype=np.uint64)
    mixed = _mix(low + which * np.uint64(0x9E3779B97F4A7C15))
    bands = np.zeros(BANDS, np.uint64)
    for row in mixed.reshape(BANDS, ROWS).T:
        bands = _mix(bands * np.uint64(0x9E3779B97F4A7C15) + row)
    parity = np.bincount((mixed % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    sketch = np.packbits(parity.astype(np.uint8)).view(np.int64)
    key = xxhash.xxh3_128_digest(x.tobytes())
    return key, bands.view(np.int64), sketch


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, keys, bands, sketches = [], [], [], []
        for text in batch.column("text"):
            x = shingles(text.as_py())
            n.append(len(x))
            key, band, sketch = _signature(x) if len(x) else (None, None, None)
            keys.append(key)
            bands.append(band)
            sketches.append(sketch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "version", "n_shingles", "set_key", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
             pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["set_key", "shingles"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _close_sketches(a: str, b: str):
    differing = sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    return differing <= most_differing_bits()


def _size_allows(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _full_sets(needed: DataFrame, classes: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """num and shingles of the ``needed`` classes; only their texts are
    shingled again."""
    wanted = stored(classes.join(needed, "num", "left_semi").select("num", "set_key", "rep"), f"{name}-wanted")
    texts = _texts(docs).join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(_sets, "set_key binary, shingles array<bigint>")
    return stored(sets.join(wanted.select("num", "set_key"), "set_key").select("num", "shingles").dropDuplicates(["num"]), f"{name}-sets")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets reach the similarity."""
    pairs = stored(pairs, f"{name}-pairs")
    needed = pairs.select(F.col("a").alias("num")).unionByName(pairs.select(F.col("b").alias("num"))).distinct()
    sets = _full_sets(needed, classes, docs, name)
    one = sets.select(F.col("num").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("num").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two, "b")
            .where(shared * 100 >= (F.size("sa") + F.size("sb") - shared) * PERCENT).select("a", "b"))


def _buckets(classes: DataFrame) -> DataFrame:
    """key, band, num, m: the classes in each band's buckets of two or more.
    All that follows works on these rows; most classes are in none."""
    rows = classes.select("num", F.posexplode("bands").alias("band", "key"))
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("m")).where("m > 1")
    return stored(rows.select("key", F.col("band").cast("tinyint").alias("band"), "num").join(crowded, "key"), "near-buckets")


def _star_pairs(classes: DataFrame, buckets: DataFrame) -> DataFrame:
    degree = buckets.groupBy("num").agg(F.sum(F.col("m") - 1).alias("degree"))
    rows = buckets.select("key", "num").join(degree, "num")
    pivots = rows.groupBy("key").agg(F.max(F.struct("degree", "num"))["num"].alias("pivot"))
    pairs = (buckets.select("key", "num").join(pivots, "key").where("num <> pivot")
             .select(F.least("num", "pivot").alias("a"), F.greatest("num", "pivot").alias("b")).distinct())
    side = classes.select("num", "n_shingles", "sketch")
    return (pairs.join(side.toDF("a", "na", "ka"), "a").join(side.toDF("b", "nb", "kb"), "b")
            .where(_size_allows("na", "nb") & _close_sketches("ka", "kb")).select("a", "b"))


CELL = "cell bigint, band tinyint, two boolean, blk int, num bigint, label bigint, n_shingles bigint, sketch array<bigint>, bands array<bigint>"


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell; cells come sorted."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        at = rows.column("cell").to_numpy()
        cuts = [0, *(np.nonzero(at[1:] != at[:-1])[0] + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:]):
            yield rows.slice(lo, hi - lo)
        held = rows.slice(cuts[-1]) if len(rows) else None
    if held is not None:
        yield held


def _possible(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, differing bits) of a cell's pairs that may be links and that no
    earlier band sees, a < b."""
    n, blk, band = (cell.column(c).to_numpy() for c in ("n_shingles", "blk", "band"))
    label = cell.column("label").to_numpy()
    sketch = np.array(cell.column("sketch").to_pylist(), np.int64).view(np.uint64)
    bands = np.array(cell.column("bands").to_pylist(), np.int64)
    t, two, found = int(band[0]), cell.column("two")[0].as_py(), []
    for at in range(0, len(n), 128):
        some = slice(at, min(at + 128, len(n)))
        fit = (label[some, None] != label) & (np.minimum(n[some, None], n) * 100 >= np.maximum(n[some, None], n) * PERCENT)
        fit &= np.arange(len(n))[some, None] < np.arange(len(n))
        fit &= (blk[some, None] != blk) if two else True
        fit &= (band[some, None] == band) & (bands[some, t, None] == bands[:, t])
        a, b = np.nonzero(fit)
        a += at
        bits = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1)
        new = bits <= most_differing_bits()
        a, b, bits = a[new], b[new], bits[new]
        first = (bands[a, :t] != bands[b, :t]).all(1)
        found.append((a[first], b[first], bits[first]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in _whole_cells(batches):
        if len(cell) > 1:
            a, b, _ = _possible(cell)
            if len(a):
                yield from cell.take(np.unique(np.concatenate([a, b]))).to_batches()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in _whole_cells(batches):
        if len(cell) < 2:
            continue
        a, b, bits = _possible(cell)
        nums, sets = cell.column("num").to_pylist(), [x.values.to_numpy() for x in cell.column("shingles")]
        label = cell.column("label").to_numpy().copy()
        edges = []
        for k in bits.argsort(kind="stable").tolist():
            i, j = a[k], b[k]
            if label[i] == label[j]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared * 100 >= (len(sets[i]) + len(sets[j]) - shared) * PERCENT:
                edges.append((nums[i], nums[j]))
                label[label == label[j]] = label[i]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges], pa.int64()), pa.array([y for _, y in edges], pa.int64())],
                                         names=["a", "b"])


def _crossing_links(classes: DataFrame, buckets: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links between classes of different components, as a forest in
    each cell."""
    rows = buckets.select("key", "band", "num").join(labels.withColumnRenamed("node", "num"), "num", "left") \
        .withColumn("label", F.coalesce("label", "num"))
    mixed = (rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb")))
    rows = rows.join(mixed, "key").withColumn("blk", F.pmod(F.xxhash64("num"), F.col("nb")).cast("int"))
    rows = rows.withColumn("pair", F.explode(F.expr(
        "transform(sequence(0, nb - 1), j -> struct(least(j, blk) as lo, greatest(j, blk) as hi))")))
    rows = rows.select(F.xxhash64("key", "pair").alias("cell"), "band", (F.col("pair.lo") != F.col("pair.hi")).alias("two"),
                       "blk", "num", "label").join(classes.select("num", "n_shingles", "sketch", "bands"), "num")
    rows = rows.select("cell", "band", "two", "blk", "num", "label", "n_shingles", "sketch", "bands")
    order = ("cell", "blk", "num")
    partners = stored(rows.repartition("cell").sortWithinPartitions(*order).mapInArrow(_with_partners, CELL), "near-partners")
    needed = partners.select("num").distinct()
    whole = partners.join(_full_sets(needed, classes, docs, "near-cross"), "num")
    return whole.repartition("cell").sortWithinPartitions(*order).mapInArrow(_linked, "a bigint, b bigint")


def _version(text):
    """Tells texts of one doc_id apart."""
    return F.xxhash64(text.cast("binary"))


def _judged(docs: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` with the text's version and the label of
    its component (null without shingles or doc_id)."""
    signed = stored(_texts(docs).withColumn("version", _version(F.col("text"))).mapInArrow(_signatures, SIGNATURE), "near-signatures")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stored(linked.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("s"))
        .select(F.monotonically_increasing_id().alias("num"), "set_key", F.col("s.doc_id").alias("rep"), "s.n_shingles", "s.bands", "s.sketch"), "near-classes")
    buckets = _buckets(classes)

    edges = stored(_confirmed(_star_pairs(classes, buckets), classes, docs, "near-star"), "near-star-edges")
    labels = components(edges, "near-star")
    crossing = _crossing_links(classes, buckets, labels, docs)
    merged = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
                        .unionByName(crossing.select("a", "b")), "near")

    of_class = classes.select("num", "set_key", "rep").join(merged.withColumnRenamed("node", "num"), "num", "left") \
        .withColumn("label", F.coalesce("label", "num"))
    least = of_class.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(least, "label").select("set_key", "label", "component_id")
    named = F.col("doc_id").isNotNull()
    return (signed.select("doc_id", "version", "n_shingles", "set_key").join(of_class, "set_key", "left")
            .select("doc_id", "version", "n_shingles", F.when(named, F.col("label")).alias("label"),
                    F.when(named, F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept.

    Empty and null texts have no shingles and are linked with nothing.  Rows
    that repeat a doc_id with another text are judged by their own text.  A row
    without doc_id is in no component (component_id null) and is kept.  An
    empty table gives an empty result; other columns of ``docs`` are not read.
    """
    return _judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group left, the one with the smallest
    doc_id (of its rows in the group, if they repeat, the one with the least
    hash of the text, once).  Rows that share a doc_id but are in different
    groups are told apart by their text, and each group keeps its own; of the
    rows of a doc_id without shingles one stays.  Rows without doc_id stay."""
    kept = _judged(docs).where("kept and doc_id is not null").groupBy("doc_id", "label").agg(F.min("version").alias("version"))
    doc, version = unused(docs, "near_doc"), unused(docs, "near_version")
    own = docs.where("doc_id is not null").withColumn(doc, F.col("doc_id").cast("bigint")).withColumn(version, _version(F.col("text")))
    kept = kept.select(F.col("doc_id").alias(doc), F.col("version").alias(version)).distinct()
    named = own.join(kept, [doc, version], "left_semi").dropDuplicates([doc, version])
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
