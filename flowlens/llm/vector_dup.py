"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines.

Normalised vectors of one label are projected on Gaussian directions, shifted
and cut into cells of WIDTH; DEPTH cells together are a bucket, in TABLES
independent tables.  At cosine 0.93 (distance 0.374) one cell agrees with
probability 0.85, so a pair just at the threshold is missed by every table with
probability 0.002, one at 0.96 with 1e-5; unrelated vectors share a bucket with
probability 1e-5 a table.

Rows with the same label and vector are one class first.  A bucket's classes
are compared in blocks of BLOCK: large buckets are dealt out as pairs of
blocks over many tasks, and each task multiplies two blocks at a time, so
memory is bounded and no pair is skipped.  A pair that meets in several tables
counts in the first of them only.  Blocks report the number of links of each
class and a spanning set of edges, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stored, table

COSINE = 0.93
WIDTH, DEPTH, TABLES = 2.0, 16, 80
BLOCK = 1024


def _directions(dims: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((7, dims))
    return rng.standard_normal((dims, TABLES * DEPTH)), rng.uniform(0, WIDTH, TABLES * DEPTH)


def _mixed(cells: np.ndarray) -> np.ndarray:
    """(n, TABLES, DEPTH) cells to (n, TABLES) 64-bit keys."""
    key = np.broadcast_to(np.arange(TABLES, dtype=np.uint64), cells.shape[:2]).copy()
    for k in range(DEPTH):
        key = (key ^ cells[:, :, k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def bucket_keys(unit: np.ndarray) -> np.ndarray:
    directions, shift = _directions(unit.shape[1])
    cells = np.floor((unit @ directions + shift) / WIDTH)
    return _mixed(cells.reshape(len(unit), TABLES, DEPTH))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("v").to_pylist()
        by_dims: dict[int, list[int]] = {}
        for k, row in enumerate(rows):
            by_dims.setdefault(len(row), []).append(k)
        out: list = [None] * len(rows)
        for where in by_dims.values():
            v = np.array([rows[k] for k in where], np.float64)
            for k, keys in zip(where, bucket_keys(v / np.linalg.norm(v, axis=1, keepdims=True))):
                out[k] = keys
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))],
                                         names=[*batch.schema.names, "keys"])


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.array(column.to_pylist(), kind)


def _cell_links(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each class that this cell is the first to see, and a forest of
    edges with the components of these links."""
    ids, blk, t, mult = (cell.column(c).to_numpy() for c in ("class_id", "blk", "t", "mult"))
    links, none = np.zeros(len(ids), np.int64), np.empty(0, np.int64)
    if len(ids) < 2:
        return links, none, none
    v, keys, label = _matrix(cell.column("v"), np.float64), _matrix(cell.column("keys"), np.int64), np.array(cell.column("label").to_pylist())
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    first, two = int(t[0]), cell.column("lo")[0].as_py() != cell.column("hi")[0].as_py()
    left, right = [], []
    for at in range(0, len(ids), 256):
        a, b = np.nonzero(v[at:at + 256] @ v.T >= COSINE)
        a += at
        fit = (label[a] == label[b]) & (t[a] == t[b]) & ((blk[a] != blk[b]) if two else (a != b))
        a, b = a[fit], b[fit]
        new = keys[a, first] == keys[b, first]
        for j in range(first):
            new &= keys[a, j] != keys[b, j]
        left.append(a[new])
        right.append(b[new])
    a, b = np.concatenate(left), np.concatenate(right)
    np.add.at(links, a, mult[b])
    return links, *_forest(a, b, len(ids))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells come sorted; each is compared when it is whole.  One holds 2 * BLOCK
    classes on average at most."""
    def told(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        by_dims: dict[int, list[int]] = {}
        for k, n in enumerate(cell.column("dims").to_pylist()):
            by_dims.setdefault(n, []).append(k)
        for where in by_dims.values():
            part = cell.take(where) if len(by_dims) > 1 else cell
            ids = part.column("class_id").to_numpy()
            links, a, b = _cell_links(part)
            if links.any():
                counted = np.nonzero(links)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[counted], ids[a]])), pa.array([None] * len(counted) + ids[b].tolist(), pa.int64()),
                     pa.array(np.concatenate([links[counted], np.zeros(len(a), np.int64)]))], names=["a", "b", "n"])

    open_cell: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if open_cell is not None:
            rows = pa.concat_tables([open_cell, rows])
        at = rows.column("cell").to_numpy()
        cuts = [0, *(np.nonzero(at[1:] != at[:-1])[0] + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo > 1:
                yield from told(rows.slice(lo, hi - lo))
        open_cell = rows.slice(cuts[-1]) if len(rows) else None
    if open_cell is not None:
        yield from told(open_cell)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges with the same components as the links (a, b) of n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    far = np.nonzero(label != np.arange(n))[0]
    return far, label[far]


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links, component_id, kept.

    A vector that is null, empty, zero or holds null or non-finite components,
    a null label or a null vec_id is linked with nothing.  Vectors of different
    lengths are never linked.  Equal vectors of one label are linked with each
    other; rows that repeat a vec_id count as rows of their own.  An empty
    table gives an empty result; other columns are not read.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad
           & F.exists("v", lambda x: x != 0.0))
    # -0.0 becomes 0.0, so that equal vectors have equal text and digest
    plain = F.transform("v", lambda x: F.when(x == 0.0, F.lit(0.0)).otherwise(x))
    digest = F.md5(F.concat_ws("|", F.lit("v"), "label", F.transform("v", lambda x: x.cast("string"))))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("v", F.when(F.col("fit"), plain)) \
        .withColumn("digest", F.when(F.col("fit"), digest))
    rows = stored(rows, "vec-rows")
    classes = stored(rows.where("fit").groupBy("digest").agg(
        F.min(F.struct("vec_id", "label", "v")).alias("s"), F.count(F.lit(1)).alias("mult"))
        .select("digest", F.col("s.vec_id").alias("class_id"), F.col("s.label").alias("label"), F.col("s.v").alias("v"), "mult")
        # a vec_id may repeat with another vector, so classes are numbered
        .withColumn("class_id", F.monotonically_increasing_id()), "vec-classes")

    keyed = stored(classes.select("class_id", "label", "v", "mult").mapInArrow(
        _keyed, "class_id bigint, label string, v array<double>, mult bigint, keys array<bigint>"), "vec-keys")
    hashed = keyed.select("class_id", "label", F.posexplode("keys").alias("t", "key"))
    crowded = hashed.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1") \
        .select("label", "t", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb"))
    met = hashed.join(crowded, ["label", "t", "key"])
    met = met.withColumn("blk", F.pmod(F.xxhash64("class_id"), F.col("nb")).cast("int"))
    met = met.withColumn("pair", F.explode(F.expr(
        "transform(sequence(0, nb - 1), j -> struct(least(j, blk) as lo, greatest(j, blk) as hi))"))) \
        .select("class_id", "t", "blk", "pair.*", F.xxhash64("label", "t", "key", "pair").alias("cell"))
    met = met.join(keyed, "class_id").withColumn("dims", F.size("v"))
    found = stored(met.repartition("cell").sortWithinPartitions("cell", "blk", "class_id")
                   .mapInArrow(_compared, "a bigint, b bigint, n bigint"), "vec-found")

    counts = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("others"))
    labels = components(found.where("b is not null").select("a", "b"), "vec").withColumnRenamed("node", "class_id") \
        .withColumnRenamed("label", "root")
    least = rows.where("fit").groupBy("digest").agg(F.min("vec_id").alias("first_id"))
    of_class = classes.select("digest", "class_id", "mult").join(least, "digest").join(counts, "class_id", "left") \
        .join(labels, "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    roots = of_class.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = of_class.join(roots, "root").select(
        "digest", "component_id", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    return (rows.select("vec_id", "digest").join(of_class, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op10_vector_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
