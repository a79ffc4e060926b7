"""Lloyd's rounds with heap-ordered bounds, over integer vectors.

For a vector of cluster j, the gap between its distances to the second nearest
and to its own centroid shrinks in a round by no more than the drift of centroid
j plus the largest drift of another one.  The accumulated sum of these is the
cluster's offset; a vector enters its cluster's heap with the key
``gap + offset`` and cannot change its cluster until the offset reaches the key.

A heap here is a set of written runs, each sorted by (cluster, key): round 0
writes all vectors as the first run, every later round reads only the rows whose
key its offset has reached (a range at the front of each cluster's part, pushed
down to the Parquet row groups), rescans those exactly against all centroids and
writes them as its own run.  Offsets never fall, so a row of a run is still in
its heap exactly if its key is above the present offset; nothing has to be
deleted, and a lost task is run again on the same files.

Distances are exact integers; gaps are rounded down and drifts up by far more
than their rounding errors.  What reaches the driver is bounded by the number of
centroids: their vectors, and the changes of their sums and counts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Components of larger size would let distances pass 2^63; they are refused.
LARGEST = 1 << 27
SLACK = 1e-9

HEAP = "vec_id bigint, v array<int>, was int, cluster int, key double"


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and v (floor of ``scale`` times each component) of the vectors
    with ``dimensions`` components, none of them null or not finite."""
    x = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    x = x.where(F.expr(f"size(x) = {dimensions} AND forall(x, c -> c IS NOT NULL AND abs(c) < double('Infinity'))"))
    most = LARGEST / scale
    fits = F.expr(f"forall(x, c -> c >= {-most!r}D AND c < {most!r}D)")
    v = F.expr(f"transform(x, c -> CAST(floor({scale} * c) AS INT))")
    return x.select("vec_id", F.when(fits, v).otherwise(F.raise_error(F.lit(f"component beyond {most}: distances would not fit"))).alias("v"))


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors of the smallest hashes; rows of one vec_id by their vectors."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    least = rows.select(h.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in least], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact; by floating point only where every sum stays below 2^53."""
    x, c = x.astype(np.int64), centroids
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * largest**2 < 1 << 52:
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - one) ** 2).sum(1) for one in c], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _rescan(centroids: np.ndarray, offset: np.ndarray):
    """Nearest centroid (of equal ones the smaller number) and the heap's key."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            d = squared_distances(_matrix(batch.column("v")), centroids)
            cluster = d.argmin(1)
            rows = np.arange(len(d))
            own = np.sqrt(d[rows, cluster].astype(np.float64))
            second = np.full(len(d), np.inf)
            if d.shape[1] > 1:
                d[rows, cluster] = np.iinfo(np.int64).max
                second = np.sqrt(d.min(1).astype(np.float64))
            key = second - own - SLACK * (own + np.where(np.isinf(second), 0, second) + offset[cluster]) + offset[cluster]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("cluster"), pa.array(cluster, pa.int32()), pa.array(key, pa.float64())],
                names=["vec_id", "v", "was", "cluster", "key"])
    return scan


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a batch adds to each cluster's sums (by place; place -1 has the
    counts), less what it takes from the clusters its vectors have left."""
    for batch in batches:
        if not len(batch):
            continue
        v = _matrix(batch.column("v")).astype(np.int64)
        v = np.hstack([v, np.ones((len(v), 1), np.int64)])
        now, was = batch.column("cluster").to_numpy(), batch.column("was").fill_null(-1).to_numpy()
        moved = now != was
        for side, sign in ((now, 1), (was, -1)):
            for k in np.unique(side[moved & (side >= 0)]).tolist():
                s = sign * v[moved & (side == k)].sum(0)
                at = np.append(np.arange(v.shape[1] - 1), -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k), pa.int32()), pa.array(at, pa.int32()), pa.array(s, pa.int64())],
                                                 names=["cluster", "at", "s"])


def _distance(centroids: np.ndarray):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            apart = _matrix(batch.column("v")).astype(np.int64) - centroids[cluster] if len(batch) else np.zeros((0, 1), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array((apart**2).sum(1), pa.int64())],
                                             names=["vec_id", "cluster", "distance"])
    return measure


def _beyond(offset: np.ndarray, reached: bool) -> Column:
    """Rows whose key the offset of their cluster has (not) reached, as plain
    comparisons, which Parquet row groups are skipped by."""
    out = F.lit(False)
    for k, d in enumerate(offset.tolist()):
        out = out | ((F.col("cluster") == k) & ((F.col("key") <= d) if reached else (F.col("key") > d)))
    return out


def _run(rows: DataFrame, centroids: np.ndarray, offset: np.ndarray, name: str) -> DataFrame:
    scanned = rows.mapInArrow(_rescan(centroids, offset), HEAP)
    return stored(scanned.repartitionByRange("cluster", "key").sortWithinPartitions("cluster", "key"), name)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """One row per usable vector of ``vectors`` (vec_id, embedding): vec_id,
    cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of other length, or hold null or non-finite
    components have no row; a component of 2^21 or more fails the job (its
    distances would not fit a long).  Rows that repeat count and are returned
    again; a null vec_id is hashed as empty text.  With fewer vectors than
    ``clusters`` every vector is a centroid.  Of centroids equally near the
    smaller number is taken.  An empty table gives an empty result; other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, dimensions, scale), "cluster-vectors")
    centroids = first_centroids(rows, clusters)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    size = centroids.shape
    offset, sums, counts = np.zeros(size[0]), np.zeros(size, object), np.zeros(size[0], object)
    runs = [(_run(rows.withColumn("cluster", F.lit(None).cast("int")), centroids, offset, "cluster-run0"), offset)]
    for k in range(1, rounds + 1):
        for r in runs[-1][0].mapInArrow(_changes, "cluster int, at int, s bigint").groupBy("cluster", "at").agg(F.sum("s").alias("s")).collect():
            if r["at"] < 0:
                counts[r["cluster"]] += r["s"]
            else:
                sums[r["cluster"], r["at"]] += r["s"]
        moved = np.array([[s // n for s in row] if n else old.tolist() for row, n, old in zip(sums, counts, centroids)], np.int64)
        drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        most = np.array([np.delete(drift, j).max(initial=0) for j in range(len(drift))])
        before, offset, centroids = offset, offset + drift + most, moved
        expired = [run.where(_beyond(offset, True)) if at is before else run.where(_beyond(offset, True) & _beyond(before, False)) for run, at in runs]
        popped = expired[0]
        for more in expired[1:]:
            popped = popped.unionByName(more)
        runs.append((_run(popped.select("vec_id", "v", "cluster"), centroids, offset, f"cluster-run{k}"), offset))
    held = [run if at is offset else run.where(_beyond(offset, False)) for run, at in runs]
    last = held[0]
    for more in held[1:]:
        last = last.unionByName(more)
    last = stored(last.select("vec_id", "v", "cluster").mapInArrow(_distance(centroids), "vec_id bigint, cluster int, distance bigint"), "cluster-distances")
    inertia = {r["cluster"]: r["s"] for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = spark.createDataFrame([(k, s, sum(inertia.values()), digest[k]) for k, s in inertia.items()],
                                 "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row a centroid
    return last.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same rounds, one after the other."""
    out = [f"""WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      parts AS MATERIALIZED (SELECT i, unnest(v) AS x, unnest(range({DIMENSIONS})) AS pos FROM kept),
      starts AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster, v FROM kept),
      c0 AS MATERIALIZED (SELECT cluster, unnest(v) AS x, unnest(range({DIMENSIONS})) AS pos FROM starts WHERE cluster < {CLUSTERS})"""]
    for k in range(ROUNDS + 1):
        out.append(f"""d{k} AS (SELECT i, cluster, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{k} c USING (pos) GROUP BY i, cluster),
      a{k} AS MATERIALIZED (SELECT i, min(struct_pack(d := d, c := cluster)) AS b FROM d{k} GROUP BY i)""")
        if k < ROUNDS:
            out.append(f"""s{k} AS (SELECT a.b.c AS cluster, pos, sum(x) AS s, count(*) AS n FROM parts JOIN a{k} a USING (i) GROUP BY 1, 2),
      c{k + 1} AS MATERIALIZED (SELECT cluster, pos, CAST(CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
        FROM c{k} LEFT JOIN s{k} USING (cluster, pos))""")
    out.append(f"""digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
      SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance, CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(b.d) OVER () AS BIGINT) AS inertia, centroid_sha256
      FROM a{ROUNDS} JOIN kept USING (i) JOIN digests ON digests.cluster = b.c""")
    return ",\n      ".join(out[:-1]) + ",\n      " + out[-1]


ORACLE = _oracle()
