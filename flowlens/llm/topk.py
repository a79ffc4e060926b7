"""Exact top-k by inner product: an impact-ordered, score-at-a-time search.

A block's index holds the integer components of its vectors in planes of falling
impact: the leading digits of all components first, then the next ones.  Each
plane is a segment of postings (vector, dimension) with one quantised impact.
Segments are added to all scores in that order.  After each, the digits not yet
seen bound every score from both sides; a vector whose upper bound lies below
the k-th best lower bound can't be a member.  The search stops when that proves
all but a few vectors out, or all digits are seen; those left are scored anew
from the whole components.  Ties with the k-th stay in, so the result is exact.

Queries and vectors are dealt into blocks of bounded size and every pair of
blocks is one task's group; a window merges the blocks' best by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

K, SCALE, EVERY = 10, 1024, 100
VECTORS, QUERIES, AT_ONCE = 16384, 1024, 128
LEADING_BITS, PLANE_BITS = 3, 2
FEW = 0.02


def _planes(x: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bits not yet seen, digits) by falling impact; the digits add up to x."""
    high = int(np.abs(x).max(initial=0)).bit_length()
    shifts = list(range(max(high - LEADING_BITS, 0), 0, -PLANE_BITS)) + [0]
    seen, out = np.zeros_like(x), []
    for s in shifts:
        now = (x >> s) << s
        out.append((s, (now - seen).astype(np.float64)))
        seen = now
    return out


def search(queries: np.ndarray, q_rows: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Indexes (query, vector) and scores of each query's k best other rows."""
    planes = _planes(x)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(queries), AT_ONCE):
        q, own = queries[at:at + AT_ONCE], q_rows[at:at + AT_ONCE, None] == rows[None]
        wide = q.astype(np.float64)
        up, down = np.maximum(wide, 0).sum(1, keepdims=True), np.minimum(wide, 0).sum(1, keepdims=True)
        scores = np.zeros((len(q), len(x)))
        for s, digits in planes:
            scores += wide @ digits.T
            rest = 2.0**s - 1
            low = np.where(own, -np.inf, scores + down * rest)
            kth = np.partition(low, len(x) - k, axis=1)[:, len(x) - k, None] if len(x) > k else np.full((len(q), 1), -np.inf)
            possible = (scores + up * rest >= kth) & ~own
            if possible.sum() <= FEW * possible.size:
                break
        a, b = np.nonzero(possible)
        exact = np.concatenate([(q[a[j:j + 65536]] * x[b[j:j + 65536]]).sum(1) for j in range(0, len(a), 65536)] or [np.empty(0, np.int64)])
        order = np.lexsort((ids[b], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        first = np.searchsorted(a, a)
        best = np.arange(len(a)) - first < k
        found.append((a[best] + at, b[best], exact[best]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _ints(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64)


def _searcher(k: int):
    schema = pa.schema([("q_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not len(queries) or not len(vectors):
            return schema.empty_table()
        rows, ids = vectors.column("row").to_numpy(), vectors.column("vec_id").to_numpy()
        q_rows = queries.column("row").to_numpy()
        a, b, score = search(_ints(queries.column("v")), q_rows, _ints(vectors.column("v")), rows, ids, k)
        return pa.table([q_rows[a], queries.column("vec_id").to_numpy()[a], ids[b], rows[b], score], schema=schema)
    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for each query: the rows of ``vectors``
    (vec_id, embedding) whose vec_id is divisible by ``every``.

    Components become floor(1024 * x).  Vectors that are null or hold null or
    non-finite components, and rows without vec_id, take no part; a query is
    held against vectors of its own length only.  Of rows that repeat a vec_id
    each is a row (and a query) of its own, so a query's twin is a candidate;
    equal scores rank by vec_id.  Scores must fit 53 bits.  An empty table
    gives an empty result; other columns are not read.
    """
    wide = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), wide.alias("x")) \
        .where("vec_id is not null and x is not null") \
        .where(~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = stored(rows.select("vec_id", F.transform("x", lambda x: F.floor(x * SCALE)).alias("v"), F.size("x").alias("dims"),
                              F.monotonically_increasing_id().alias("row")), "topk-rows")
    is_query = F.col("vec_id") % every == 0
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    nv, nq = -(-max(sizes["n"], 1) // VECTORS), -(-max(sizes["q"], 1) // QUERIES)
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where(is_query).withColumn("qb", block(nq)).withColumn("vb", every_block(nv))
    blocks = rows.withColumn("vb", block(nv)).withColumn("qb", every_block(nq))
    best = queries.groupBy("dims", "qb", "vb").cogroup(blocks.groupBy("dims", "qb", "vb")).applyInArrow(
        _searcher(k), "q_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.col("score").desc(), "vec_id", "row"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
