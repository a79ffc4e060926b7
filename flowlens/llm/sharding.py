"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2^16 cells; each shard owns the cells that end at its virtual
nodes.  A row's key hash names its cell, the next virtual node clockwise its
home shard.  Shards have a bounded capacity; rows that find their home full
continue clockwise to the next shard with room.

Rows of a cell are interchangeable for this walk but for their order by hash,
so the walk is planned on the cell counts alone: one distributed count gives at
most 2^16 numbers, whatever the number of rows, and the plan says which ranks
of each cell go to which shard, from which slot on.  Ranks come from a window
within each cell; the plan (bounded by the ring, not by the data) is broadcast.
No step uses Python on the executors.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc32_of, leading_bits, spread, stored, table

CELL_BITS, VIRTUAL = 16, 64
CELLS = 1 << CELL_BITS


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(last cell, shard) of every virtual node, clockwise.  A node's place
    depends on its shard's number only, so further shards move no node."""
    return sorted((int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[: CELL_BITS // 4], 16), s)
                  for s in range(shards) for v in range(virtual))


def walk(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (cell, first rank, last rank + 1, shard, first slot).

    First every cell clockwise fills its home shard; then what is left
    continues clockwise, cell by cell, to the next shard with room.
    """
    places, room, used, out, left = [p for p, _ in nodes], list(room), [0] * len(room), [], []

    def put(cell: int, lo: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            out.append((cell, lo, lo + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    for cell in sorted(counts):
        node = bisect_left(places, cell) % len(nodes)
        n = put(cell, 0, counts[cell], nodes[node][1])
        if n < counts[cell]:
            left.append((cell, node, n))
    ahead = list(range(len(nodes)))  # the next node that may have room

    def open_node(k: int) -> int:
        path = []
        while room[nodes[k][1]] == 0:
            path.append(k)
            k = ahead[k] if ahead[k] != k else (k + 1) % len(nodes)
        for p in path:
            ahead[p] = k
        return k

    for cell, node, lo in left:
        while lo < counts[cell]:
            node = open_node(node)
            lo += put(cell, lo, counts[cell] - lo, nodes[node][1])
    return out


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Without slack the capacities add up to ``rows`` exactly and differ by
    one at most, so all shards end full; with slack a shard may hold that share
    more than the mean, and fewer rows leave home."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard(docs: DataFrame, shards: int, slack: float = 0.0) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard: doc_id, size (UTF-8
    bytes of the text, 0 for null, plus 16), text_crc32, home_shard, shard,
    slot (0, 1, ... within the shard).

    The ring key is doc_id with the text's checksum and size; rows that agree
    in all of them are interchangeable and spread over the ring, so no key is
    hot.  A null doc_id is a key like any other.  An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
                       crc32_of(F.col("text")).alias("text_crc32"))
    rows = spread(stored(rows, "shard-rows"), "doc_id", "size", "text_crc32") \
        .withColumn("cell", leading_bits("h", CELL_BITS).cast("int"))
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # at most CELLS rows
    nodes = ring(shards)
    plan = walk(counts, nodes, capacities(sum(counts.values()), shards, slack))
    places = [p for p, _ in nodes]
    homes = [(*s, nodes[bisect_left(places, s[0]) % len(nodes)][1]) for s in plan]
    segments = spark.createDataFrame(
        homes, "cell int, lo bigint, hi bigint, shard int, first_slot bigint, home_shard int")
    ranked = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("cell").orderBy("h", "doc_id", "size", "text_crc32", "at")) - 1)
    return (ranked.join(F.broadcast(segments), "cell").where("rank >= lo and rank < hi")
            .select("doc_id", "size", "text_crc32", "home_shard", "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("lo")).alias("slot")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards, law ``rows``: counts at most one apart."""
    return shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")
