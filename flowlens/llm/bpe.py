"""Byte-level BPE: a global shuffle of distinct words, ids joined back by place.

1. Texts are split into pre-tokens.  The texts of a block (a run of rows of one
   input split, BLOCK_CHARS at most but for a single longer text) share a list
   of distinct words; a text becomes its words' numbers in order, which are the
   positions of its pre-tokens.  Blocks are written to a table bucketed by block.
2. The blocks' word lists are exploded and shuffled by word.  Sorted by word, each
   task meets all places of a word together and encodes it once; the ids go back
   to each place (block, number), the places of a block packed together.  A word
   has one row for each block, however often it occurs, so frequent words are no
   hot keys.
3. Each block's ids come together with its texts (bucketed, so the texts don't
   move) and every text's ids are put together by position.

Decoding joins ids with the token-byte table, whose size is the vocabulary's;
it is broadcast and looked up for a whole Arrow batch at a time.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table

BLOCK_CHARS = 48_000_000
# an encoding task gathers this much of its places before it sends them back by block
HELD_BYTES, PLACE_BYTES = 64 << 20, 32
RANKS = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: token bytes and their rank, which is the id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _planes(codes: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, which compresses better."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _codes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


BLOCKS = "block bigint, doc_id bigint, codes binary, words array<string>"


def _splitter(pattern: str, most: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block, words, chars = TaskContext.get().partitionId() << 32, {}, 0
        schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.binary()), ("words", pa.list_(pa.string()))])

        def dictionary() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": block, "words": list(words)}], schema)

        for batch in batches:
            rows: list[dict] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                if chars and chars + len(text) > most:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    yield dictionary()
                    block, words, chars, rows = block + 1, {}, 0, []
                chars += len(text)
                codes = np.array([words.setdefault(w, len(words)) for w in find(text)], np.uint32)
                rows.append({"block": block, "doc_id": doc_id, "codes": _planes(codes)})
            yield pa.RecordBatch.from_pylist(rows, schema)
        if chars:
            yield dictionary()
    return split


def _by_block(held: list[tuple], narrow: str) -> pa.RecordBatch:
    """Encoded places (block, code, number of ids, ids) as one row a block:
    codes in order, as distances, so that they compress."""
    block, code, size = (np.concatenate([h[k] for h in held]) for k in range(3))
    data = np.frombuffer(b"".join(h[3] for h in held), narrow)
    start = np.cumsum(size) - size
    order = np.lexsort((code, block))
    rows = [(int(block[at[0]]), _planes(np.diff(code[at], prepend=0)), _planes(size[at]), _gather(data, start[at], size[at]).tobytes())
            for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))],
                                      names=["block", "codes", "sizes", "ids"])


def _encoder(ranks):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one piece: the words are pre-tokens already
        own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks.value, special_tokens={})
        last, ids, narrow = None, b"", _narrow(ranks.value)
        held, weight = [], 0
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, ids = word, np.array(own.encode_ordinary(word), narrow).tobytes()
                out.append(ids)
            if out:
                size = np.fromiter(map(len, out), np.int64, len(out)) // np.dtype(narrow).itemsize
                held.append((batch.column("block").to_numpy(), batch.column("code").to_numpy().astype(np.int64), size, b"".join(out)))
                weight += PLACE_BYTES * len(out) + len(held[-1][3])
            if weight >= HELD_BYTES:
                yield _by_block(held, narrow)
                held, weight = [], 0
        if held:
            yield _by_block(held, narrow)
    return encode


def _narrow(ranks: dict[bytes, int]) -> str:
    """The type that words' ids travel in."""
    return "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices data[start:start + size], one after the other."""
    total = int(size.sum())
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return data[shift + np.arange(total)]


def _assembler(narrow: str):
    def assembled(texts: pa.Table, ids: pa.Table) -> pa.Table:
        """Ids of a block's texts, put together by position."""
        code = np.concatenate([np.cumsum(_codes(c.as_py()), dtype=np.int64) for c in ids.column("codes")] or [np.zeros(0, np.int64)])
        sizes = np.concatenate([_codes(c.as_py()) for c in ids.column("sizes")] or [np.zeros(0, "<u4")]).astype(np.int64)
        data = np.frombuffer(b"".join(c.as_py() for c in ids.column("ids")), narrow)
        start, size = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        start[code], size[code] = np.cumsum(sizes) - sizes, sizes
        out, counts = [], []
        for planes in texts.column("codes"):
            codes = _codes(planes.as_py())
            got = _gather(data, start[codes], size[codes]) if len(codes) else data[:0]
            out.append(got.astype("<u4").tobytes())
            counts.append(len(got))
        return pa.table({"doc_id": texts.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(out, pa.binary())})
    return assembled


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every row of
    ``docs`` (doc_id, text).

    A null or empty text has no tokens.  Rows that repeat are each encoded.  An
    empty table gives an empty result; other columns are not read.  Words of
    any length are encoded whole.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_splitter(pattern, BLOCK_CHARS), BLOCKS)
    name = f"bpe_blocks_{uuid.uuid4().hex[:12]}"
    split.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").format("parquet") \
        .option("compression", "zstd").option("path", scratch_path(spark, f"llm/{name}")).saveAsTable(name)
    blocks = spark.table(name)
    words = blocks.where("words is not null").select("block", F.posexplode("words").alias("code", "word"))
    ids = words.repartition("word").sortWithinPartitions("word").mapInArrow(_encoder(ranks), "block bigint, codes binary, sizes binary, ids binary")
    texts = blocks.where("words is null").select("block", "doc_id", "codes")
    return texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(
        _assembler(_narrow(ranks.value)), "doc_id bigint, n_tokens bigint, ids binary")


def _decoder(ranks):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted(ranks.value, key=ranks.value.__getitem__)
        at = np.fromiter((ranks.value[t] for t in tokens), np.int64, len(tokens))
        size = np.zeros(int(at.max()) + 1, np.int64)
        size[at] = np.fromiter(map(len, tokens), np.int64, len(tokens))
        start, data = np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                ids = np.frombuffer(ids.as_py() or b"", "<u4")
                # slices keep the places of a very long text's bytes bounded
                out.append(b"".join(_gather(data, start[part], size[part]).tobytes()
                                    for part in (ids[k:k + (1 << 18)] for k in range(0, len(ids), 1 << 18))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])
    return decode


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``decoded``, the texts' bytes.
    Null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(_decoder(ranks), "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


def digests(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    path = ranks_path or public_tokenizers.path(RANKS)
    rows = decode(encode(docs, path, pattern or public_tokenizers.PATTERN), path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
