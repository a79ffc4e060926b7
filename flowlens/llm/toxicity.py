"""Toxicity by weak supervision.

1. Voters: in a bounded sample of labelled rows, every word, and every word start
   of 4 to 7 letters that begins 1, 2 or 3 words of a text, is counted by label (a
   distributed aggregate).  Those that go with label 1 by a G-test and whose
   precision, shrunk towards the share of label 1, reaches PRECISION become
   voters, VOTERS at most: words are the lexicon, repeated word starts the
   patterns.  Voters that fire in the same rows of the sample count once.  A
   further voter says clean when none fires.
2. Label model: on the sample's votes, expectation maximisation estimates how
   often each voter fires for either hidden label, starting from the voters'
   precisions, with the labels' shares held at the sample's.  Only votes that
   were cast are evidence: a lexicon's silence says nothing in a text of another
   language.  Voters that repeat each other (a word and its own start) are
   correlated given the label; these correlations are estimated too, and a
   voter's evidence is divided by how many voters it agrees with.
3. A linear classifier is trained on the label model's posterior labels and
   scores every whole text.  Its features are the votes and, so that texts which
   no voter knows are told apart too, hashed counts of all words and word starts.

The votes and hashed counts of the sample (SAMPLE rows in expectation, VOTERS and
BUCKETS wide) are all that reaches the driver.  Labels of held-out rows, where
crc32 of the doc_id's text is divisible by 5, are never read into the sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SAMPLE, VOTERS, BUCKETS = 8000, 256, 512
LEAST_G, LEAST_TEXTS = 18.0, 3
#: Least precision of a voter, and how many texts of the average share it is shrunk by.
PRECISION, PRIOR = 0.6, 4
STARTS, TIMES = (4, 5, 6, 7), (1, 2, 3)
VOTE_RIDGE, TEXT_RIDGE = 0.1, 1.0
#: Characters of a text whose words are listed at once.
PIECE = 1 << 20

_WORD = re.compile(r"[^\W_]+")
_BETWEEN = re.compile(r"[\W_]")


@dataclass
class Model:
    """Voters ("=word", or "2start" for a start of two words or more), their
    weights, those of the hashed counts and the bias.  Without voters every
    score is ``bias`` alone."""

    voters: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    texts: list[float] = field(default_factory=list)
    bias: float = -20.0


def word_counts(text: str | None) -> Counter[str]:
    text, at, out = (text or "").lower(), 0, Counter()
    while at < len(text):
        cut = _BETWEEN.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.end() if cut else len(text)
        out.update(_WORD.findall(text, at, end))
        at = end
    return out


def marks(counts: Counter[str]) -> set[str]:
    """Everything that could be a voter and fires in a text of these words."""
    starts: Counter[str] = Counter()
    for word, n in counts.items():
        for k in STARTS:
            if len(word) >= k:
                starts[word[:k]] += n
    return {"=" + w for w in counts} | {f"{k}{start}" for start, n in starts.items() for k in TIMES if n >= k}


class Votes:
    """The voters that fire in a text."""

    def __init__(self, voters: list[str]):
        self.words = {v[1:]: k for k, v in enumerate(voters) if v[0] == "="}
        self.starts: dict[str, list[tuple[int, int]]] = {}
        for k, v in enumerate(voters):
            if v[0] != "=":
                self.starts.setdefault(v[1:], []).append((int(v[0]), k))
        self.lengths = sorted({len(start) for start in self.starts})

    def __call__(self, counts: Counter[str]) -> list[int]:
        out = [self.words[w] for w in self.words.keys() & counts.keys()]
        begun: Counter[str] = Counter()
        for word, n in counts.items():
            for k in self.lengths:
                if word[:k] in self.starts and len(word) >= k:
                    begun[word[:k]] += n
        out += [k for start, n in begun.items() for least, k in self.starts[start] if n >= least]
        return sorted(out)


def hashed(counts: Counter[str]) -> np.ndarray:
    """Logarithms of the counts of words and of their longer starts in BUCKETS
    places, as a vector of length 1."""
    at, n = [], []
    for word, k in counts.items():
        k = math.log1p(k)
        at.append(zlib.crc32(word.encode()) % BUCKETS)
        n.append(k)
        for length in (5, 7):
            if len(word) > length:
                at.append(zlib.crc32(word[:length].encode(), 1) % BUCKETS)
                n.append(k)
    x = np.bincount(np.array(at, np.int64), np.array(n), BUCKETS) if at else np.zeros(BUCKETS)
    return x / max(np.linalg.norm(x), 1e-9)


def held_out() -> Column:
    """True for rows whose labels are not learned from; rows without doc_id too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count = Counter(), Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            count[toxic].update(marks(word_counts(text)))
        names = list(count[0].keys() | count[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([count[1][x] for x in names], pa.int64()),
                                          pa.array([count[0][x] for x in names], pa.int64())], names=["mark", "n1", "n0"])


def _described(voters: list[str]):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(voters)
        for batch in batches:
            counts = [word_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([votes(c) for c in counts], pa.list_(pa.int32())),
                                              pa.array([hashed(c).astype("<f4").tobytes() for c in counts], pa.binary())], names=["fired", "texts"])
    return describe


def _g(n1: Column, n0: Column, all1: int, all0: int) -> Column:
    """G statistic of a mark against the label, 0 where it goes with label 0."""
    n, total = n1 + n0, all1 + all0

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (term(n1, n * all1 / total) + term(n0, n * all0 / total)
             + term(F.lit(all1) - n1, (F.lit(total) - n) * all1 / total) + term(F.lit(all0) - n0, (F.lit(total) - n) * all0 / total))
    return F.when(n1 * all0 > n0 * all1, g).otherwise(0.0)


def distinct_voters(votes: np.ndarray, most: int = VOTERS) -> list[int]:
    """The first of the voters (columns) that fire alike, ``most`` at most."""
    first: dict[bytes, int] = {}
    for k in range(votes.shape[1]):
        first.setdefault(np.packbits(votes[:, k]).tobytes(), k)
    return sorted(first.values())[:most]


def label_model(votes: np.ndarray, share: float, precision: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of the hidden label for each row of 0/1 votes, where label 1 has
    ``share`` of all rows and voters start at their ``precision``.

    Firing rates by label are estimated in turn with the posteriors.
    ``1 / (1 + agreement)`` tempers each voter's evidence, where agreement adds
    its positive correlations with the others given the label.
    """
    voted = votes.sum(1) > 0
    fires = np.hstack([votes, ~voted[:, None]]).astype(np.float64)  # the last one votes clean
    p = np.where(voted, (votes * precision).max(1, initial=0), 0.0)
    left = max(share * len(p) - p.sum(), 0.02 * share * len(p))  # label 1 among rows without a vote
    p[~voted] = min(0.5, left / max(1, (~voted).sum()))
    for _ in range(rounds):
        rate, agreement = [], np.zeros(fires.shape[1])
        for q in (p, 1 - p):
            r = (q @ fires + 0.5) / (q.sum() + 1)
            rate.append(r)
            apart = (fires - r) * np.sqrt(q)[:, None]
            spread = np.sqrt((apart**2).sum(0)) + 1e-9
            together = np.clip((apart.T @ apart) / np.outer(spread, spread), 0, 1)
            agreement += q.mean() * (together.sum(1) - together.diagonal())
        evidence = fires @ ((np.log(rate[0]) - np.log(rate[1])) / (1 + agreement))
        new = 1 / (1 + np.exp(-np.clip(evidence + math.log(share / (1 - share)), -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            return new
        p = new
    return p


def linear(x: np.ndarray, p: np.ndarray, ridge: np.ndarray, rounds: int = 30, block: int = 1024) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton's steps with a ridge for
    each feature.  Sums run over blocks of rows, in double precision, so that
    beside ``x`` little memory is needed."""
    w, ridge = np.zeros(x.shape[1] + 1), np.append(ridge, 1e-3)
    for _ in range(rounds):
        curve, slope = np.diag(ridge), ridge * w
        for at in range(0, len(x), block):
            rows = np.hstack([x[at:at + block], np.ones((len(x[at:at + block]), 1))]).astype(np.float64)
            y = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
            curve += (rows * (y * (1 - y) + 1e-9)[:, None]).T @ rows
            slope += rows.T @ (y - p[at:at + block])
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(voters: list[str], precision: list[float], fired: list[list[int]], texts: np.ndarray, share: float) -> tuple[Model, np.ndarray]:
    """The model and the posterior labels of the sample's rows, which it is trained on."""
    votes = np.zeros((len(fired), len(voters)), np.uint8)
    for row, f in zip(votes, fired):
        row[f] = 1
    chosen = distinct_voters(votes)
    votes = votes[:, chosen]
    p = label_model(votes, share, np.array(precision)[chosen])
    ridge = np.repeat([VOTE_RIDGE, TEXT_RIDGE], [len(chosen), texts.shape[1]])
    w, bias = linear(np.hstack([votes.astype(np.float32), texts.astype(np.float32)]), p, ridge)
    return Model([voters[k] for k in chosen], w[:len(chosen)].tolist(), w[len(chosen):].tolist(), bias), p


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Held-out rows and rows with a null doc_id or label are left out; of
    repeated labels the largest counts.  Above ``sample`` labelled rows, a part
    chosen by hash is used.  Without labelled rows of both kinds the model has
    no voters.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    known = stored(known, "toxic-labels")
    share = min(1.0, sample / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .join(known, "doc_id").select("text", "toxic"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    share = sizes[1] / (sizes[0] + sizes[1])
    g = _g(F.col("n1"), F.col("n0"), sizes[1], sizes[0])
    precision = (F.col("n1") + PRIOR * share) / (F.col("n1") + F.col("n0") + PRIOR)
    found = texts.mapInArrow(_counted, "mark string, n1 bigint, n0 bigint").groupBy("mark") \
        .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.col("n1") >= LEAST_TEXTS).select("mark", g.alias("g"), precision.alias("precision"))
    found = found.where((F.col("g") >= LEAST_G) & (F.col("precision") >= PRECISION)).orderBy(F.col("g").desc(), "mark").limit(4 * VOTERS).collect()
    if not found:  # nothing is known to be toxic
        return Model(bias=math.log(share / (1 - share)) if share < 0.4 else -1.0)
    voters = [r["mark"] for r in found]
    seen = texts.select("text").mapInArrow(_described(voters), "fired array<int>, texts binary").toArrow()
    rows = np.stack([np.frombuffer(x.as_py(), "<f4") for x in seen.column("texts")])
    return fit(voters, [r["precision"] for r in found], seen.column("fired").to_pylist(), rows, share)[0]


def scorer(model: Model):
    """Score of a text column, as an Arrow-batched function."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        votes, weights = Votes(model.voters), np.array(model.texts)
        for series in texts:
            out = []
            for text in series:
                z = model.bias
                if model.voters:
                    counts = word_counts(text)
                    z += sum(model.weights[k] for k in votes(counts)) + float(hashed(counts) @ weights)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pd.Series(out, dtype="float64")
    return score


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Empty and null texts get the score of a text in which no voter fires and no
    word stands.  Rows that repeat are scored alike.  Empty tables give an empty
    result; without usable labels all scores are near 0, without voters all are
    the share of label 1, below 0.5.  Other columns are not read.
    """
    model = train(docs, labels)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                        scorer(model)(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic; null and empty texts stay.
    All columns stay as they are, whatever their names."""
    return docs.where(scorer(train(docs, labels))(F.col("text").cast("string")) < 0.5)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
