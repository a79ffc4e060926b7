"""The toxicity operator's parts against plain versions, and its behaviour over
growing samples, clashing names, and tables without labels or rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import toxicity
from flowlens.llm.registry import QUERIES

SF = "/root/testdata/sf0.1"


def plain_marks(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    out = {"=" + w for w in words}
    for k in range(4, 8):
        begun = collections.Counter(w[:k] for w in words if len(w) >= k)
        out |= {f"{n}{s}" for s in begun for n in (1, 2, 3) if begun[s] >= n}
    return out


def plain_g(a, b, c, d):
    """G of the table [[a, b], [c, d]], 0 where the mark goes with label 0."""
    total, out = a + b + c + d, 0.0
    for o, row, col in ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)):
        out += o * math.log(o * total / (row * col)) if o else 0.0
    return 2 * out if a * d > b * c else 0.0


def texts(n, seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices("abcdefgh", k=k))
    rows = []
    for i in range(n):
        words = [word(rng.randint(2, 7)) for _ in range(rng.randint(5, 60))]
        bad = i % 7 == 0
        for _ in range(rng.randint(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zuzz", "vile", "grimtak" + word(3), "grimtak" + word(2)]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_voters(spark, monkeypatch):
    """The voters of a sample: marks counted, tested, shrunk and told apart."""
    rows = [r for r in texts(700, 4) if zlib.crc32(str(r[0]).encode()) % 5]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    got = toxicity.train(docs, labels)
    n1 = sum(t for *_, t in rows)
    n0, share = len(rows) - n1, n1 / len(rows)
    count = collections.Counter(), collections.Counter()
    by_row = [plain_marks(t) for _, t, _ in rows]
    for m, (_, _, toxic) in zip(by_row, rows):
        count[toxic].update(m)
    found = []
    for m, a in count[1].items():
        b = count[0][m]
        if a >= 3 and plain_g(a, b, n1 - a, n0 - b) >= 18 and (a + 4 * share) / (a + b + 4) >= 0.6:
            found.append((-plain_g(a, b, n1 - a, n0 - b), m))
    fires = lambda m: frozenset(k for k, s in enumerate(by_row) if m in s)
    assert {fires(m) for m in got.voters} == {fires(m) for _, m in found} and len(got.voters) == len({fires(m) for m in got.voters}) > 2
    for text in [t for _, t, _ in rows[:50]] + [None, "", "zuzz", "grimtakx grimtaky"]:
        votes = toxicity.Votes(got.voters)(toxicity.word_counts(text))
        assert [got.voters[k] for k in votes] == [m for m in got.voters if m in plain_marks(text)]
    before = toxicity.word_counts(rows[1][1])
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert toxicity.word_counts(rows[1][1]) == before


def plain_label_model(votes, share, precision, rounds):
    """The same estimates, one number at a time."""
    n, m = len(votes), len(votes[0])
    voted = [any(v) for v in votes]
    fires = [list(v) + [0 if some else 1] for v, some in zip(votes, voted)]
    p = [max(q for q, f in zip(precision, v) if f) if some else 0.0 for v, some in zip(votes, voted)]
    left = max(share * n - sum(p), 0.02 * share * n)
    p = [x if some else min(0.5, left / (n - sum(voted))) for x, some in zip(p, voted)]
    for _ in range(rounds):
        rates, agreement = [], [0.0] * (m + 1)
        for q in (p, [1 - x for x in p]):
            r = [(sum(q[i] * fires[i][k] for i in range(n)) + 0.5) / (sum(q) + 1) for k in range(m + 1)]
            cov = [[sum(q[i] * (fires[i][a] - r[a]) * (fires[i][b] - r[b]) for i in range(n)) for b in range(m + 1)] for a in range(m + 1)]
            for a in range(m + 1):
                agreement[a] += sum(q) / n * sum(min(1, max(0, cov[a][b] / math.sqrt(cov[a][a] * cov[b][b]))) for b in range(m + 1) if b != a)
            rates.append(r)
        z = [math.log(share / (1 - share)) + sum(f * (math.log(rates[0][k]) - math.log(rates[1][k])) / (1 + agreement[k])
                                                 for k, f in enumerate(row)) for row in fires]
        p = [1 / (1 + math.exp(-x)) for x in z]
    return p


def test_label_model():
    rng = np.random.default_rng(7)
    y = rng.random(120) < 0.2
    votes = np.stack([rng.random(120) < np.where(y, a, b) for a, b in ((0.7, 0.02), (0.5, 0.05), (0.3, 0.01))], axis=1).astype(np.uint8)
    votes = np.hstack([votes, votes[:, :1]])  # a voter that repeats another
    for rounds in (1, 2, 5):
        got = toxicity.label_model(votes, 0.2, np.array([0.9, 0.7, 0.8, 0.9]), rounds)
        assert got == pytest.approx(plain_label_model(votes.tolist(), 0.2, [0.9, 0.7, 0.8, 0.9], rounds), abs=1e-6)
    assert ((got >= 0.5) == y).mean() > 0.85


def test_linear_is_the_optimum():
    rng = np.random.default_rng(8)
    x, p, ridge = rng.random((80, 3)), rng.random(80), np.array([0.1, 1.0, 1.0])
    w, bias = toxicity.linear(x, p, ridge)
    loss = lambda w, b: sum(math.log1p(math.exp(z)) - q * z for z, q in zip(x @ w + b, p)) + (ridge * w * w).sum() / 2 + 1e-3 * b * b / 2
    for k in range(4):
        for step in (1e-3, -1e-3):
            assert loss(w + step * np.eye(4)[k][:3], bias + step * np.eye(4)[k][3]) > loss(w, bias)


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, {r.doc_id: r.toxic for r in labels.collect()}


@pytest.mark.parametrize("sample, recall", [(1000, 0.75), (2000, 0.8), (8000, 0.9)])
def test_growing_samples(spark, given, monkeypatch, sample, recall):
    docs, labels, truth = given
    fitted, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: fitted.append((a[-1], fit(*a))) or fitted[-1][1])
    model = toxicity.train(docs, labels, sample)
    share, (_, p) = fitted[0]
    assert abs(p.mean() - share) <= share / 5
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.scorer(model)("text").alias("score"))
    held = [(r.score, truth[r.doc_id]) for r in scored.where("held_out").collect() if truth.get(r.doc_id) is not None]
    assert np.mean([s >= 0.5 for s, t in held if t]) >= recall
    assert np.mean([s >= 0.5 for s, t in held if not t]) <= 0.025


def test_rows_of_any_kind(spark):
    rows = texts(500, 9)
    odd = [(1000, None), (1001, ""), (1002, "zuzz " * 50000), (None, rows[7][1]), (7, rows[7][1]), (7, rows[8][1])]
    docs = spark.createDataFrame([(i, t, 5.0, "t", True, 1) for i, t in [r[:2] for r in rows] + odd],
                                 "doc_id bigint, text string, score double, toxic string, held_out boolean, predicted int")
    labels = spark.createDataFrame([(i, t, "x") for i, _, t in rows] + [(1000, None, "x"), (None, 1, "x"), (3, 0, "x")], "doc_id bigint, toxic int, text string")
    got = toxicity.score(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = {(r.doc_id, r.predicted) for r in got.collect()}
    assert got.count() == len(rows) + len(odd) and {(1000, 0), (1001, 0), (1002, 1), (None, 1), (7, 1), (7, 0)} <= out
    left = toxicity.reject(docs, labels)
    want = collections.Counter(tuple(r) for r in docs.collect() if not {"=zuzz", "=vile", "1grimtak"} & plain_marks(r.text))
    assert left.columns == docs.columns
    assert sum((collections.Counter(map(tuple, left.collect())) - want).values()) + sum((want - collections.Counter(map(tuple, left.collect()))).values()) <= 5
    assert toxicity.score(docs.limit(0), labels).count() == 0 and toxicity.score(docs, labels.limit(0)).where("predicted = 1").count() == 0
    few = labels.where(F.col("doc_id").isin(2, 7, 14))  # copies of label 1 and no voter
    assert toxicity.score(docs, few).where("predicted = 1").count() == 0


def test_query(spark):
    got = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01")
    assert got.count() == 1000 and got.where("score NOT BETWEEN 0 AND 1 OR (score >= 0.5) <> (predicted = 1)").count() == 0
