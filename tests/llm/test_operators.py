"""Each operator against a brute-force version on small rows with nulls, empty
and very long texts, ties, repeated rows, clashing columns and no rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from flowlens.llm import bpe, licenses, mixing, near_dup, pii, sharding, span_dedup, topk, toxicity, vector_dup

DOCS = "doc_id bigint, text string, source string, size string, row int, h string, n_chars bigint"
VECS = "vec_id bigint, embedding array<float>, label int, v string, row int"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 200)) for _ in range(30)]
    passage = ". ".join(prose(rng, 9) for _ in range(12)) + ". "
    near = base[3].split()
    out = base + [base[0]] * 6 + [None, "", " \n\t", "One two", "ONE  two", "É́ × K \U0001f600 ' 'll", "a" * 4000]
    out += [" ".join(near[:k] + ["changed"] + near[k + 1:]) for k in range(0, len(near), 40)]
    out += [prose(rng, 30) + " " + passage + prose(rng, 30) for _ in range(4)]
    out += ["mail me at a.b@c.example.org or x@y.z_d@e.f, call +1 (979) 555-6697 from 10.20.30.255 or 300.1.1.1",
            "card 4111 1111 1111 1111 and 4111111111111112, iban GB82 WEST 1234 5698 7654 32, ssn 078-05-1120",
            "GNU General-Public\nLicense; mit LICENSE, Apache license. CC BY-NC all rights reserved cc by",
            "the GPL: free software, redistribute and modify it under the terms of the GNU General Public License", "0" * 3000,
            " ".join(prose(rng, 40) for _ in range(100))]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 7}" if i % 9 else None, "x", -1, "y", None if t is None else len(t)) for i, t in enumerate(texts())]
    rows += [rows[2], rows[2], (None, "no id", "s1", "x", 0, "y", 5), (4, "the same id, another text", "s1", "x", 0, "y", 5)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_bpe(docs, none):
    path = public_tokenizers.path(bpe.RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = []
    for i, t in rows_of(docs):
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert collections.Counter(map(tuple, bpe.digests(docs).collect())) == collections.Counter(want)
    assert bpe.digests(none).count() == 0


def test_bpe_blocks(docs, monkeypatch):
    before = collections.Counter(map(tuple, bpe.digests(docs).collect()))
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 500)
    monkeypatch.setattr(bpe, "HELD_BYTES", 1)  # places go back batch by batch
    assert collections.Counter(map(tuple, bpe.digests(docs).collect())) == before


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_sharding(docs, none, slack):
    got = sharding.shard(docs, 7, slack).collect()
    rows = rows_of(docs)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(7)]
    assert max(sizes) <= -(-len(rows) * (1 + slack) // 7) if slack else max(sizes) - min(sizes) <= 1
    assert sharding.shard(none, 7).count() == 0


def test_walk_goes_clockwise():
    nodes = [(10, 0), (20, 1), (30, 2)]
    assert sharding.walk({5: 4, 15: 1, 25: 1}, nodes, [2, 2, 2]) == [
        (5, 0, 2, 0, 0), (15, 0, 1, 1, 0), (25, 0, 1, 2, 0), (5, 2, 3, 1, 1), (5, 3, 4, 2, 1)]


def test_spans(docs, none):
    got = {(r.doc_id, r.removed_chars, r.text) for r in span_dedup.deduplicate(docs).collect()}
    seen, want = set(), set()
    digest = lambda t: span_dedup.xxhash.xxh64_intdigest(t or "")
    for i, t in sorted(set(rows_of(docs)), key=lambda r: (r[0] is None, r[0], digest(r[1]))):
        gone = set()
        for a, b, h in span_dedup.text_spans(t or ""):
            gone.update(range(a, b) if h in seen else ())
            seen.add(h)
        want.add((i, len(gone), None if t is None else "".join(c for k, c in enumerate(t) if k not in gone)))
    assert got == want and any(n for _, n, _ in got)
    assert span_dedup.deduplicate(none).count() == 0


def test_sentences_cover_text():
    for t in texts():
        ends = [e for e, _ in span_dedup.sentences(t or "")]
        assert ends == sorted(ends) and (not ends or ends[-1] == len(t))


def test_span_in_every_run_of_51_words():
    rng = random.Random(11)
    for k in range(600):
        vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(rng.choice([2, 6, 400]))]
        words = lambda n: [rng.choice(vocabulary) + rng.choice([""] * 9 + marks) for _ in range(n)]
        marks = rng.choice([[""], [",", ".", "; ", "\n"]])
        run = " ".join(words(51))
        heads, tails = ([" ".join(words(rng.randint(0, 40))) for _ in range(2)] for _ in range(2))
        a, b = ({x[2] for x in span_dedup.text_spans(f"{h} {run} {t}") if x[0] >= len(h) and x[1] <= len(h) + len(run) + 2}
                for h, t in zip(heads, tails))
        assert a & b, (heads, run, tails)


def test_passage_within_sentences_is_removed(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=8))
    rows = []
    for k in range(40):
        passage = " ".join(word() for _ in range(51 + k % 20))
        rows += [(2 * k + j, " ".join(word() for _ in range(rng.randint(1, 30))) + f" {passage} " + " ".join(word() for _ in range(rng.randint(1, 30))))
                 for j in range(2)]
    got = {r.doc_id: r for r in span_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        assert got[i].n_removed == i % 2 and (got[i].text == text) == (i % 2 == 0)
        assert i % 2 == 0 or len(got[i].text) == len(text) - got[i].removed_chars <= len(text) - 24 * 9


@pytest.mark.parametrize("letters, n, end", [((0x4E00, 0x9FFF), 102, "。"), ((0x3041, 0x3096), 102, "、"), ((0x0E01, 0x0E2E), 204, "")])
def test_passage_without_spaces_is_removed(spark, letters, n, end):
    rng = random.Random(13)
    run = lambda k: "".join(chr(rng.randint(*letters)) + (end if rng.random() < 0.05 else "") for _ in range(k))
    rows = []
    for k in range(10):
        passage = run(n)
        rows += [(2 * k + j, run(rng.randint(1, 60)) + passage + run(rng.randint(1, 60))) for j in range(2)]
    rows += [(100 + k, run(60) + rows[0][1][60:60 + n // 6] + run(60)) for k in range(2)]
    got = {r.doc_id: r for r in span_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[i].n_removed == (i < 100 and i % 2) for i, _ in rows)


def test_toxicity(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        words = prose(rng, 60).replace(".", "").split()
        bad = i % 6 == 0
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), "zuzz" + rng.choice("abcdefgh") * rng.randint(1, 3))
        rows.append((i, None if i == 7 else " ".join(words), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, ""), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], None, r[2]) for r in rows] + [(3, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(900))
    assert np.mean([got[i].predicted == rows[i][2] for i in held if i != 7]) > 0.97
    nothing = toxicity.score(docs, labels.limit(0))
    assert nothing.where("predicted = 1").count() == 0


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            n = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 13 <= len(n) <= 19 and luhn(n), "phone": lambda: 9 <= len(n) <= 15}[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(docs, none):
    got = pii.find(docs).collect()
    told = lambda t: ",".join(plain_spans(t or ""))
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == collections.Counter(
        (i, hashlib.sha256(told(t).encode()).hexdigest()) for i, t in rows_of(docs))
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == sum(not s.startswith(("iban", "ssn")) for s in r.spans.split(",") if s) for r in got)
    assert {"iban", "ssn"} <= {s.split(":")[0] for r in got for s in r.spans.split(",")}
    assert pii.find(none).count() == 0


def test_iban_ends_where_the_number_does(spark):
    numbers = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947",
               "FR14 2004 1010 0505 0001 3M02 606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "BE68 5390 0754 7034"]
    rows = [(i, f"IBAN {n}{tail}") for i, (n, tail) in enumerate((n, t) for n in numbers for t in ("", " BIC COBADEFF", " 12 May", " " + numbers[0], "."))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {i: [f"iban:{m.start()}:{m.end()}" for m in re.finditer("|".join(numbers), t)] for i, t in rows}
    assert {r.doc_id: [s for s in r.spans.split(",") if s.startswith("iban")] for r in pii.find(docs).collect()} == want
    assert {r.doc_id: r.text for r in pii.redact(docs).collect() if r.doc_id == 1} == {1: "IBAN [iban] BIC COBADEFF"}


def test_redact(docs):
    got = {(r.doc_id, r.text) for r in pii.redact(docs).collect()}
    for i, t in rows_of(docs):
        if not t or not plain_spans(t) and "iban" not in t:
            assert (i, t) in got
    assert any(t and t.startswith("mail me at [email] or [email][email], call [phone] from [ip] or 300.1.1.1") for _, t in got)
    assert any(t and t.startswith("card [card] and 4111111111111112, iban [iban], ssn [ssn]") for _, t in got)
    assert pii.redact(docs).columns == docs.columns


def license_rows(df, rules):
    """Every template against every block of its length, by plain sets."""
    want = []
    for i, t in rows_of(df):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places, base, every, score = [], set(), set(), 0.0
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            places += at
            if at:
                base.add(label)
                score = 1.0
        for rule in rules[len(licenses.BASE):]:
            for b in range(0, max(1, len(w)), rule["length"] // 2):
                n = len(set(w[b:b + rule["length"]]) & set(rule["words"]))
                if n >= rule["need"]:
                    every.add(rule["label"])
                    score = max(score, n / len(rule["words"]))
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                     ",".join(sorted(base | every)), score))
    return collections.Counter(want)


def test_licenses(docs, none):
    assert collections.Counter(map(tuple, licenses.scan(docs).collect())) == license_rows(docs, licenses.catalogue())
    assert licenses.scan(none).count() == 0


def test_long_licenses(spark):
    """Templates of 170 and 600 different words, whole, damaged and cut, at any
    place of a text, and the catalogue's own texts; templates come as a table."""
    rng = random.Random(8)
    made = [f"w{k}" for k in range(900)]
    long, longer = rng.sample(made, 170), rng.sample(made, 600)
    templates = [("long", " ".join(long), 0.8), ("longer", ", ".join(longer), 0.9), ("none", "of the", 0.5), ("short", "w1 w2 w3", 1.0)]
    said = []
    for before in (0, 1, 31, 100, 255, 256, 700):
        fill = " ".join(rng.choices(["x", "y", "the", "w5"], k=before))
        said += [f"{fill} {' '.join(long).upper()} {fill}", f"{fill} {' '.join(longer)}"]
        for share in (0.75, 0.79, 0.8, 0.81, 0.95):
            said.append(fill + " " + " ".join(w for w in long if rng.random() < share))
            said.append(" ".join(longer[:int(600 * share)]) + " " + fill)
    said += [None, "", "w1 w2 w3", "xw1 w2 w3", "\u00e9w1 w2 w3 w3\u00e9"]
    df = spark.createDataFrame(list(enumerate(said)), "doc_id int, text string").repartition(3)
    got = licenses.scan(df, spark.createDataFrame(templates, "label string, text string, share double")).collect()
    assert collections.Counter(map(tuple, got)) == license_rows(df, licenses.catalogue(templates))
    labels = {r.doc_id: r.labels for r in got}
    assert all("long" in labels[k].split(",") for k in range(0, 7 * 12, 12)) and all("longer" in labels[k].split(",") for k in range(1, 7 * 12, 12))

    own = [(0, "# " + licenses.MIT.replace("\n", "\n# ")), (1, "text before it " * 50 + licenses.ISC), (2, licenses.ZLIB + " and after" * 300)]
    own = spark.createDataFrame(own, "doc_id int, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(own).collect()} == {0: "mit-notice,mit-text", 1: "isc-text", 2: "zlib-text"}
    assert collections.Counter(map(tuple, licenses.scan(own).collect())) == license_rows(own, licenses.catalogue())


def linked(n, edges, ids):
    root = list(range(n))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in edges:
        a, b = top(a), top(b)
        root[a] = b
    least = {}
    for k in range(n):
        least[top(k)] = min(least.get(top(k), ids[k]), ids[k])
    return [least[top(k)] for k in range(n)]


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def near_want(rows):
    sets = [shingle_set(t) for _, t in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0])
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = linked(len(rows), edges, [10**9 if i is None else i for i, _ in rows])
    return collections.Counter((i, len(s), None if i is None else c, i is None or i == c) for (i, _), s, c in zip(rows, sets, comp))


def test_near_duplicates(docs, none):
    got = collections.Counter(map(tuple, near_dup.near_duplicates(docs).collect()))
    assert got == near_want(rows_of(docs))
    assert near_dup.near_duplicates(none).count() == 0


def test_rows_of_one_doc_id_are_kept_by_text(spark):
    rng = random.Random(14)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    near = lambda t: t + " end"
    # 5: two unrelated texts and one row twice; 7: a near copy of 1 and a text of its own; 8: two near copies; 9: no text
    rows = [(1, a), (5, b), (5, c), (5, c), (7, near(a)), (7, d), (8, "x " + d[::-1]), (8, near("x " + d[::-1])), (9, ""), (9, c[::-1]), (None, a)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string")
    left = near_dup.deduplicate(docs)
    got = collections.Counter(rows_of(left))
    eight = [t for i, t in got if i == 8]
    assert left.columns == docs.columns and len(eight) == 1 and (8, eight[0]) in rows
    assert got == collections.Counter([(1, a), (5, b), (5, c), (7, d), (8, eight[0]), (9, ""), (9, c[::-1]), (None, a)])


def test_large_group_of_near_copies(spark, monkeypatch):
    """Copies linked with each other only in part, over several blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(11)
    hub, rows = prose(rng, 150).split(), []
    for i in range(120):
        w = list(hub)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "".join(rng.choices("xyz", k=6))
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert collections.Counter(map(tuple, near_dup.near_duplicates(df).collect())) == near_want(rows)
    kept = {i for (i, _, _, k) in near_want(rows) if k}
    assert {r.doc_id for r in near_dup.deduplicate(df).collect()} == kept


def test_mixing(spark, docs, none):
    got = mixing.mixture(docs).collect()
    count = lambda t: len(re.findall(mixing.WORD, t or ""))
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, count(t)) for i, t in rows_of(docs))
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    sums = collections.defaultdict(int)
    for r in got:
        sums[r.source, r.source_size, r.target] += r.taken
    assert all(abs(s - target) <= 0.5 and target <= 2 * size for (_, size, target), s in sums.items())
    total = sum(size for _, size, _ in sums)
    assert abs(sum(t for _, _, t in sums) - 1.5 * total) < 1e-6 * total
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted({k[0] for k in sums}, key=lambda s: (s is None, s or "")))}
    level = {round(t / weight[s], 6) for s, size, t in sums if t < 2 * size}
    assert len(level) <= 1 and all(t >= 2 * size or weight[s] * next(iter(level)) == pytest.approx(t) for s, size, t in sums)
    words = collections.Counter()
    for r in mixing.mix(docs).collect():
        words[r.doc_id] += count(r.text)
    taken = collections.Counter()
    for r in got:
        taken[r.doc_id] += r.taken
    assert +words == +taken and mixing.mix(docs).columns == docs.columns
    assert mixing.mixture(none).count() == 0 and mixing.mix(none).count() == 0


def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + 0.1 * rng.standard_normal(16)).astype(np.float32).tolist(), i % 3, "c", 9) for i in range(150)]
    rows += [(150, rows[0][1], 0, "c", 9), (151, rows[0][1], 1, "c", 9), (152, rows[0][1], None, "c", 9), (153, None, 0, "c", 9),
             (154, [0.0] * 16, 0, "c", 9), (155, [float("nan")] * 16, 0, "c", 9), (156, [1.0, None], 0, "c", 9), (157, [], 0, "c", 9),
             (158, [float("inf")] + [1.0] * 15, 0, "c", 9), (159, [1.0, 2.0], 0, "c", 9), (None, rows[0][1], 0, "c", 9), rows[6], rows[6]]
    return rows, spark.createDataFrame(rows, VECS)


def usable(v):
    return v is not None and None not in v and all(np.isfinite(v))


def test_topk(spark):
    rows, df = vectors(spark)
    own = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    want = collections.Counter()
    for a, (q, x) in enumerate(own):
        if q % 5 == 0:
            best = sorted((-int(np.dot(x, y)), c) for b, (c, y) in enumerate(own) if b != a and len(y) == len(x))[:10]
            want.update((q, k + 1, c, -s) for k, (s, c) in enumerate(best))
    assert collections.Counter(map(tuple, topk.top_k(df, every=5).collect())) == want
    assert topk.top_k(df.limit(0)).count() == 0


def test_topk_blocks(spark, monkeypatch):
    df = vectors(spark)[1]
    before = collections.Counter(map(tuple, topk.top_k(df, every=5).collect()))
    monkeypatch.setattr(topk, "VECTORS", 20)
    monkeypatch.setattr(topk, "QUERIES", 7)
    assert collections.Counter(map(tuple, topk.top_k(df, every=5).collect())) == before


@pytest.mark.parametrize("block", [1024, 8])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dup, "BLOCK", block)
    rows, df = vectors(spark)
    fit = [i is not None and label is not None and usable(v) and any(v) for i, v, label, *_ in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if f else None for f, (_, v, *_) in zip(fit, rows)]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if fit[a] and fit[b] and rows[a][2] == rows[b][2]
            and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= vector_dup.COSINE]
    links = collections.Counter(k for pair in near for k in pair)
    comp = linked(len(rows), near, [10**9 if r[0] is None else r[0] for r in rows])
    want = collections.Counter((r[0], links[k], None if r[0] is None else comp[k], r[0] is None or r[0] == comp[k]) for k, r in enumerate(rows))
    assert len(near) > 50
    assert collections.Counter(map(tuple, vector_dup.near_vectors(df).collect())) == want
    assert vector_dup.near_vectors(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert docs.dtypes == before.dtypes
        if name == "near_dedup":
            assert {r.doc_id for r in docs.collect()} == {i for (i, _, _, k) in near_want(rows_of(before)) if k}
        if name == "pii":
            texts_before = dict(rows_of(before))
            assert all((t == texts_before[i]) == (not plain_spans(texts_before[i] or "")) for i, t in rows_of(docs))
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and docs.count() > 0
