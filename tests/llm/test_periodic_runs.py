"""Periodic runs against a brute-force version, and on odd and empty tables."""

import fractions
import hashlib
import re
import zlib

import numpy as np
import pytest

from llm_tables import odd_docs, small_docs  # noqa: F401
from plaintscope.llm import periodic_runs as P
from plaintscope.llm import queries as Q

SF = "/root/testdata/sf0.001"


def brute_runs(w, min_words=24, min_exponent=3):
    out = []
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(min_words, min_exponent * q):
                x = w[i:i + n]
                if all(x[p:] != x[:-p] for p in range(1, q)):
                    out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def digest(w):
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (fractions.Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows_of(df):
    return sorted((tuple(r[:8]) for r in df.collect()), key=str)


def random_words(rng):
    parts = []
    for _ in range(rng.integers(1, 8)):
        top = int(rng.choice([2, 4, 900]))
        base = rng.integers(0, top, int(rng.integers(1, 30))).tolist()
        parts += base * int(rng.integers(1, 12)) + base[:int(rng.integers(0, 3))]
        parts += rng.integers(0, int(rng.choice([3, 500])), int(rng.integers(0, 20))).tolist()
    return [b"%d" % x for x in parts]


def test_runs_equal_brute_force():
    rng = np.random.default_rng(0)
    fib = [[b"a"], [b"a", b"b"]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    hard = [[], [b"a"] * 23, [b"a"] * 24, [b"a", b"b"] * 12, ([b"a"] * 30 + [b"b"]) * 6, fib[-1] * 2,
            ([b"a"] * 5 + [b"b"]) * 9 + [b"a"] * 40]
    found = 0
    for _ in range(25):
        texts = [random_words(rng) for _ in range(12)] + hard
        for w, got in zip(texts, P.runs_of_texts(texts)):
            assert got == brute_runs(w)
            found += len(got)
    assert found > 500


@pytest.mark.parametrize("limits", [(6, 2), (10, 2), (5, 4), (1, 3)])
def test_runs_under_other_limits(limits):
    rng = np.random.default_rng(1)
    texts = [random_words(rng)[:150] for _ in range(60)]
    assert P.runs_of_texts(texts, *limits) == [brute_runs(w, *limits) for w in texts]


def test_splitting_leaves_no_rare_word_and_loses_no_run():
    rng = np.random.default_rng(2)
    texts = [random_words(rng) for _ in range(30)]
    flat = np.array([hash(x) for t in texts for x in t], np.int64).view(np.uint64)
    doc = np.repeat(np.arange(30), [len(t) for t in texts])
    kept = np.zeros(len(flat), bool)
    for a, b in P.split_segments(flat, doc):
        assert doc[a] == doc[b - 1] and np.unique(flat[a:b], return_counts=True)[1].min() >= 3 and b - a >= 24
        kept[a:b] = True
    at = 0
    for t in texts:
        assert all(kept[at + s:at + s + n].all() for s, n, _ in brute_runs(t))
        at += len(t)


def test_a_word_per_round_does_not_cost_a_round_per_word(monkeypatch):
    # Each round takes the outermost words only; the scan takes over and finds the same.
    n = 3_000
    peel = [b"%d" % (abs(i) // 2) for i in range(-n, n)]
    monkeypatch.setattr(P, "FULL_ROUNDS", 3)
    text = peel + [b"x", b"y"] * 30
    assert P.runs_of_texts([text]) == [[(2 * n, 60, 2)]]


def test_long_texts():
    got = P.runs_of_texts([[b"a"] * 100_000, ([b"a"] * 30 + [b"b"]) * 2_000])
    assert got[0] == [(0, 100_000, 1)] and len(got[1]) == 2_001 and (0, 62_000, 31) in got[1]


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_digest_equals_brute_force(request, which):
    docs = request.getfixturevalue(which)
    got = rows_of(P.run_digest(P.periodic_runs(P.with_planted_run(docs))))
    want = [(r["doc_id"], *digest(planted(r["doc_id"], words(r["text"])))) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted(want, key=str)


def test_planted_runs_are_found(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10_000, 40 + i % 60))) for i in range(400)]
    got = rows_of(P.run_digest(P.periodic_runs(P.with_planted_run(spark.createDataFrame(rows, "doc_id long, text string")))))
    assert got == sorted(((i, *digest(planted(i, words(t)))) for i, t in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 10


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, "a b " * 30), (None, None), (7, "a b " * 30), (7, "a b " * 30), (7, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.periodic_runs(df).collect()
    assert sorted((r["n_words"], len(r["runs"]), r["collapsed"]) for r in got) == [
        (0, 0, ""), (2, 0, "other words"), (60, 1, "a b"), (60, 1, "a b"), (60, 1, "a b")]
    empty = P.run_digest(P.periodic_runs(P.with_planted_run(df.limit(0))))
    assert empty.count() == 0


def test_query(spark):
    got = Q.queries()["op13_periodic_runs"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
