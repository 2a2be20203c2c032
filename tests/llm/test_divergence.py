"""The divergence audit against brute force, with small blocks, and on odd and empty tables."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import odd_docs, small_docs  # noqa: F401
from plaintscope.llm import divergence as D


def brute(rows, min_docs=10, top=10):
    """Rows (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    n, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = sorted({s for l, s, _ in rows if l == lang})
        v = len(kept)
        whole = collections.Counter()
        for s in sources:
            whole.update(n[lang, s])

        def p_of(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * v) for t in kept}

        p = {s: p_of(n[lang, s]) for s in sources}
        q = p_of(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            words = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(items[:most])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def rows_of(docs):
    return [tuple(r) for r in docs.select("lang", "source", "text").collect()]


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_equals_brute_force(request, which):
    docs = request.getfixturevalue(which)
    assert got(D.divergence(docs)) == brute(rows_of(docs))


def made(spark, n=300):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        source = None if i % 37 == 0 else f"s{rng.integers(0, 7)}" if i % 3 else "hot"
        lang = [None, "en", "enÿ", "日"][int(rng.choice(4, p=[.05, .7, .15, .1]))]
        text = None if i % 41 == 0 else " ".join(
            rng.choice(["Tie", "tie", "été", "É", "x1y", "a-b", "\U0001f600z"] + [f"w{chr(97 + x)}" for x in range(26)], 25))
        rows.append((lang, source, text, i, "clash"))
    rows += [("empty", "a", "", 1, ""), ("empty", "b", None, 1, ""), ("one", "a", "alone alone", 1, "")]
    return spark.createDataFrame(rows, "lang string, source string, text string, n long, id string").repartition(5)


def test_null_keys_ties_and_languages_without_terms(spark):
    docs = made(spark)
    want = brute(rows_of(docs))
    assert got(D.divergence(docs)) == want
    assert ("empty", "a", "pair", "b", 0, 1) in want and not any(r[0] == "one" for r in want)


def test_many_small_runs_and_pair_blocks_give_the_same(spark, monkeypatch):
    docs = made(spark)
    monkeypatch.setattr(D, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(D, "CHUNK_KEYS", 3)
    monkeypatch.setattr(D, "CHUNK_POSTINGS", 5)
    monkeypatch.setattr(D, "PAIR_BLOCK", 11)
    assert got(D.divergence(docs, min_docs=3, top_terms=4)) == brute(rows_of(docs), 3, 4)


def test_heap_merge_of_runs():
    rng = np.random.default_rng(5)
    total = collections.defaultdict(lambda: [0, 0])
    chunks = []
    for _ in range(20):
        block = D._Block()
        for _ in range(30):
            lang, source = rng.choice([b"a", b"ab", b"\xc3\xa9"]), rng.choice([b"s", b"t"])
            words = [bytes(x) for x in rng.choice([b"p", b"q", b"qq", b"z"], 3)]
            block.add(bytes(lang), bytes(source), words)
            for w in words:
                total[bytes(lang) + b"\xff" + w, source.decode()][0] += 1
            for w in set(words):
                total[bytes(lang) + b"\xff" + w, source.decode()][1] += 1
        chunks += list(D._chunks(block.run(4)))
        assert not block.size
    chunks.sort(key=lambda c: c[:2])
    keys, found = [], {}
    for c in D.merged(iter(chunks)):
        for i, key in enumerate(c.keys):
            keys.append(key)
            a, b = c.ends[i - 1] if i else 0, c.ends[i]
            found.update({(key, c.names[s].decode()): [n, d] for s, n, d in zip(c.at[a:b], c.n[a:b], c.docs[a:b]) if n})
    assert keys == sorted(set(keys)) and found == dict(total)


def test_probabilities_are_exact_beyond_64_bits(spark):
    cases = [(0, 0, 1), (5, 10, 3), (10 ** 13, 3 * 10 ** 13, 10 ** 7), (10 ** 15 + 7, 10 ** 15 + 7, 1), (0, 10 ** 16, 10 ** 9), (3, 3, 0)]
    df = spark.createDataFrame(cases, "n long, total long, kept long")
    got = df.select("n", "total", "kept", D._probability(F.col("n"), F.col("total"), F.col("kept")).alias("p")).collect()
    for r in got:
        want = 1 + 10 ** 9 * (r["n"] + 2) // (r["total"] + 2 * r["kept"]) if r["kept"] else None
        assert r["p"] == want


def test_two_sided_sums_do_not_mix_languages():
    rows = [("x", [1, 2, 5], [10, 700, 30], [1, 2, 3]), ("y", [1, 2], [90, 20], [4, 5]), ("x", [2, 5], [100, 3], [2, 3])]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows])] + [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (1, 2, 3)],
                                       names=["lang", "ids", "p", "zero"])
    f = lambda a, b: (a - b) ** 2 // (a + b)
    want = collections.Counter()
    for lang, ids, p, z in rows:
        for i in range(len(ids)):
            for j in range(i + 1, len(ids)):
                want[lang, ids[i], ids[j]] += f(p[i], p[j]) - f(p[i], z[j]) - f(z[i], p[j]) + f(z[i], z[j])
    found = collections.Counter()
    for b in D._two_sided(iter([batch])):
        for r in b.to_pylist():
            found[r["lang"], r["lo"], r["hi"]] += r["value"]
    assert found == want


def test_empty_table(spark):
    assert D.divergence(made(spark).limit(0)).count() == 0
