"""Scaled sketches against brute force, and on odd, hot and empty tables."""

import base64
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import odd_docs, small_docs  # noqa: F401
from plaintscope.llm import queries as Q
from plaintscope.llm import scaled_sketch as S
from plaintscope.llm.shingles import column_sets

SF = "/root/testdata/sf0.001"


def shingles(t):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def retained(t, scale=S.SCALE):
    """The sketch by definition: hash by hash."""
    import pyarrow as pa
    top = sorted({int(h) >> 16 for h in next(iter(column_sets(pa.array([t or ""]))))})
    return [h for h in top if h < (1 << 48) // scale] or top[:1]


def printed(sketch, scale=S.SCALE):
    return f"{scale}:" + base64.b64encode(b"".join(h.to_bytes(6, "big") for h in sketch)).decode()


def alike(a, b, scale=S.SCALE):
    x, y = ({h for h in s if h < (1 << 48) // scale} for s in (a, b))
    if not x | y:
        return float(a == b), float(a == b)
    return len(x & y) / len(x | y), len(x & y) / len(x) if x else 0.0


def brute(rows):
    """Rows in order of descending id."""
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        a, b, c = retained(t), retained(e), retained(nxt)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), printed(a), printed(b), alike(a, b)[0],
                    alike(a, c)[0], alike(a, b)[1], alike(a, c)[1], len(a)))
    return out


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_next_document_equals_brute_force(request, which):
    docs = request.getfixturevalue(which)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), reverse=True)
    assert got(S.compare_with_next(docs)) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("chars", [1, 300])
def test_group_size_plays_no_part(small_docs, monkeypatch, chars):
    want = got(S.compare_with_next(small_docs))
    monkeypatch.setattr(S, "GROUP_CHARS", chars)
    assert got(S.compare_with_next(small_docs)) == want


def xx(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r["t"]: r["h"] for r in df.select("t", F.xxhash64("t").alias("h")).collect()}


@pytest.mark.parametrize("hot", [7, None, 3_000_000_000])
def test_an_id_of_half_of_all_rows_is_split(spark, hot):
    rng = np.random.default_rng(1)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 50, 30))
    rows = [(hot, text()) for _ in range(150)] + [(int(i), text()) for i in rng.choice(1000, 100, replace=False)]
    rows = [r for i, r in enumerate(rows) if i < 150 or r[0] != 7]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    parts, n = S._descending_parts(docs)
    hit = parts.where(F.col("doc_id").eqNullSafe(F.lit(hot)) & ~F.col("borrowed")).groupBy("part").count().collect()
    assert len(hit) >= 3 and n >= 8
    h = xx(spark, [t for _, t in rows])
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], h[r[1]]), reverse=True)
    assert got(S.compare_with_next(docs)) == sorted(brute(order), key=str)


def test_few_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert S.compare_with_next(spark.createDataFrame([], schema)).count() == 0
    assert S.sketch_documents(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(5, "one two three four five six seven")], [(5, "a b"), (5, "a b")], [(None, None)],
                 [((1 << 63) - 1, "x y z"), (-(1 << 63) + 1, "x y"), ((1 << 53) + 1, "p"), (1 << 53, "q")]):
        order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
        assert got(S.compare_with_next(spark.createDataFrame(rows, schema))) == sorted(brute(order), key=str)


def test_equal_texts_have_equal_fingerprints_and_estimates_are_near_the_truth(spark, small_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in small_docs.select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in S.sketch_documents(small_docs).collect()}
    by_text = {}
    for d, t in rows:
        assert by_text.setdefault(t, found[d]["fingerprint"]) == found[d]["fingerprint"]
    long = [(d, shingles(t)) for d, t in rows if len(t.split()) > 300]
    error = []
    for (d, a), (e, b) in zip(long, long[1:]):
        error.append(S.compare(np.array(found[d]["sketch"]), np.array(found[e]["sketch"]))[0] - len(a & b) / len(a | b))
    assert np.abs(error).max() < 0.2 and abs(np.mean(error)) < 0.02
    edited = {r["doc_id"]: r for r in S.compare_with_next(small_docs).collect()}
    order = sorted(rows, reverse=True)
    error = []
    for i, (d, t) in enumerate(order):
        e = t[:len(t) - len(t) // 2] + order[(i + 1) % len(order)][1][:len(t) // 2]
        a, b = shingles(t), shingles(e)
        if len(a) > 200:
            error.append((edited[d]["near_edited"] - len(a & b) / len(a | b), edited[d]["contained_edited"] - len(a & b) / len(a)))
    assert np.abs(np.mean(error, axis=0)).max() < 0.03 and np.std(error) < 0.1


def test_column_functions_equal_the_arrays(spark, small_docs):
    s = S.sketch_documents(small_docs).where("doc_id < 30")
    pairs = s.select("doc_id", F.col("sketch").alias("a")).join(s.select((F.col("doc_id") + 1).alias("doc_id"), F.col("sketch").alias("b")), "doc_id")
    odd = spark.createDataFrame([(1, [], []), (2, [], [5]), (3, [1 << 47], [1 << 47]), (4, [1 << 47], [5, 6]), (5, [5, 6], [1 << 47])],
                                "doc_id long, a array<long>, b array<long>")
    for r in pairs.unionByName(odd).select("a", "b", S.likeness(F.col("a"), F.col("b")).alias("l"),
                                           S.containment(F.col("a"), F.col("b")).alias("c")).collect():
        assert (r["l"], r["c"]) == S.compare(np.array(r["a"], np.int64), np.array(r["b"], np.int64))


def test_sketches_merge(spark):
    rng = np.random.default_rng(2)
    text = [" ".join(f"w{x}" for x in rng.integers(0, 10_000, 400)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    s = S.sketch_documents(docs).withColumn("g", F.expr("doc_id % 2"))
    merged = S.merge_sketches(s, "g")
    for g in (0, 1):
        want = {h for t in text[g::2] for h in retained(t)}
        assert {r["hash"] for r in merged.where(f"g = {g}").collect()} == want
    one = S.merge_sketches(s.where("doc_id = 2"), "doc_id")
    share = {r["g"]: r["contained"] for r in S.group_containment(merged, one, "g").collect()}
    assert 0.2 < share[0] < 0.5 and share[1] == 0
    whole = S.group_containment(one, merged.where("g = 0"), "doc_id").first()
    assert whole["contained"] == 1.0


def test_query(spark):
    out = Q.queries()["op12_scaled_sketch"](spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
