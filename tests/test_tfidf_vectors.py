"""TF-IDF vectors are made inside a document's row, also where rows share an id."""

import numpy as np
import pytest

from plaintscope.config import Thresholds
from plaintscope.operators import classify as K
from plaintscope.session import cut_lineage

DOCS = "complaint_id long, issue string, consumer_complaint_narrative string"
TEXTS = ["loan fee loan fee loan", "", None, "fee", "card card fee loan", "never seen words 1", "fee loan fee", "card loan"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def parts(spark, ids):
    docs = spark.createDataFrame([(i, f"c{k}", t) for k, (i, t) in enumerate(zip(ids, TEXTS, strict=True))], DOCS)
    runs = cut_lineage(K.term_runs(docs, keep=("issue",)))
    vocab = (K.tfidf_vocab(docs, Thresholds(min_doc_freq=2, max_vocab=5))
             .selectExpr("*", f"{len(TEXTS)}D AS n_train"))
    return runs, cut_lineage(vocab)


def by_issue(rows):
    return {r.issue: (list(r.indices), list(r["values"])) for r in rows.collect()}


def close(got, want):
    assert set(got) == set(want) and len(want) == len(TEXTS)
    for issue, (indices, values) in want.items():
        assert got[issue][0] == indices and np.allclose(got[issue][1], values, rtol=1e-14, atol=0)


def test_vectors_equal_the_join(spark):
    runs, vocab = parts(spark, range(8))
    size = vocab.count()
    want = by_issue(K.with_features(runs.select("complaint_id", "issue"),
                                    K.tfidf_weights(runs, vocab, tf=K.explode_runs(runs))))
    close(by_issue(K.tfidf_rows(runs, vocab, size)), want)
    close(by_issue(K.tfidf_rows(runs, vocab, size, bound=1)), want)
    got = {r.issue: r.features for r in K.tfidf_vectors(runs, vocab, size).collect()}
    assert {v.size for v in got.values()} == {size}
    close({i: (list(v.indices), list(v.values)) for i, v in got.items()}, want)


@pytest.mark.parametrize("bound", [1, 100])
def test_rows_of_one_id_have_their_own_vectors(spark, bound):
    runs, vocab = parts(spark, range(8))
    want = by_issue(K.tfidf_rows(runs, vocab, vocab.count()))
    close(by_issue(K.tfidf_rows(parts(spark, [1] * 8)[0], vocab, vocab.count(), bound)), want)
    without = by_issue(K.tfidf_rows(parts(spark, [None] * 8)[0], vocab, vocab.count(), bound))
    assert set(without) == set(want) and set(map(str, without.values())) == {"([], [])"}


def test_repeated_rows_can_be_trained_on(spark):
    rows = [(i, c, f"{w} number{i % 9}") for i, (c, w) in enumerate([("a", "card charge"), ("b", "loan late")] * 40)]
    split = K.prepare_split(spark.createDataFrame(rows * 2, DOCS))
    pred = K.train_and_predict(split)[0].collect()
    assert len(pred) == 32 and all(r.issue == r.predicted_issue for r in pred)


def test_no_row_is_shuffled_for_its_vector(spark):
    runs, vocab = parts(spark, range(8))
    rows = K.row_features(runs, vocab.collect())
    assert "Exchange" not in plan(rows) and "Join" not in plan(rows)
    assert len(by_issue(rows)["c0"][0]) == 4 and by_issue(rows)["c1"] == ([], []) == by_issue(rows)["c2"]


def test_no_vocabulary_gives_zero_vectors(spark):
    runs, vocab = parts(spark, range(8))
    got = K.tfidf_vectors(runs, vocab.where("false"), 1).collect()
    assert len(got) == len(TEXTS) and all(r.features.size == 1 and not len(r.features.values) for r in got)
