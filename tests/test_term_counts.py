"""Terms are counted in blocks: the same counts as a row per (document, term), however they are cut."""

import random

import pytest
from pyspark.sql import functions as F

from plaintscope.config import Thresholds
from plaintscope.functions.text import ngrams2
from plaintscope.operators import classify as K
from plaintscope.operators import themes as TH
from plaintscope.operators.term_counts import count_terms


def documents(spark, n=300):
    rnd = random.Random(5)
    names = ["late", "tale", "fee", "é", "ab", "ba", "x_1", "straße"]
    rows = [(rnd.choice(["a", "b", None]), [rnd.choice(names) for _ in range(rnd.randint(0, 12))], i % 2)
            for i in range(n)]
    rows += [("a", None, 1), (None, [], 1), ("b", ["fee"], 0), ("c", ["fee", "late"] * 400, 1)]
    return spark.createDataFrame(rows, "product string, words array<string>, late long")


def plain(rows, unigrams):
    """One row per occurrence, grouped twice."""
    terms = F.concat("words", ngrams2("words")) if unigrams else ngrams2("words")
    per = (rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("term", F.explode(terms))
           .groupBy("_row", "product", "late", "term").agg(F.count(F.lit(1)).alias("tf")))
    return per.groupBy("product", "term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("term_freq"),
                                              F.sum("late").alias("late"))


@pytest.mark.parametrize("block,buckets", [(1 << 19, None), (50, 3), (1, 1)])
@pytest.mark.parametrize("unigrams", [True, False])
def test_blocks_and_buckets_do_not_change_the_counts(spark, block, buckets, unigrams):
    rows = documents(spark).repartition(3)
    want = plain(rows, unigrams)
    got = count_terms(rows, ["product"], ["late"], unigrams, block=block, buckets=buckets)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    some = count_terms(rows, ["product"], ["late"], unigrams, at_least=9, block=block, buckets=buckets)
    assert sorted(map(str, some.collect())) == sorted(map(str, got.where("doc_freq >= 9").collect()))


def test_terms_of_equal_hash_are_told_apart(spark, monkeypatch):
    import numpy as np

    class Flat:  # all byte numbers 0: every word has the hash 0
        def integers(self, low, high, n, kind):
            return np.zeros(n, kind)

    monkeypatch.setattr("plaintscope.operators.term_counts.np.random.default_rng", lambda seed: Flat())
    rows = documents(spark).repartition(3)
    got = count_terms(rows, ["product"], ["late"], True, block=50)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain(rows, True).select(*got.columns).collect()))


def test_no_row_per_document_and_term_is_dealt(spark):
    rows = documents(spark).withColumn("consumer_complaint_narrative", F.array_join("words", " "))
    rows = rows.withColumn("period", F.lit("recent")).withColumn("complaint_id", F.lit(1))
    plans = [TH.term_document_counts(rows), K.tfidf_vocab(rows.drop("words"), Thresholds(max_vocab=None))]
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "hashpartitioning(_bucket" in text
    assert plans[1].count() > 0


def test_empty_input(spark):
    rows = documents(spark)
    assert count_terms(rows.where("false"), ["product"]).count() == 0
    assert count_terms(rows.where("words is null or size(words) = 0"), [], ["late"], True).count() == 0
