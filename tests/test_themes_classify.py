"""Theme scores from golden counts (F3), split quotas, weights and reports."""

import pytest
from pyspark.sql import functions as F

from plaintscope.operators import classify as K
from plaintscope.operators import themes as TH

# Golden rows: product, term, recent, baseline, recent total, baseline total -> rates, growth, score.
GOLDEN = [
    ("Credit card", "best buy", 9, 18, 110, 603, 8.18, 2.99, 174.09, 5.2),
    ("Credit card", "proof received", 3, 0, 110, 603, 2.73, 0.0, None, 2.73),
    ("Checking or savings account", "online banking", 12, 32, 109, 720, 11.01, 4.44, 147.71, 6.56),
    ("Checking or savings account", "formally request", 5, 3, 109, 720, 4.59, 0.42, 1000.92, 4.17),
]


def test_scores_match_golden(spark):
    df = spark.createDataFrame([g[:6] for g in GOLDEN],
                               "product string, term string, recent_mentions long, "
                               "baseline_mentions long, recent_total long, baseline_total long")
    out = TH.score_terms(df).select(
        "term", *[F.bround(c, 2).alias(c) for c in ("recent_rate_percent", "baseline_rate_percent",
                                                   "growth_rate_percent", "emergence_score")])
    got = {r.term: (r.recent_rate_percent, r.baseline_rate_percent, r.growth_rate_percent,
                    r.emergence_score) for r in out.collect()}
    for g in GOLDEN:
        assert got[g[1]] == g[6:], g[1]


def _labels(spark, sizes):
    rows, i = [], 0
    for cls, n in sizes.items():
        for _ in range(n):
            rows.append((i, cls, f"text {i}"))
            i += 1
    return spark.createDataFrame(rows, "complaint_id long, issue string, consumer_complaint_narrative string")


def test_split_is_exact_and_stratified(spark):
    sizes = {"a": 700, "b": 300, "c": 157, "d": 55}
    split = K.stratified_split(_labels(spark, sizes)).cache()
    n = sum(sizes.values())
    test = split.where("is_test").count()
    assert test == -(-n * 20 // 100)          # ceil(20 %)
    per = {r.issue: r["count"] for r in split.where("is_test").groupBy("issue").count().collect()}
    for cls, size in sizes.items():
        assert abs(per[cls] - size * 0.2) < 1
    assert split.count() == n
    again = K.stratified_split(_labels(spark, sizes)).where("is_test").select("complaint_id")
    assert again.exceptAll(split.where("is_test").select("complaint_id")).count() == 0


def test_class_filter_and_weights(spark):
    df = _labels(spark, {"a": 60, "b": 40, "c": 50})
    elig = K.eligible_rows(K.usable_narratives(df))
    assert sorted(r.issue for r in elig.select("issue").distinct().collect()) == ["a", "c"]
    w = {r.issue: r.weight for r in K.class_weights(elig).collect()}
    assert w["a"] == pytest.approx(110 / (2 * 60)) and w["c"] == pytest.approx(110 / (2 * 50))


def test_classification_report(spark):
    pred = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("z", "y")],
                                 "issue string, predicted_issue string")
    rep = {r.issue: r for r in K.classification_report(pred).collect()}
    assert rep["x"].precision == 1.0 and rep["x"].recall == 0.5
    assert rep["z"].precision == 0.0 and rep["z"].f1_score == 0.0
    assert rep["accuracy"].precision == 0.5 and rep["accuracy"].support == 0.5
    assert rep["macro avg"].support == 4.0


def test_top_k_by_count_matches_sort(spark):
    import random
    from plaintscope.operators.topk import top_k_by_count
    rnd = random.Random(7)
    rows = [(g, f"t{rnd.randint(0, 10**6):07d}{i}", rnd.choice([1, 1, 1, 2, 2, 3, 5, 8]))
            for g in ("a", "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, term string, c long")
    for k in (1, 10, 1000, 2500, 5000):
        got = sorted((r.g, r.term) for r in top_k_by_count(df, ["g"], "c", "term", k).collect())
        want = []
        for g in ("a", "b"):
            grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:k]
            want += [(r[0], r[1]) for r in grp]
        assert got == sorted(want), k


def test_top_k_without_groups_null_group_and_no_cap(spark):
    from plaintscope.operators.topk import top_k_by_count
    rows = [(None if i % 2 else "a", f"t{i:03d}", i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, term string, c long")
    assert top_k_by_count(df, ["g"], "c", "term", None) is df
    for groups in ([], ["g"]):
        got = sorted(r.term for r in top_k_by_count(df, groups, "c", "term", 37).collect())
        want = []
        for g in ({None, "a"} if groups else {0}):
            grp = [r for r in rows if not groups or r[0] == g]
            want += [r[1] for r in sorted(grp, key=lambda r: (-r[2], r[1]))[:37]]
        assert got == sorted(want)


def test_terms_are_counted_inside_the_row(spark):
    docs = spark.createDataFrame([(1, "loan fee loan fee loan", True), (2, "", False), (3, None, True), (4, "fee", False)],
                                 "complaint_id long, consumer_complaint_narrative string, is_test boolean")
    tf = K.term_frequencies(docs, keep=("is_test",))
    assert "Exchange" not in tf._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, tf.collect())) == [
        (1, True, "fee", 2), (1, True, "fee loan", 2), (1, True, "loan", 3), (1, True, "loan fee", 2),
        (4, False, "fee", 1)]


def test_saved_classifier_scores_as_the_fitted_one(spark, tmp_path):
    from plaintscope.sources import sinks
    words = {"a": "card charge dispute", "b": "loan payment late"}
    rows = [(i, c, f"{words[c]} case number{i % 9}") for i, c in enumerate("ab" * 60)]
    df = spark.createDataFrame(rows, "complaint_id long, issue string, consumer_complaint_narrative string")
    split = K.prepare_split(df)
    pred, fitted = K.train_and_predict(split)
    sinks.save_classifier(*fitted, str(tmp_path / "m"))
    loaded = K.IssueModel(*sinks.load_classifier(spark, str(tmp_path / "m")))
    got = dict(map(tuple, K.score(loaded, split.where("is_test")).collect()))
    assert got == {r.complaint_id: r.predicted_issue for r in pred.collect()}
    assert got == {i: c for i, c, _ in rows if i in got}
    new = spark.createDataFrame([(1, "a late loan payment"), (2, None), (3, "")],
                                "complaint_id long, consumer_complaint_narrative string")
    out = dict(map(tuple, K.score(loaded, new).collect()))
    assert out[1] == "b" and set(out) == {1, 2, 3}


def test_no_class_large_enough_is_an_error(spark):
    with pytest.raises(ValueError, match="no class"):
        K.train_and_predict(K.prepare_split(_labels(spark, {"a": 5})))
