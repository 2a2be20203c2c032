"""Answer parsing, validation, evaluation and rollup (FIXTURES F4, F9)."""

import json

from pyspark.sql import functions as F

from plaintscope.operators import answers as A


def test_evaluation_flags(spark):
    df = spark.createDataFrame(
        [("1;2;3", 5, 0.9), ("1; ;2", 2, 1.0), (None, 4, None), ("1;2;3", 2, 1.2)],
        "evidence_complaint_ids string, supporting_records int, confidence double")
    for c in ("product", "term", "cluster_summary", "risk_implication", "urgency",
              "recommended_action", "requires_human_review", "model_name"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    got = [(r.evidence_id_count, r.evidence_ids_valid, r.minimum_evidence_met, r.confidence_valid)
           for r in A.answer_evaluation(df).collect()]
    assert got == [(3, True, True, True), (2, True, False, True), (0, False, True, False),
                   (3, False, False, False)]
    s = A.answer_evaluation_summary(A.answer_evaluation(df)).first()
    assert (s.outputs_evaluated, s.valid_evidence_ids, s.minimum_evidence_met, s.valid_confidence) == (4, 2, 2, 2)


def _answer(ids, urgency="High", confidence=0.8, review=False):
    return json.dumps({"cluster_summary": "s", "customer_need": "n", "risk_implication": "r",
                       "urgency": urgency, "recommended_action": "a", "confidence": confidence,
                       "requires_human_review": review, "evidence_complaint_ids": ids})


def test_validation_keeps_supplied_ids_in_order(spark):
    rows = [("p", "t1", _answer([7, 1, 1])), ("p", "t2", _answer([7])),
            ("p", "t3", _answer([1], urgency="Severe")), ("p", "t4", _answer([1], confidence=1.5)),
            ("p", "t5", '{"cluster_summary": "tru')]
    df = (spark.createDataFrame(rows, "product string, term string, answer_json string")
          .withColumns({"recent_mentions": F.lit(3), "baseline_mentions": F.lit(1),
                        "growth_rate_percent": F.lit(1.0), "emergence_score": F.lit(1.0),
                        "supporting_records": F.lit(2), "supplied_ids": F.lit("1;2")}))
    good, bad = A.validate_theme_answers(df)
    g = {r.term: r for r in good.collect()}
    assert g["t1"].evidence_complaint_ids == "1;1" and g["t1"].requires_human_review is False
    assert g["t2"].evidence_complaint_ids == "" and g["t2"].requires_human_review is True
    b = {r.term: r.problems for r in bad.collect()}
    assert b["t3"] == "bad urgency" and b["t4"] == "bad confidence"
    assert "missing urgency" in b["t5"]


def test_single_answer_validation(spark):
    ok = json.dumps({"summary": "s", "primary_theme": "p", "urgency": "Low", "recommended_action": "a",
                     "supporting_evidence": "e", "confidence": 0.5, "requires_human_review": True})
    df = spark.createDataFrame([(ok,), ('{"summary": 1}',)], "answer_json string")
    probs = [r.problems for r in A.validate_complaint_answer(df).collect()]
    assert probs[0] == "" and "missing urgency" in probs[1]


def test_review_rollup(spark):
    df = spark.createDataFrame([("yes", "true"), ("no", "true"), ("", "false")], "manual_grounded string, "
                               "confidence_valid string")
    out = {r.measure: r.result for r in A.review_rollup(df).collect()}
    assert out == {"manual_grounded": "1/2", "confidence_valid": "2/3"}


def test_answers_are_judged_by_the_lax_rules(spark):
    base = json.loads(_answer([1]))
    cases = [({"confidence": "0.5"}, ""), ({"confidence": " 1e-1 "}, ""), ({"confidence": True}, ""), ({"confidence": "high"}, "bad type of confidence"),
             ({"confidence": "NaN"}, "bad type of confidence"), ({"confidence": []}, "bad type of confidence"), ({"confidence": "1.5"}, "bad confidence"),
             ({"requires_human_review": "Off"}, ""), ({"requires_human_review": 1}, ""), ({"requires_human_review": 2}, "bad type of requires_human_review"),
             ({"requires_human_review": "maybe"}, "bad type of requires_human_review"), ({"cluster_summary": 3}, "bad type of cluster_summary"),
             ({"cluster_summary": ""}, ""), ({"cluster_summary": None}, "missing cluster_summary"), ({"urgency": "high"}, "bad urgency"),
             ({"evidence_complaint_ids": "1"}, "bad type of evidence_complaint_ids"), ({"evidence_complaint_ids": []}, ""),
             ({"evidence_complaint_ids": ["7", 8.0, False]}, ""), ({"evidence_complaint_ids": [[1]]}, "bad type of evidence_complaint_ids"),
             ({"evidence_complaint_ids": ["1.5"]}, "bad type of evidence_complaint_ids"), ({"more": {"urgency": 1}}, "")]
    df = spark.createDataFrame([(i, json.dumps(base | c)) for i, (c, _) in enumerate(cases)], "i int, answer_json string")
    got = df.select("i", A.parse_answer("answer_json").alias("a")).select("i", "a", F.array_join(A.answer_problems(F.col("a")), "; ").alias("p")).collect()
    assert {r.i: r.p for r in got} == {i: p for i, (_, p) in enumerate(cases)}
    by = {r.i: r.a for r in got}
    assert (by[1].confidence, by[2].confidence, by[7].requires_human_review, by[8].requires_human_review) == (0.1, 1.0, False, True)
    assert by[17].evidence_complaint_ids == [7, 8, 0]


def test_only_one_whole_json_object_is_an_answer(spark):
    ok = _answer([1])
    texts = [ok, f" {ok}\n", ok + "x", "x" + ok, ok + ok, ok + ",", ok + "],[", ok + "},{", f"[{ok}]", json.dumps(ok), "null", "", None, "{", "1,2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", A.parse_answer("t").getField("urgency").alias("u")).collect()}
    assert got == {i: "High" if i < 2 else None for i in range(len(texts))}


def test_blank_and_odd_supplied_ids_do_not_stop_the_job(spark):
    rows = [("a", _answer([1]), ""), ("b", _answer([1]), None), ("c", _answer([1, 2]), "x; 2 ;;99999999999999999999"), ("d", _answer([1]), "1.0")]
    df = (spark.createDataFrame(rows, "term string, answer_json string, supplied_ids string")
          .withColumns({c: F.lit(1) for c in ("product", "recent_mentions", "baseline_mentions", "growth_rate_percent",
                                              "emergence_score", "supporting_records")}))
    good, bad = A.validate_theme_answers(df)
    assert {r.term: (r.evidence_complaint_ids, r.requires_human_review) for r in good.collect()} == {
        "a": ("", True), "b": ("", True), "c": ("2", False), "d": ("", True)}
    assert bad.count() == 0
