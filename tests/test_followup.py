"""Answers to the prompts of a run, their evaluation and review, and the stored classifier."""

import json

import pytest
from pyspark.sql import functions as F

from plaintscope import followup as FU
from plaintscope import pipeline
from plaintscope.operators import answers as A
from plaintscope.schema import RAW_HEADER
from plaintscope.sources.buckets import read_results, read_table

HEAD = ["Complaint ID", "Date received", "Product", "Issue", "Company", "Consumer complaint narrative"]


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    """A batch run over complaints of two issues whose words tell them apart."""
    root = tmp_path_factory.mktemp("followup")
    said = {"billing": ("late fee charged wrongly", "monthly fee refund refused"),
            "access": ("login locked account", "password reset never arrived")}
    rows = []
    for i in range(240):
        issue = ("billing", "access")[i % 2]
        rows.append((str(i), f"2024-05-{1 + i % 28:02d}", "card", issue, "c", said[issue][i // 2 % 2]))
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(HEAD))))
    cols = [F.col(f"c{HEAD.index(h)}").alias(h) if h in HEAD else F.lit(None).cast("string").alias(h) for h in RAW_HEADER]
    df.select(*cols).coalesce(1).write.option("header", True).csv(str(root / "raw"))
    return pipeline.run(spark, str(root / "raw"), str(root / "run"))


def _lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def _answer(ids, **more):
    return json.dumps({"cluster_summary": "s", "customer_need": "n", "risk_implication": "r", "urgency": "High",
                       "recommended_action": "a", "confidence": 0.8, "requires_human_review": False,
                       "evidence_complaint_ids": ids} | more)


def test_theme_answers_are_taken_refused_and_evaluated(spark, out, tmp_path):
    prompts = spark.read.parquet(out + "/theme_prompts").orderBy("product", "term").collect()
    assert len(prompts) >= 3
    one, two, three = prompts[:3]
    own = int(one.supplied_ids.split(";")[0])
    rows = [{"product": one.product, "term": one.term, "answer_json": _answer([own, -1])}] * 2
    rows += [{"product": two.product, "term": two.term, "answer_json": _answer([1], urgency=u)} for u in ("Low", "High")]
    rows += [{"product": three.product, "term": three.term, "answer_json": "no json"}]
    rows += [{"product": "card", "term": "never asked", "answer_json": _answer([1])},
             {"product": None, "term": None, "answer_json": None}]
    path = _lines(tmp_path / "a.json", rows)
    for _ in range(2):  # the second run is a retry
        ev = FU.take_theme_answers(spark, out, path, "first", "m").collect()
    assert [(r.product, r.term, r.evidence_complaint_ids, r.model_name) for r in ev] == [(one.product, one.term, str(own), "m")]
    refused = {(r.product, r.term): r.problems for r in read_table(spark, out + "/theme_quarantine").collect()}
    assert len(refused) == 4 and read_table(spark, out + "/theme_quarantine").count() == 4
    assert refused[two.product, two.term] == FU.TWO_ANSWERS and refused["card", "never asked"] == FU.UNKNOWN_THEME
    assert refused[None, None] == FU.UNKNOWN_THEME and "missing urgency" in refused[three.product, three.term]
    assert spark.read.option("header", True).csv(out + "/themes_unanswered").count() == len(prompts) - 1

    again = _lines(tmp_path / "b.json", [{"product": p.product, "term": p.term, "answer_json": _answer([-5])} for p in prompts])
    ev = FU.take_theme_answers(spark, out, again, "second", "m2")
    assert ev.count() == len(prompts) and ev.where("model_name = 'm2' and requires_human_review").count() == len(prompts)
    total = spark.read.option("header", True).csv(out + "/answer_evaluation_summary").first()
    assert (total.outputs_evaluated, total.valid_evidence_ids) == (str(len(prompts)), "0")

    review = str(tmp_path / "review")
    (ev.withColumn("manual_grounded", F.when(F.col("term") == one.term, "yes").otherwise(""))
     .write.option("header", True).csv(review))
    rolled = {r.measure: r.result for r in FU.take_review(spark, out, review).collect()}
    assert rolled["manual_grounded"] == "1/1" and rolled["confidence_valid"] == f"{len(prompts)}/{len(prompts)}"


def test_a_bad_complaint_answer_ends_the_run(spark, out, tmp_path):
    asked = spark.read.parquet(out + "/complaint_prompt").first().complaint_id
    sound = json.dumps({"summary": "s", "primary_theme": "p", "urgency": "Low", "recommended_action": "a",
                        "supporting_evidence": "e", "confidence": 0.5, "requires_human_review": True})
    for rows in ([{"complaint_id": asked, "answer_json": sound + " tail"}], [{"complaint_id": asked + 1, "answer_json": sound}], []):
        with pytest.raises(A.BadAnswer, match=f"complaint {asked}"):
            FU.take_complaint_answer(spark, out, _lines(tmp_path / "x.json", rows), "bad")
    with pytest.raises(Exception):
        read_table(spark, out + "/complaint_analysis").count()
    good = _lines(tmp_path / "y.json", [{"complaint_id": asked, "answer_json": sound}])
    got = FU.take_complaint_answer(spark, out, good, "good", "m").collect()
    assert [(r.complaint_id, r.urgency, r.model_name) for r in got] == [(asked, "Low", "m")]


def test_the_stored_model_scores_raw_narratives(spark, out):
    runs = FU.train(spark, out, "m1").collect()
    assert [(r.run, r.training_records, r.testing_records, r.accuracy) for r in runs] == [("m1", 192, 48, 1.0)]
    new = spark.createDataFrame([(1, "a fee was charged"), (2, "my password and login"), (3, None)],
                                "n int, consumer_complaint_narrative string")
    got = {r.n: r.predicted_issue for r in FU.load_model(spark, out, "m1").transform(new).collect()}
    assert got[1] == "billing" and got[2] == "access" and len(got) == 3
    report = spark.read.option("header", True).csv(out + "/classification_report")
    assert report.where("issue = 'accuracy' and precision = 1.0").count() == 1
    assert FU.train(spark, out, "m1").count() == 1  # a retry is the same run
    assert read_results(spark, out + "/model_runs", ["run"]).count() == 1
    with pytest.raises(ValueError, match="no model run"):
        FU.load_model(spark, out, "m9")
