"""Steps on the tables of a batch run: answers to its prompts, their evaluation and review, and the
issue classifier (S16-S19, D5, A11, E15, E16, T9-T17, A12).

    python -m plaintscope.followup --out /shared/complaints-run --theme-answers answers.json --batch-id day-7
    python -m plaintscope.followup --out /shared/complaints-run --train --batch-id model-3

Answers are JSON lines: ``product``, ``term`` and ``answer_json`` (the model's text) for themes,
``complaint_id`` and ``answer_json`` for the single complaint. Results are appended under the batch id
(``buckets.append_results``), so a batch that is run again after a failure is stored once. Themes are
few per product; narratives are read by the classifier alone.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DEFAULTS, Thresholds
from .operators import answers as A
from .operators import classify as K
from .session import cut_lineage
from .sources.buckets import append_results, manifest, read_results, read_table
from .sources.sinks import write_table

THEME = ["product", "term"]
UNKNOWN_THEME = "no prompt for this theme"
TWO_ANSWERS = "more than one answer for this theme"


def theme_intake(answers: DataFrame, prompts: DataFrame, selected: DataFrame,
                 model_name: str) -> tuple[DataFrame, DataFrame]:
    """(summaries, quarantine) of ``answers(product, term, answer_json)`` against the prompts they
    answer and the numbers of their themes.

    Answers that are equal count once. Different answers for one theme have no defined order, so none
    is taken; neither is one for a theme without a prompt. Every answer that is not in the summaries
    is in the quarantine with its reasons."""
    answers = answers.select(*THEME, "answer_json").distinct()
    per = answers.groupBy(*THEME).agg(F.count(F.lit(1)).alias("_n"), F.first("answer_json").alias("answer_json"))
    supplied = prompts.select(*THEME, "supporting_records", "supplied_ids")
    numbers = selected.select(*THEME, "recent_mentions", "baseline_mentions", "growth_rate_percent", "emergence_score")
    known = cut_lineage(per.join(supplied.join(numbers, THEME), THEME, "left"))
    reason = (F.when(F.col("supplied_ids").isNull(), F.lit(UNKNOWN_THEME))
              .when(F.col("_n") > 1, F.lit(TWO_ANSWERS)))
    refused = known.where(reason.isNotNull()).select(*THEME, reason.alias("problems"))
    good, bad = A.validate_theme_answers(known.where(reason.isNull()).drop("_n"), model_name=model_name)
    return good, bad.unionByName(refused)


def take_theme_answers(spark: SparkSession, out: str, path: str, batch_id: str,
                       model_name: str = "unnamed", th: Thresholds = DEFAULTS) -> DataFrame:
    """Judge the answers in ``path``, append what is good and what is not, write the evaluation of all
    themes' latest answers with its summary, and the themes still without one. Returns the evaluation."""
    answers = spark.read.schema("product string, term string, answer_json string").json(path)
    prompts = spark.read.parquet(f"{out}/theme_prompts")
    good, bad = theme_intake(answers, prompts, spark.read.parquet(f"{out}/selected_themes"), model_name)
    append_results(bad, f"{out}/theme_quarantine", batch_id)
    append_results(good, f"{out}/theme_summaries", batch_id)
    summaries = read_results(spark, f"{out}/theme_summaries", THEME)
    evaluation = cut_lineage(A.answer_evaluation(summaries, th))
    write_table(evaluation, f"{out}/answer_evaluation", fmt="csv")
    write_table(A.answer_evaluation_summary(evaluation), f"{out}/answer_evaluation_summary", fmt="csv")
    write_table(prompts.join(summaries, THEME, "left_anti").select(*THEME), f"{out}/themes_unanswered", fmt="csv")
    return evaluation


def take_complaint_answer(spark: SparkSession, out: str, path: str, batch_id: str,
                          model_name: str = "unnamed") -> DataFrame:
    """The answer to the run's single-complaint prompt. A bad one, one for another complaint and a
    missing one end the run (``BadAnswer``) before anything is stored."""
    asked = spark.read.parquet(f"{out}/complaint_prompt").select("complaint_id", "product", "recorded_issue")
    answers = spark.read.schema("complaint_id long, answer_json string").json(path).distinct()
    judged = A.validate_complaint_answer(asked.join(answers, "complaint_id", "left"))
    sound = A.sound_or_raise(judged).drop("answer_json").withColumn("model_name", F.lit(model_name))
    append_results(sound, f"{out}/complaint_analysis", batch_id)
    return read_results(spark, f"{out}/complaint_analysis", ["complaint_id"])


def take_review(spark: SparkSession, out: str, path: str) -> DataFrame:
    """Roll up the marks reviewers wrote into a copy of the evaluation (CSV with a header)."""
    reviewed = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rollup = cut_lineage(A.review_rollup(reviewed))
    write_table(rollup, f"{out}/review_rollup", fmt="csv")
    return rollup


def train(spark: SparkSession, out: str, batch_id: str, th: Thresholds = DEFAULTS) -> DataFrame:
    """Fit the issue classifier on the stored complaints and save it as one model in a folder of its
    own; write the held-out predictions, the report and the majority baseline's report. The run is
    appended to ``model_runs`` last, so ``load_model`` never finds a model that is not whole; a run that
    is held already is not fitted again."""
    held = manifest(spark, f"{out}/model_runs")
    if held and batch_id in held["folders"]:
        return read_results(spark, f"{out}/model_runs", ["run"])
    split = K.prepare_split(read_table(spark, f"{out}/complaints"), th)
    predictions, fitted = K.train_and_predict(split, th)
    report = cut_lineage(K.classification_report(predictions))
    folder = f"issue_models/{uuid.uuid4().hex}"
    fitted.pipeline().write().save(f"{out}/{folder}")
    write_table(predictions, f"{out}/issue_predictions")
    write_table(report, f"{out}/classification_report", fmt="csv")
    write_table(K.classification_report(K.majority_baseline(split)), f"{out}/baseline_report", fmt="csv")
    summary = K.run_summary(split, report).select(F.lit(batch_id).alias("run"), "*", F.lit(folder).alias("model_folder"))
    append_results(summary, f"{out}/model_runs", batch_id)
    return read_results(spark, f"{out}/model_runs", ["run"])


def load_model(spark: SparkSession, out: str, batch_id: str) -> PipelineModel:
    """The model a run has saved: ``transform`` adds ``predicted_issue`` to rows with a narrative."""
    row = read_results(spark, f"{out}/model_runs", ["run"]).where(F.col("run") == batch_id).first()
    if row is None:
        raise ValueError(f"no model run {batch_id} in {out}")
    return PipelineModel.load(f"{out}/{row['model_folder']}")


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--out", required=True, help="output folder of the batch run")
    ap.add_argument("--batch-id", required=True, help="name of this batch; run again under it after a failure")
    ap.add_argument("--model-name", default="unnamed", help="name of the model that wrote the answers")
    ap.add_argument("--theme-answers", help="JSON lines: product, term, answer_json")
    ap.add_argument("--complaint-answer", help="JSON lines: complaint_id, answer_json")
    ap.add_argument("--review", help="CSV copy of the evaluation with reviewers' marks")
    ap.add_argument("--train", action="store_true", help="fit and save the issue classifier")
    args = ap.parse_args()
    from .session import get_spark
    spark = get_spark("plaintscope-followup")
    if args.theme_answers:
        take_theme_answers(spark, args.out, args.theme_answers, args.batch_id, args.model_name)
    if args.complaint_answer:
        take_complaint_answer(spark, args.out, args.complaint_answer, args.batch_id, args.model_name)
    if args.review:
        take_review(spark, args.out, args.review)
    if args.train:
        train(spark, args.out, args.batch_id)


if __name__ == "__main__":
    main()
