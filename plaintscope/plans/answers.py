"""Answer validation, evaluation and review rollup over synthetic theme answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answers as A
from ..operators import themes as TH
from ..session import spread
from ..sources.adapters import synthetic_theme_answers
from .registry import register
from .themes import DOCS_CTE, EVIDENCE_CTE, THEMES_WITH, TOP3_CTE, _evidence, docs

ANSWERS_CTE = """
per AS (SELECT product, term, count(*) AS supporting_records,
               list(complaint_id ORDER BY evidence_rank) AS ids
        FROM evidence GROUP BY 1, 2),
ans AS (
  SELECT t.product, t.term, t.recent_mentions, t.baseline_mentions, t.growth_rate_percent,
         t.emergence_score, p.supporting_records, p.ids,
         t.recent_mentions % 7 = 0 AS malformed,
         ['Low', 'Medium', 'High', 'Critical', 'Severe'][t.recent_mentions % 5 + 1] AS urgency,
         CAST(t.recent_mentions AS DOUBLE) / 10.0 AS confidence,
         CASE WHEN t.recent_mentions % 3 = 0 THEN [CAST(-7 AS BIGINT)]
              WHEN t.recent_mentions % 2 = 0 THEN list_concat([CAST(-1 AS BIGINT)], p.ids, p.ids[1:1])
              ELSE p.ids END AS answer_ids
  FROM top3 t JOIN per p USING (product, term)),
valid AS (SELECT *, list_filter(answer_ids, lambda x: list_contains(ids, x)) AS grounded
          FROM ans
          WHERE NOT malformed AND urgency IN ('Low', 'Medium', 'High', 'Critical')
            AND confidence BETWEEN 0 AND 1),
summaries AS (
  SELECT product, term, recent_mentions, baseline_mentions, growth_rate_percent, emergence_score,
         supporting_records, 'Customers report ' || term AS cluster_summary,
         'Resolve ' || term AS customer_need, 'Service and conduct risk' AS risk_implication,
         urgency, 'Review cases mentioning ' || term AS recommended_action, confidence,
         (supporting_records < 3) OR len(grounded) = 0 AS requires_human_review,
         array_to_string(grounded, ';') AS evidence_complaint_ids, 'synthetic' AS model_name
  FROM valid),
evaluation AS (
  SELECT product, term, supporting_records, cluster_summary, risk_implication, urgency,
         recommended_action, confidence, requires_human_review, evidence_complaint_ids, model_name,
         CAST(len(list_filter(string_split(coalesce(evidence_complaint_ids, ''), ';'),
                              lambda x: trim(x) <> '')) AS INTEGER) AS evidence_id_count,
         len(list_filter(string_split(coalesce(evidence_complaint_ids, ''), ';'), lambda x: trim(x) <> '')) > 0
           AND len(list_filter(string_split(coalesce(evidence_complaint_ids, ''), ';'), lambda x: trim(x) <> ''))
               <= supporting_records AS evidence_ids_valid,
         supporting_records >= 3 AS minimum_evidence_met,
         coalesce(confidence BETWEEN 0 AND 1, false) AS confidence_valid,
         '' AS manual_grounded, '' AS manual_cluster_coherent, '' AS manual_actionable,
         '' AS unsupported_claims, '' AS urgency_appropriate, '' AS reviewer_notes
  FROM summaries)"""

BASE = f"{THEMES_WITH},{TOP3_CTE},{EVIDENCE_CTE},{ANSWERS_CTE}"


def _pipeline(spark, sf):
    _, selected, ev = _evidence(spark, sf)
    return A.validate_theme_answers(synthetic_theme_answers(selected, ev))


@register("answer_validation", f"{BASE}\nSELECT * FROM summaries")
def q_answer_validation(spark, sf):
    return _pipeline(spark, sf)[0]


@register("answer_quarantine", f"""{BASE}
SELECT product, term, array_to_string(list_filter([
         CASE WHEN malformed THEN 'missing cluster_summary' END,
         CASE WHEN malformed THEN 'missing customer_need' END,
         CASE WHEN malformed THEN 'missing risk_implication' END,
         CASE WHEN malformed THEN 'missing urgency' END,
         CASE WHEN malformed THEN 'missing recommended_action' END,
         CASE WHEN malformed THEN 'missing confidence' END,
         CASE WHEN malformed THEN 'missing requires_human_review' END,
         CASE WHEN malformed THEN 'missing evidence_complaint_ids' END,
         CASE WHEN NOT malformed AND urgency NOT IN ('Low', 'Medium', 'High', 'Critical') THEN 'bad urgency' END,
         CASE WHEN NOT malformed AND NOT (confidence BETWEEN 0 AND 1) THEN 'bad confidence' END],
       lambda x: x IS NOT NULL), '; ') AS problems
FROM ans
WHERE malformed OR urgency NOT IN ('Low', 'Medium', 'High', 'Critical') OR NOT (confidence BETWEEN 0 AND 1)""")
def q_answer_quarantine(spark, sf):
    return _pipeline(spark, sf)[1]


@register("answer_evaluation", f"{BASE}\nSELECT * FROM evaluation")
def q_answer_evaluation(spark, sf):
    return A.answer_evaluation(_pipeline(spark, sf)[0])


@register("answer_evaluation_summary", f"""{BASE}
SELECT count(*) AS outputs_evaluated, count(*) FILTER (WHERE evidence_ids_valid) AS valid_evidence_ids,
       count(*) FILTER (WHERE minimum_evidence_met) AS minimum_evidence_met,
       count(*) FILTER (WHERE confidence_valid) AS valid_confidence
FROM evaluation""")
def q_answer_eval_summary(spark, sf):
    return A.answer_evaluation_summary(A.answer_evaluation(_pipeline(spark, sf)[0]))


def _yes(cond):
    return F.when(cond, F.lit("yes")).otherwise(F.lit("no"))


def reviewed(evaluation):
    """Review marks by a fixed rule standing in for a human reviewer."""
    return evaluation.withColumns({
        "manual_grounded": _yes(F.col("evidence_ids_valid")),
        "manual_cluster_coherent": _yes(F.col("minimum_evidence_met")),
        "manual_actionable": _yes(F.col("urgency").isin("High", "Critical")),
        "unsupported_claims": _yes(~F.col("evidence_ids_valid")),
        "urgency_appropriate": _yes(~F.col("requires_human_review") | (F.col("urgency") != "Low")),
    })


def _rollup_sql() -> str:
    marks = {
        "evidence_ids_valid": "CAST(evidence_ids_valid AS VARCHAR)",
        "minimum_evidence_met": "CAST(minimum_evidence_met AS VARCHAR)",
        "confidence_valid": "CAST(confidence_valid AS VARCHAR)",
        "manual_grounded": "CASE WHEN evidence_ids_valid THEN 'yes' ELSE 'no' END",
        "manual_cluster_coherent": "CASE WHEN minimum_evidence_met THEN 'yes' ELSE 'no' END",
        "manual_actionable": "CASE WHEN urgency IN ('High', 'Critical') THEN 'yes' ELSE 'no' END",
        "unsupported_claims": "CASE WHEN NOT evidence_ids_valid THEN 'yes' ELSE 'no' END",
        "urgency_appropriate":
            "CASE WHEN NOT requires_human_review OR urgency <> 'Low' THEN 'yes' ELSE 'no' END",
    }
    parts = [f"SELECT {i} AS measure_order, '{m}' AS measure, lower(trim({e})) AS mark FROM evaluation"
             for i, (m, e) in enumerate(marks.items(), start=1)]
    return f"""{BASE},
m AS ({' UNION ALL '.join(parts)})
SELECT measure_order, measure, count(*) FILTER (WHERE mark IN ('true', 'yes', 'y', '1')) AS passed,
       count(*) AS reviewed,
       CAST(count(*) FILTER (WHERE mark IN ('true', 'yes', 'y', '1')) AS VARCHAR) || '/'
         || CAST(count(*) AS VARCHAR) AS result
FROM m WHERE mark IS NOT NULL AND mark <> '' GROUP BY 1, 2"""


@register("review_rollup", _rollup_sql())
def q_review_rollup(spark, sf):
    return A.review_rollup(reviewed(A.answer_evaluation(_pipeline(spark, sf)[0])))


def synthetic_complaint_answer(first):
    """Stand-in model answer for the single-complaint prompt, built from its row."""
    body = F.to_json(F.struct(
        F.concat(F.lit("Complaint about "), F.col("recorded_issue")).alias("summary"),
        F.col("product").alias("primary_theme"),
        F.lit("Medium").alias("urgency"),
        F.lit("Review the account history").alias("recommended_action"),
        F.substring(F.col("prompt"), 1, 30).alias("supporting_evidence"),
        F.lit(0.5).alias("confidence"),
        F.lit(True).alias("requires_human_review")))
    return first.select("complaint_id", "product", "recorded_issue", body.alias("answer_json"))


@register("complaint_answer_validation", f"""
WITH {DOCS_CTE},
f AS (SELECT * FROM d WHERE consumer_complaint_narrative IS NOT NULL
      ORDER BY date_received, complaint_id LIMIT 1)
SELECT complaint_id, product, issue AS recorded_issue, '' AS problems,
       'Complaint about ' || issue AS summary, product AS primary_theme, 'Medium' AS urgency,
       'Review the account history' AS recommended_action,
       substring('Summarise this single complaint for a customer-risk analyst.', 1, 30) AS supporting_evidence,
       CAST(0.5 AS DOUBLE) AS confidence, true AS requires_human_review
FROM f""")
def q_complaint_answer(spark, sf):
    first = TH.first_narrative_prompt(docs(spark, sf))
    return A.validate_complaint_answer(synthetic_complaint_answer(first)).drop("answer_json")


# Answer texts as models send them, by id: sound, odd but acceptable, and bad ones. [I] is the id.
HEAD = '"cluster_summary":"s[I]","customer_need":"n","risk_implication":"r","urgency":'
TAIL = ',"recommended_action":"a","confidence":'
LAST = ',"requires_human_review":'
IDS = ',"evidence_complaint_ids":'


def _answer(urgency='"High"', confidence="0.5", review="false", ids="[[I],-1,[I]]", head=HEAD, more=""):
    return "{" + head + urgency + TAIL + confidence + LAST + review + IDS + ids + more + "}"


def _all_missing():
    return "; ".join("missing " + f for f in (
        "cluster_summary", "customer_need", "risk_implication", "urgency", "recommended_action",
        "confidence", "requires_human_review", "evidence_complaint_ids"))


# (text, supplied ids, what the oracle expects: problems or (confidence, review, ids))
HOSTILE = (
    (_answer(), "[I];7", ("0.5", "false", "[I];[I]")),
    (_answer() + " as requested", "[I]", _all_missing()),
    (_answer(confidence='"0.25"', review='"yes"'), "[I]", ("0.25", "true", "[I];[I]")),
    (_answer(ids='["[I]",3.0,1.0]'), "3;[I]", ("0.5", "false", "[I];3")),
    (_answer(confidence="true", review="0"), "[I]", ("1.0", "false", "[I];[I]")),
    (_answer(confidence='"high"'), "[I]", "bad type of confidence"),
    (_answer(head=HEAD.replace('"s[I]"', "5")), "[I]", "bad type of cluster_summary"),
    (_answer(more=',"notes":{"urgency":"none"}'), "[I]", ("0.5", "false", "[I];[I]")),
    (_answer(review="null"), "[I]", "missing requires_human_review"),
    (_answer(ids="[[I],null]"), "[I]", "null in evidence_complaint_ids"),
    (_answer(ids="[[I],1.5]"), "[I]", "bad type of evidence_complaint_ids"),
    (_answer(), "", ("0.5", "true", "")),
    (_answer(), "x;; [I] ;1.5", ("0.5", "false", "[I];[I]")),
    (_answer(urgency="5", confidence="1.5"), "[I]", "bad type of urgency; bad confidence"),
    ("[" + _answer() + "]", "[I]", _all_missing()),
    (_answer() + _answer(), "[I]", _all_missing()),
    (_answer() + "],[", "[I]", _all_missing()),
    (_answer(urgency='"Severe"', review='"perhaps"'), "[I]", "bad type of requires_human_review; bad urgency"),
)


def hostile_answers(docs):
    """One answer per document, by turns of the texts above."""
    n = F.col("doc_id").cast("string")
    fill = lambda texts: F.replace(F.element_at(F.array(*map(F.lit, texts)), (F.col("doc_id") % len(HOSTILE) + 1).cast("int")),
                                   F.lit("[I]"), n)
    return docs.select(
        F.col("lang").alias("product"), n.alias("term"), F.lit(2).alias("recent_mentions"), F.lit(1).alias("baseline_mentions"),
        F.lit(1.0).alias("growth_rate_percent"), F.lit(1.0).alias("emergence_score"), F.lit(3).alias("supporting_records"),
        fill([t for t, _, _ in HOSTILE]).alias("answer_json"), fill([i for _, i, _ in HOSTILE]).alias("supplied_ids"))


def _intake_sql() -> str:
    def case(values):
        rows = "\n".join(f"    WHEN {i} THEN {v}" for i, v in enumerate(values))
        return f"CASE doc_id % {len(HOSTILE)}\n{rows} END"

    good = [x if isinstance(x, tuple) else None for _, _, x in HOSTILE]
    text = lambda x: "NULL" if x is None else f"replace('{x}', '[I]', CAST(doc_id AS VARCHAR))"
    return f"""SELECT lang AS product, CAST(doc_id AS VARCHAR) AS term,
  {case([text('s[I]' if g else None) for g in good])} AS cluster_summary,
  CAST({case([g[0] if g else 'NULL' for g in good])} AS DOUBLE) AS confidence,
  CAST({case([g[1] if g else 'NULL' for g in good])} AS BOOLEAN) AS requires_human_review,
  {case([text(g[2]) if g else 'NULL' for g in good])} AS evidence_complaint_ids,
  {case(["''" if g else f"'{x}'" for g, (_, _, x) in zip(good, HOSTILE)])} AS problems
FROM documents"""


@register("answer_intake", _intake_sql())
def q_answer_intake(spark, sf):
    """Answers with tails, wrong types, extra keys, nulls and odd ids: each taken or refused with reasons."""
    good, bad = A.validate_theme_answers(hostile_answers(
        spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")))
    taken = good.select("product", "term", "cluster_summary", "confidence", "requires_human_review", "evidence_complaint_ids")
    return (taken.withColumn("problems", F.lit(""))
            .unionByName(bad.select("product", "term", "problems"), allowMissingColumns=True))
