"""Structured answers: parse, validate, keep grounded evidence ids, evaluate, roll up
(S14-S19, D5, B14-B16, E15, E16).

Answers arrive as JSON text in a column (one per theme). Everything here is a
row-local expression or a one-row aggregate; ids are checked against the ids
supplied with the prompt by array membership inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, URGENCY_LEVELS, Thresholds
from ..schema import COMPLAINT_ANSWER_SCHEMA, THEME_ANSWER_SCHEMA
from ..session import cut_lineage


# Texts taken for a truth value (any case), and the shapes of number texts.
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0")
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
_NUMBERS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def whole_json(text: Column) -> Column:
    """The VARIANT of a text that is one JSON value and nothing else, NULL otherwise (and where an
    object repeats a key). The parser stops after a value, whatever follows, so the text must also
    close a list and an object around it: only one whole value does both."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    one = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(one, F.try_variant_get(keyed, "$.v", "variant"))


def _text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _whole_number(v: Column) -> Column:
    """A whole number: a number without a fraction, its text, or a truth value; else NULL."""
    kind, text = F.schema_of_variant(v), _text_of(v)
    number = F.when(kind.rlike(_NUMBERS) | ((kind == "STRING") & text.rlike(WHOLE_TEXT)),
                    F.trim(text).try_cast("decimal(38,6)"))
    return (F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
            .when(number == F.floor(number), F.floor(number).try_cast("bigint")))


def _typed(v: Column, kind: str) -> Column:
    """A field's value as its type, by the reference model's lax rules: text only from text, numbers
    also from number text and truth values, truth values also from 0, 1 and the listed texts; NULL
    if it is none."""
    own, text = F.schema_of_variant(v), _text_of(v)
    if kind == "string":
        return F.when(own == "STRING", text)
    if kind == "double":
        return (F.when(own == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
                .when(own.rlike(_NUMBERS) | ((own == "STRING") & text.rlike(NUMBER_TEXT)), F.trim(text).try_cast("double")))
    if kind == "boolean":
        number = F.when(own.rlike(_NUMBERS), text.try_cast("double"))
        low = F.when(own == "STRING", F.lower(text))
        return (F.when(own == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
                .when((number == 1) | low.isin(*TRUE_TEXTS), True).when((number == 0) | low.isin(*FALSE_TEXTS), False))
    if kind == "array<bigint>":
        return F.transform(F.try_variant_get(v, "$", "array<variant>"), _whole_number)
    raise ValueError(f"no rule for answers of type {kind}")


def parse_answer(json_text, schema=THEME_ANSWER_SCHEMA) -> Column:
    """JSON text -> struct of the schema's fields, each NULL if it is missing or of a wrong type,
    and ``wrong``, the names of those of a wrong type (a list with a wrong item is one). The whole
    text must be one JSON object; else all is NULL. Keys beyond the schema are ignored."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text

    def read(v: Column) -> Column:
        fields, wrong = [], []
        for f in schema.fields:
            kind = f.dataType.simpleString()
            raw = F.try_variant_get(v, f"$.{f.name}", "variant")
            there = raw.isNotNull() & ~F.is_variant_null(raw)
            value = _typed(raw, kind)
            fields.append(value.alias(f.name))
            bad = value.isNull()
            if kind.startswith("array"):
                items = F.try_variant_get(raw, "$", "array<variant>")
                bad = bad | F.coalesce(F.exists(items, lambda x: ~F.is_variant_null(x) & _whole_number(x).isNull()), F.lit(False))
            wrong.append(F.when(there & bad, F.lit(f.name)))
        return F.struct(*fields, F.filter(F.array(*wrong), lambda x: x.isNotNull()).alias("wrong"))

    return _let(whole_json(c), read)


def answer_problems(answer: Column, schema=THEME_ANSWER_SCHEMA) -> Column:
    """List of problems: missing fields, fields of a wrong type, nulls in lists, urgency outside
    the enum, confidence outside 0..1."""
    wrong = F.coalesce(answer.getField("wrong"), F.array().cast("array<string>"))
    checks = [F.when(F.array_contains(wrong, f.name), F.lit(f"bad type of {f.name}"))
              .when(answer.getField(f.name).isNull(), F.lit(f"missing {f.name}")) for f in schema.fields]
    checks += [F.when(~F.array_contains(wrong, f.name) & F.exists(answer.getField(f.name), lambda x: x.isNull()),
                      F.lit(f"null in {f.name}")) for f in schema.fields if f.dataType.typeName() == "array"]
    checks.append(F.when(~answer.getField("urgency").isin(*URGENCY_LEVELS), F.lit("bad urgency")))
    checks.append(F.when(~answer.getField("confidence").between(0.0, 1.0), F.lit("bad confidence")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def grounded_ids(answer_ids: Column, allowed_ids: Column) -> Column:
    """Answer ids that were supplied, order and repeats kept."""
    return F.filter(answer_ids, lambda x: F.array_contains(allowed_ids, x))


def validate_theme_answers(df: DataFrame, json_col: str = "answer_json",
                           allowed_col: str = "supplied_ids",
                           model_name: str = "synthetic") -> tuple[DataFrame, DataFrame]:
    """S16-S18 + S15: split into (summaries, quarantine).

    ``df`` carries the theme columns, ``supporting_records``, the supplied ids as
    ``a;b;c`` text and the answer JSON. A bad answer goes to quarantine with its
    problems; a good one keeps only supplied ids and is forced to human review
    when none remains.
    """
    # Blank and non-numeric entries supply nothing; a theme without supplied ids goes to review.
    supplied = F.split(F.coalesce(F.col(allowed_col).cast("string"), F.lit("")), ";")
    allowed = F.filter(F.transform(supplied, lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())
    parsed = (df.withColumn("_a", parse_answer(json_col))
              .withColumn("_problems", answer_problems(F.col("_a"))))
    # Both results read the judged answers; a filter on them would parse each text again.
    parsed = cut_lineage(parsed.drop(json_col))
    good = parsed.where(F.size("_problems") == 0)
    a = F.col("_a")
    ids = grounded_ids(a.getField("evidence_complaint_ids"), allowed)
    summaries = good.select(
        "product", "term", "recent_mentions", "baseline_mentions", "growth_rate_percent",
        "emergence_score", "supporting_records",
        a.getField("cluster_summary").alias("cluster_summary"),
        a.getField("customer_need").alias("customer_need"),
        a.getField("risk_implication").alias("risk_implication"),
        a.getField("urgency").alias("urgency"),
        a.getField("recommended_action").alias("recommended_action"),
        a.getField("confidence").alias("confidence"),
        (a.getField("requires_human_review") | (F.size(ids) == 0)).alias("requires_human_review"),
        F.array_join(F.transform(ids, lambda x: x.cast("string")), ";")
        .alias("evidence_complaint_ids"),
        F.lit(model_name).alias("model_name"))
    quarantine = parsed.where(F.size("_problems") > 0).select(
        "product", "term", F.array_join("_problems", "; ").alias("problems"))
    return summaries, quarantine


def validate_complaint_answer(df: DataFrame, json_col: str = "answer_json") -> DataFrame:
    """S16/S17 for a single-complaint answer: adds the parsed fields and a problem list.
    Callers treat any problem as fatal (the reference stops on it)."""
    a = parse_answer(json_col, COMPLAINT_ANSWER_SCHEMA)
    return (df.withColumn("_a", a)
            .withColumn("problems", F.array_join(answer_problems(F.col("_a"), COMPLAINT_ANSWER_SCHEMA), "; "))
            .select("*", "_a.*").drop("_a", "wrong"))


class BadAnswer(ValueError):
    """A single-complaint answer that must not be stored."""


def sound_or_raise(judged: DataFrame) -> DataFrame:
    """The answers of ``validate_complaint_answer`` without their empty problem column; raises
    ``BadAnswer`` if one has problems. One row of counts and the first bad answer reach the driver."""
    judged = cut_lineage(judged)
    bad = F.col("problems") != ""
    seen = judged.agg(F.count_if(bad).alias("n"),
                      F.min_by(F.struct("complaint_id", "problems"), F.when(bad, F.col("complaint_id"))).alias("first")).first()
    if seen["n"]:
        first = seen["first"]
        where = f"complaint {first['complaint_id']}: {first['problems']}" if first else "an answer without a complaint id"
        raise BadAnswer(f"{seen['n']} bad answer(s), first {where}")
    return judged.drop("problems")


def evidence_id_count(ids_text) -> Column:
    """S14: ';'-separated ids, blanks dropped; NULL -> 0."""
    c = F.col(ids_text) if isinstance(ids_text, str) else ids_text
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x) != ""))


# Columns a human reviewer fills in (empty on creation).
MANUAL_COLUMNS = ("manual_grounded", "manual_cluster_coherent", "manual_actionable",
                  "unsupported_claims", "urgency_appropriate", "reviewer_notes")


def answer_evaluation(summaries: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """B14-B16 + S19: automatic checks per answer plus empty manual-review columns."""
    n = evidence_id_count("evidence_complaint_ids")
    return summaries.select(
        "product", "term", "supporting_records", "cluster_summary", "risk_implication",
        "urgency", "recommended_action", "confidence", "requires_human_review",
        "evidence_complaint_ids", "model_name",
        n.alias("evidence_id_count"),
        ((n > 0) & (n <= F.col("supporting_records"))).alias("evidence_ids_valid"),
        (F.col("supporting_records") >= th.min_supporting_records).alias("minimum_evidence_met"),
        F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False)).alias("confidence_valid"),
        *[F.lit("").alias(c) for c in MANUAL_COLUMNS])


def answer_evaluation_summary(evaluation: DataFrame) -> DataFrame:
    """Outputs evaluated and passes per automatic check."""
    return evaluation.agg(
        F.count(F.lit(1)).alias("outputs_evaluated"),
        F.count_if("evidence_ids_valid").alias("valid_evidence_ids"),
        F.count_if("minimum_evidence_met").alias("minimum_evidence_met"),
        F.count_if("confidence_valid").alias("valid_confidence"))


# Review measures and the marks that count as a pass.
REVIEW_MEASURES = ("evidence_ids_valid", "minimum_evidence_met", "confidence_valid",
                   "manual_grounded", "manual_cluster_coherent", "manual_actionable",
                   "unsupported_claims", "urgency_appropriate")
PASS_MARKS = ("true", "yes", "y", "1")


def review_rollup(reviewed: DataFrame, measures=REVIEW_MEASURES) -> DataFrame:
    """Per measure, 'n of N' over rows that carry a mark (blank marks are not counted)."""
    present = [m for m in measures if m in reviewed.columns]
    pairs = F.array(*[F.struct(F.lit(i).alias("measure_order"), F.lit(m).alias("measure"),
                               F.lower(F.trim(F.col(m).cast("string"))).alias("mark"))
                      for i, m in enumerate(present, start=1)])
    marks = reviewed.select(F.inline(pairs)).where(F.col("mark").isNotNull() & (F.col("mark") != ""))
    return (marks.groupBy("measure_order", "measure")
            .agg(F.count_if(F.col("mark").isin(*PASS_MARKS)).alias("passed"),
                 F.count(F.lit(1)).alias("reviewed"))
            .withColumn("result", F.concat(F.col("passed").cast("string"), F.lit("/"),
                                           F.col("reviewed").cast("string"))))
