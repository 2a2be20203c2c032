"""Term counts are dealt by their key before they are added up; evidence reads few texts in full."""

import datetime as dt

from pyspark.sql import functions as F

from plaintscope.operators import sliding as SL
from plaintscope.operators import themes as TH

ROWS = "complaint_id long, date_received timestamp_ntz, product string, issue string, consumer_complaint_narrative string"


def narratives(spark):
    day = dt.datetime(2024, 3, 1)
    texts = ["late fee late fee", "fee late", "LATE the fee", "", "latefee", None, "card İlate fee"]
    return spark.createDataFrame([(i, day, None if i == 1 else "a", "x", t) for i, t in enumerate(texts)], ROWS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_dealt_before_the_first_aggregate(spark):
    rows = narratives(spark)
    counts = TH.term_document_counts(rows.withColumn("period", F.lit("recent")), with_doc_marker=True)
    daily = SL.daily_term_counts(rows)
    assert "REPARTITION_BY_COL" in plan(counts) and "REPARTITION_BY_COL" in plan(daily)
    got = {(r.product, r.term): (r.doc_freq, r.recent_mentions, r.baseline_mentions) for r in counts.collect()}
    assert got[("a", "late fee")] == (3, 3, 0) and got[("a", "")] == (5, 5, 0) and got[(None, "")] == (1, 1, 0)
    assert got[(None, "fee late")] == (1, 1, 0)
    per_day = {(r.product, r.term): r.mentions for r in daily.collect()}
    assert per_day == {k: v[0] for k, v in got.items()}


def test_only_texts_with_both_words_are_tokenised_for_evidence(spark):
    day = dt.date(2024, 3, 1)
    selected = spark.createDataFrame([("a", "Late Fee", day, day), ("a", "one", day, day)],
                                     "product string, term string, recent_start date, recent_end date")
    evidence = TH.theme_evidence(narratives(spark), selected)
    assert "Contains(" in plan(evidence) or "contains(" in plan(evidence).lower()
    assert [r.complaint_id for r in evidence.orderBy("evidence_rank").collect()] == [0, 2, 6]
