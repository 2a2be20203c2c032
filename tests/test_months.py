"""Themes and evidence read the month layout through its partitions, with the results of a plain table."""

import re

from pyspark.sql import functions as F

from plaintscope import pipeline
from plaintscope.config import Thresholds
from plaintscope.operators import themes as TH
from plaintscope.schema import COMPLAINT_SCHEMA

TH3 = Thresholds(min_doc_freq=1, min_recent_mentions=1)


def _complaints(spark):
    """Eight months of narratives; the last day is 2024-08-05, so the recent week spans two months."""
    days = spark.range(0, 218).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    text = F.concat(F.lit("late fee "), F.element_at(F.array(*map(F.lit, ("charged", "refused", "again"))), (F.col("id") % 3 + 1).cast("int")))
    values = {"complaint_id": "id", "date_received": F.col("d").cast("timestamp_ntz"), "product": F.lit("p"),
              "issue": F.lit("i"), "company": F.lit("c"), "consumer_complaint_narrative": text}
    cols = [(F.col(v) if isinstance(v, str) else v) if (v := values.get(f.name)) is not None else F.lit(None) for f in COMPLAINT_SCHEMA]
    return days.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, COMPLAINT_SCHEMA)])


def _partitions_read(df) -> list[int]:
    """Partitions the scans of a run plan have read."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(int(node.metrics().apply("numPartitions").value()))
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(text)
    return found


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_evidence_reads_the_months_of_the_selected_windows(spark, tmp_path):
    plain = _complaints(spark)
    path = str(tmp_path / "layout")
    pipeline.write_complaint_layout(plain, path)
    by_month = pipeline.read_complaint_layout(spark, path)
    assert by_month.select(TH.MONTH).distinct().count() == 8
    themes = TH.emerging_themes(plain, TH3)
    assert _rows(TH.emerging_themes(by_month, TH3)) == _rows(themes)
    selected = TH.top_themes(themes)
    evidence = TH.theme_evidence(by_month, selected, TH3)
    want = TH.theme_evidence(plain, selected, TH3)
    assert _rows(evidence) == _rows(want) and want.count() > 3
    assert "dynamicpruning" in evidence._jdf.queryExecution().executedPlan().toString().lower()
    bounds = selected.agg(F.min("recent_start"), F.max("recent_end")).first()
    months = {f"{d:%Y-%m}" for d in bounds}
    assert _partitions_read(evidence) == [len(months)]


def test_windows_far_apart_leave_out_the_months_between(spark, tmp_path):
    plain = _complaints(spark)
    path = str(tmp_path / "layout")
    pipeline.write_complaint_layout(plain, path)
    by_month = pipeline.read_complaint_layout(spark, path)
    selected = spark.sql("""SELECT 'p' AS product, 'late fee' AS term, date'2024-01-28' AS recent_start, date'2024-02-03' AS recent_end
                            UNION ALL SELECT 'p', 'fee charged', date'2024-08-01', date'2024-08-05'""")
    evidence = TH.theme_evidence(by_month, selected, TH3)
    assert _rows(evidence) == _rows(TH.theme_evidence(plain, selected, TH3)) and evidence.count() > 3
    assert _partitions_read(evidence) == [3]


def test_theme_window_prunes_months_by_literals(spark, tmp_path):
    path = str(tmp_path / "layout")
    pipeline.write_complaint_layout(_complaints(spark), path)
    labelled = TH.labelled_narratives(pipeline.read_complaint_layout(spark, path), TH3, ws=TH.window_bounds("2024-08-05", TH3))
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*received_month", plan)
    assert _partitions_read(labelled)[0] <= 3
