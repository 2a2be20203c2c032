"""End-to-end batch run: raw CSV extracts in, tables and a brief out.

    python -m plaintscope.pipeline --raw 'extracts/*.csv' --out /shared/complaints-run

Steps: scan (A1) -> clean + dedup (B1-B5, F1) -> bucketed upsert (A8) -> month layout with
the null checks observed while it is written (E9, E17) -> signals and alerts (E1, E2, F2-F9)
-> themes, evidence and prompts -> executive brief (R1). Every output is written by Spark to
``--out``. ``followup`` has the steps on these outputs: answers to the prompts, their evaluation, the
issue classifier.

With ``--batch-id`` the themes come from daily counts kept beside the table (``operators.sliding``):
only the batch's narratives, and the stored rows they replace, are tokenised. A batch that failed is
run again under its id before the next one; its steps that were committed are recognised. Without an
id the themes are counted anew from the window's narratives, whose last day the manifest knows.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .config import DEFAULTS, Thresholds
from .operators import brief as B
from .operators import clean as C
from .operators import quality as Q
from .operators import signals as S
from .operators import sliding as SL
from .operators import themes as TH
from .schema import COMPLAINT_SCHEMA
from .session import cut_lineage
from .sources.buckets import manifest, maximum, publish_upsert, read_table, rows_of_keys
from .sources.complaints import ORDER, normalize_nulls, read_complaints
from .sources.sinks import write_table


def write_complaint_layout(df: DataFrame, path: str) -> dict:
    """Storage layout of the clean table: month partitions, rows sorted by received
    time inside each file (min/max statistics then prune date ranges). Range
    partitioning gives each task a contiguous time slice, so a busy month is spread
    over many tasks instead of one, and each task writes few files.

    Returns the values of ``quality.null_checks``. They are observed behind the exchange: before it,
    the pass that samples the ranges would count its rows too."""
    seen = Observation()
    (df.withColumn(TH.MONTH, TH.month_of("date_received"))
     .repartitionByRange("date_received", "complaint_id")
     .observe(seen, *Q.null_checks())
     .sortWithinPartitions(TH.MONTH, "date_received", "complaint_id")
     .write.mode("overwrite").partitionBy(TH.MONTH).parquet(path))
    return seen.get


def read_complaint_layout(spark: SparkSession, path: str) -> DataFrame:
    """The month layout with its month as text (the reader would guess a date) and no schema job."""
    return spark.read.schema(StructType([*COMPLAINT_SCHEMA.fields, StructField(TH.MONTH, StringType())])).parquet(path)


def batch_themes(spark: SparkSession, out: str, batch: DataFrame, batch_id: str) -> None:
    """Bring the daily counts to the state after ``batch`` is published. Called before the publish:
    the rows it replaces are still the stored ones. Counts started on a table that exists take it in
    as their first load."""
    table, daily = f"{out}/complaints", f"{out}/theme_days"
    if manifest(spark, daily) is None and manifest(spark, table) is not None:
        SL.load_days(spark, daily, read_table(spark, table), "stored")
    held = manifest(spark, daily)
    if held and batch_id in held["folders"]:
        return
    keys = cut_lineage(batch.select(F.col("complaint_id").alias("_key")).distinct())
    SL.load_days(spark, daily, batch, batch_id, replaced=rows_of_keys(spark, table, keys))


def run(spark: SparkSession, raw_path: str, out: str, th: Thresholds = DEFAULTS,
        batch_id: str | None = None) -> str:
    raw = normalize_nulls(read_complaints(spark, raw_path, keep_order=True))
    cleaned = C.conform(C.clean_complaints(raw, list(ORDER), sort=False)).drop("ingested_at")
    if batch_id is not None:
        cleaned = cut_lineage(cleaned)  # read by the counts and by the upsert
        batch_themes(spark, out, cleaned, batch_id)
    publish_upsert(spark, f"{out}/complaints", cleaned.withColumn("_seq", F.lit(0)), seq="_seq", batch_id=batch_id,
                   maxima={TH.NARRATIVE_DAY: TH.narrative_day()})
    complaints = read_table(spark, f"{out}/complaints")
    observed = write_complaint_layout(complaints, f"{out}/complaints_by_month")
    by_month = read_complaint_layout(spark, f"{out}/complaints_by_month")
    write_table(Q.quality_report(complaints, observed), f"{out}/quality_report", fmt="csv")
    write_table(Q.narrative_coverage(complaints, observed), f"{out}/narrative_coverage", fmt="csv")
    alerts = S.risk_alerts(complaints, th)
    write_table(S.alerts_ordered(alerts), f"{out}/risk_alerts", fmt="csv")
    status = S.latest_product_status(S.product_risk_signals(complaints, th), th)
    write_table(status, f"{out}/product_status", fmt="csv")
    anchor = maximum(spark, f"{out}/complaints", TH.NARRATIVE_DAY, TH.narrative_day())
    if batch_id is not None and anchor is not None:
        SL.advance(spark, f"{out}/theme_days", f"{out}/theme_window", anchor, th)
        themes = SL.sliding_themes(spark, f"{out}/theme_window", th)
    else:
        themes = TH.emerging_themes(by_month, th, anchor=anchor)
    write_table(themes, f"{out}/emerging_themes", fmt="csv")
    selected = TH.top_themes(themes, th.themes_per_product)
    write_table(selected, f"{out}/selected_themes")
    selected = spark.read.parquet(f"{out}/selected_themes")
    evidence = TH.theme_evidence(by_month, selected, th)
    write_table(TH.theme_prompts(selected, evidence), f"{out}/theme_prompts")
    write_table(TH.first_narrative_prompt(complaints, th), f"{out}/complaint_prompt")
    B.write_brief(B.brief_lines(alerts, status, themes), f"{out}/brief")
    return out


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", required=True, help="CSV extract path or glob")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--batch-id", help="name of this batch; themes then come from stored daily counts")
    args = ap.parse_args()
    from .session import get_spark
    run(get_spark("plaintscope-pipeline"), args.raw, args.out, batch_id=args.batch_id)


if __name__ == "__main__":
    main()
