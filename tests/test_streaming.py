"""Streaming daily counts and micro-batch upsert agree with the batch jobs."""

from pyspark.sql import functions as F

from data_dirs import SF001
from plaintscope.operators import signals as S
from plaintscope.plans.cleaning import ORDER, clean_table
from plaintscope.sources.adapters import event_complaints, raw_extract
from plaintscope.sources.complaints import normalize_nulls
from plaintscope.sources.buckets import read_table
from plaintscope.streaming.daily import start_complaint_upsert, start_daily_counts


def test_stream_daily_counts_match_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    batch = event_complaints(spark, SF001)
    batch.write.parquet(src)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_daily_counts(stream, str(tmp_path / "daily"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = read_table(spark, str(tmp_path / "daily"))
    want = S.daily_product_metrics(batch)
    cols = ["complaint_date", "product", "complaint_count"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0


def test_stream_upsert_matches_batch_clean(spark, tmp_path):
    src = str(tmp_path / "raw")
    raw = normalize_nulls(raw_extract(spark, SF001))
    raw.write.parquet(src)
    stream = spark.readStream.schema(raw.schema).parquet(src)
    q = start_complaint_upsert(stream, ORDER, str(tmp_path / "table"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = read_table(spark, str(tmp_path / "table")).drop("ingested_at")
    want = clean_table(spark, SF001)
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).count() == 0
    assert got.where(F.col("complaint_id").isNull()).count() == 0
