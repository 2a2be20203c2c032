"""Structured Streaming forms of the daily count (E1) and the keyed upsert.

The reference is batch-only; these run the same logic on an unbounded source.
Daily counts use an event-time window with a watermark so late complaints are
still counted until the watermark passes their day and state stays bounded.
Results leave each micro-batch through ``foreachBatch`` into a bucketed table
(``buckets.publish_upsert``): only the buckets of its keys are rewritten, and a replayed
micro-batch is recognised by its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_complaints
from ..sources.buckets import publish_upsert


def daily_counts(stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """E1 on a stream: complaints per event-time day and product."""
    ts = F.col("date_received").cast("timestamp")
    return (stream.withColumn("_ts", ts)
            .withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", "1 day").alias("w"), "product")
            .agg(F.count(F.lit(1)).alias("complaint_count"))
            .select(F.col("w.start").cast("date").alias("complaint_date"), "product",
                    "complaint_count"))


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_daily_counts(stream: DataFrame, table_root: str, checkpoint: str,
                       watermark: str = "2 days", available_now: bool = True,
                       interval: str = "1 minute") -> StreamingQuery:
    """Update mode: each micro-batch carries the (day, product) counts it changed;
    they are merged into the bucketed table, so it always holds the latest count."""
    counts = daily_counts(stream, watermark)

    def write(batch: DataFrame, epoch_id: int) -> None:
        keyed = batch.select(F.concat_ws("|", F.col("complaint_date").cast("string"), "product")
                             .alias("metric_key"), "complaint_date", "product", "complaint_count",
                             F.lit(epoch_id).alias("_seq"))
        publish_upsert(batch.sparkSession, table_root, keyed, key="metric_key", seq="_seq",
                       batch_id=f"{checkpoint}#{epoch_id}")

    w = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, interval).start()


def start_complaint_upsert(raw_stream: DataFrame, order: list[str], table_root: str,
                           checkpoint: str, available_now: bool = True,
                           interval: str = "1 minute") -> StreamingQuery:
    """A8 around foreachBatch: clean each raw micro-batch (B1-B5, F1) and upsert it
    into the bucketed complaint table; later batches win per complaint id."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        cleaned = clean_complaints(batch, order, sort=False).withColumn("_seq", F.lit(epoch_id))
        publish_upsert(batch.sparkSession, table_root, cleaned, key="complaint_id", seq="_seq",
                       batch_id=f"{checkpoint}#{epoch_id}")

    w = raw_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()
