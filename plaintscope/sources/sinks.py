"""Sinks: plain table writes and model files (A6, A12). Upserts and appended results
are in ``buckets``. All writes go to folders the caller names (on a cluster: shared storage)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Overwrite a table folder (CSV with a header row)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = (w.option("header", True).option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_classifier(model, vocab: DataFrame, classes: list[str], path: str) -> None:
    """Model coefficients (Spark ML format), vocabulary and class order."""
    model.write().overwrite().save(os.path.join(path, "model"))
    vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))
    vocab.sparkSession.createDataFrame([(i, c) for i, c in enumerate(classes)],
                                       "label int, issue string") \
        .write.mode("overwrite").parquet(os.path.join(path, "classes"))


def load_classifier(spark: SparkSession, path: str):
    from pyspark.ml.classification import LogisticRegressionModel
    model = LogisticRegressionModel.load(os.path.join(path, "model"))
    vocab = spark.read.parquet(os.path.join(path, "vocab"))
    classes = [r.issue for r in spark.read.parquet(os.path.join(path, "classes")).orderBy("label").collect()]
    return model, vocab, classes
