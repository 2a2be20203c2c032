"""The corpus pipeline: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plaintscope.llm.common import prepare, shared_folder, table
from plaintscope.llm.line_rules import keep_good
from plaintscope.llm.ngram_join import first_of_groups
from plaintscope.llm.packing import pack_pieces
from plaintscope.llm.queries import workers_can_import
from plaintscope.llm.suffix_family import remove_repeats
from plaintscope.llm.toxicity import keep_clean
from plaintscope.session import apply_required


# Worker processes go on from stage to stage, so packing keeps a small table of word ids.
PACKING_WORDS = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and keep enough lines."""
    prepare(spark)
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    prepare(spark)
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group of near duplicates."""
    prepare(spark)
    return first_of_groups(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier too."""
    prepare(spark)
    return remove_repeats(docs, with_text=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids: one row per piece of a document."""
    prepare(spark)
    return pack_pieces(docs, max_words=PACKING_WORDS).drop("k")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicate),
    ("suffix-array dedup", repeated_passages),
    ("packing", packing),
]

# Word windows, tree scores and byte-pair ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    apply_required(spark)
    workers_can_import(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
