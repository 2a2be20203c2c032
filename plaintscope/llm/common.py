"""Helpers of this subpackage: table reading, 64-bit hashing in numpy, components."""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_path, cut_lineage, ensure_checkpoint_dir

ODD = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the polynomial hashes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


ARROW_ROWS = 2_000


def prepare(spark: SparkSession) -> None:
    """Whole texts go to the workers a few megabytes at a time: smaller Arrow batches than
    Spark's default of 10,000 rows, unless the session has its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


def release_memory() -> None:
    """Give freed memory back at a task's end: a worker process goes on to other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that few texts at a time become Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.empty(n, dtype=np.uint64)
    if n:
        out[0] = 1
        if n > 1:
            out[1:] = base
            np.multiply.accumulate(out, out=out)
    return out


def connected_components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(id, component_id)`` for each id in a link; the component's smallest id.

    Minimum-label propagation with pointer jumping, each round cut by a checkpoint. The
    label update is an aggregate with map-side combine, so the centre of a star is no hot
    task; links with a null end or from an id to itself change nothing.
    """
    e = links.select(F.col(u).alias("s"), F.col(v).alias("t")).where("s <> t")
    e = cut_lineage(e.union(e.select("t", "s")).distinct())
    lab = cut_lineage(e.groupBy(F.col("s").alias("id"))
                      .agg(F.min("t").alias("m")).select("id", F.least("id", "m").alias("l")))
    while True:
        near = (e.join(lab.withColumnRenamed("id", "t"), "t")
                .groupBy(F.col("s").alias("id")).agg(F.min("l").alias("m")))
        new = lab.join(near, "id").select("id", F.col("l").alias("old"),
                                          F.least("l", "m").alias("l"))
        up = lab.select(F.col("id").alias("l"), F.col("l").alias("up"))
        new = cut_lineage(new.join(up, "l").select("id", "old", F.least("l", "up").alias("l")))
        if new.where("old <> l").limit(1).count() == 0:
            return new.select("id", F.col("l").alias("component_id"))
        lab = new.select("id", "l")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written in the shared folder: cuts lineage, and is compact."""
    out = shared_folder(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)
