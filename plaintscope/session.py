"""SparkSession construction and lineage cutting.

On a cluster the session is created by the launcher; ``get_spark`` only fills
in settings that are unset. ``spark.checkpoint.dir`` is read from the session and
a local scratch folder is chosen only when nothing names one (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Results depend on these: set on every session.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Defaults for a session we start (tests, bench, laptops); on a session that a
# cluster launcher already configured, only the keys it left unset are filled in.
_SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that went out of scope are removed by Spark.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "plaintscope", master: str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
        for key, value in _SESSION_DEFAULTS.items():
            if spark.conf.get(key, None) is None:
                try:
                    spark.conf.set(key, value)
                except Exception:  # static settings cannot change on a running session
                    pass
    else:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        if driver_memory:
            builder = builder.config("spark.driver.memory", driver_memory)
        for key, value in _SESSION_DEFAULTS.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    apply_required(spark)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Settings results depend on (UTC for zone conversions), on any session we are
    handed - also one we did not create."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, naming a scratch one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder all executors share")
        conf_dir = tempfile.mkdtemp(prefix="plaintscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy row-local work (tokenising, regex cleaning) at least
    ``defaultParallelism`` tasks.

    With a normal input of many file splits this is a no-op. When the input is a
    few large row groups (or an unsplittable file), the rows are hash-partitioned
    on ``key`` (deterministic on retry, no local sort needed) so the expensive
    expressions do not all run in one task. ``key`` must be a (near-)unique row id
    - every caller passes the source table's own id - so no value can concentrate
    rows in one partition. Deciding needs only the planned partition count, not a job.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key)


# Largest row count we broadcast after checking it (a few MB of narrow rows).
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a measured size: ``df`` should be materialised or
    cheap (a checkpoint, a small aggregate). Above the bound the join is left to the
    planner (shuffle join, AQE may still convert it)."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
