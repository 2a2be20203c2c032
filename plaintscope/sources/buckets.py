"""Keyed tables whose upserts rewrite only what they touch, and idempotent appends.

A table is a folder of Parquet data and small manifests. Rows lie in hash buckets of their key;
a manifest names, per bucket, the folder that holds it. An upsert finds the buckets its keys fall
into, reads and rewrites those alone, and commits a manifest in which only they point to new
folders. Readers open the newest manifest, so they see the old or the new table, never a mixture;
a write that fails leaves folders no manifest names. A manifest also carries the ids of the batches
it holds, so a retried batch is recognised and changes nothing. Manifests beyond the last ``keep``
and folders that only they name are removed after a commit.

Sizes: the manifest grows with the number of buckets (fixed when the table is made) and, for
appended results, of batches; rows never pass through the driver. Choose the buckets so that one
is some hundred megabytes to a gigabyte; ``splits`` writes each by several tasks. One writer at a
time per table: a second one that commits the same version fails where the file system refuses
to rename onto an existing file, and is detected by a check elsewhere.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.clean import dedup_keep_last, upsert
from ..session import bounded_broadcast, cut_lineage

N_BUCKETS = 64
KEEP = 2
BATCH_IDS = 1_000  # ids of the latest upserts a manifest remembers
_BUCKET = "_bucket"
_BATCH_NO = "_batch_no"


class _Folder:
    """The table's files through Spark's Hadoop file system (local, HDFS, object stores)."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.jvm = root.rstrip("/"), spark.sparkContext._jvm
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        at = self.path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """A file that appears whole or not at all, and only once."""
        draft = self.path(f"_manifests/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(draft, self.path(name)):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{self.root}: another writer committed {name}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The newest committed state of the table, None before the first one."""
    folder = _Folder(spark, root)
    done = [n for n in folder.names("_manifests") if n.endswith(".json") and not n.startswith(".")]
    return json.loads(folder.read(f"_manifests/{done[-1]}")) if done else None


def _commit(spark: SparkSession, root: str, state: dict, keep: int = KEEP) -> dict:
    folder = _Folder(spark, root)
    folder.write_new(f"_manifests/{state['version']:012d}.json", json.dumps(state))
    done = [n for n in folder.names("_manifests") if n.endswith(".json") and not n.startswith(".")]
    for name in done[:-keep]:
        folder.remove(f"_manifests/{name}")
    named = {f for n in done[-keep:] for f in json.loads(folder.read(f"_manifests/{n}"))["folders"].values()}
    for write in folder.names("data"):
        held = {f.rsplit("/", 1)[-1] for f in named if f.startswith(f"data/{write}/")}
        if f"data/{write}" in named:
            continue
        if not held:
            folder.remove(f"data/{write}")
            continue
        for part in folder.names(f"data/{write}"):
            if part.startswith(f"{_BUCKET}=") and part not in held:
                folder.remove(f"data/{write}/{part}")
    return state


def _read(spark: SparkSession, root: str, state: dict, folders: list[str]) -> DataFrame:
    schema = StructType.fromJson(state["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The table as of its newest manifest."""
    state = manifest(spark, root)
    if state is None:
        raise FileNotFoundError(f"{root}: no table has been published")
    return _read(spark, root, state, sorted(state["folders"].values()))


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def publish_upsert(spark: SparkSession, root: str, incoming: DataFrame, key: str = "complaint_id",
                   seq: str | None = None, batch_id: str | None = None, n_buckets: int = N_BUCKETS,
                   splits: int = 1, keep: int = KEEP, maxima: dict[str, Column] | None = None) -> int:
    """Merge ``incoming`` into the table (``clean.upsert``) and return the version that holds it.

    Only buckets that hold a key of the batch are read and written. ``n_buckets`` counts for the
    first batch of a table only. A ``batch_id`` the table already holds changes nothing, nor does a
    batch without rows on an existing table. The batch's columns must be the table's.

    ``maxima`` names date expressions over the table's columns; the manifest keeps their maximum per
    bucket, taken from the buckets this batch rewrote (``maximum`` reads them)."""
    state = manifest(spark, root)
    if state and batch_id is not None and batch_id in state["batches"]:
        return state["version"]
    if state is None:
        keys = incoming.limit(0).select(F.col(key).alias("_key"))  # nothing to keep apart
        existing = incoming.limit(0).select(*[c for c in incoming.columns if c != seq],
                                            F.lit(None).cast("timestamp_ntz").alias("ingested_at"))
        state = {"version": 0, "key": key, "n_buckets": n_buckets, "folders": {}, "batches": []}
    else:
        if state["key"] != key:
            raise ValueError(f"{root}: the table's key is {state['key']}")
        keys = cut_lineage(incoming.select(F.col(key).alias("_key")).distinct())
        touched = _touched(keys, state)
        if not touched:
            return state["version"]
        existing = _read(spark, root, state, [state["folders"][b] for b in touched if b in state["folders"]])
    merged = upsert(existing, incoming, key=key, seq=seq, keys=keys)
    write = f"data/w{state['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = merged.withColumn(_BUCKET, bucket_of(key, state["n_buckets"]))
    by = [_BUCKET] if splits == 1 else [_BUCKET, F.pmod(F.xxhash64(F.lit(1), key), F.lit(splits))]
    (rows.repartition(*by).write.mode("errorifexists").partitionBy(_BUCKET).parquet(f"{root.rstrip('/')}/{write}"))
    folders, written = dict(state["folders"]), {}
    for name in _Folder(spark, root).names(write):
        if name.startswith(f"{_BUCKET}="):
            written[name.split("=", 1)[1]] = f"{write}/{name}"
    folders |= written
    # What an earlier batch noted stays for the buckets this one did not write.
    known = {m: {b: v for b, v in per.items() if b not in written} for m, per in state.get("maxima", {}).items()}
    if maxima and written:
        rewritten = spark.read.schema(StructType([*merged.schema.fields, StructField(_BUCKET, IntegerType())])) \
            .parquet(f"{root.rstrip('/')}/{write}")
        for r in (rewritten.groupBy(_BUCKET)
                  .agg(*[F.max(c).cast("date").cast("string").alias(m) for m, c in maxima.items()]).collect()):
            for m in maxima:
                known.setdefault(m, {})[str(r[_BUCKET])] = r[m]
    batches = (state["batches"] + ([batch_id] if batch_id is not None else []))[-BATCH_IDS:]
    return _commit(spark, root, state | {"version": state["version"] + 1, "folders": folders, "batches": batches, "maxima": known,
                                         "schema": json.loads(merged.schema.json())}, keep)["version"]


def _touched(keys: DataFrame, state: dict) -> list[str]:
    return sorted(str(r[0]) for r in keys.select(bucket_of("_key", state["n_buckets"])).distinct().collect())


def rows_of_keys(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame | None:
    """The stored rows whose key is among ``keys(_key)``, from the buckets these fall into; None
    before the first version."""
    state = manifest(spark, root)
    if state is None:
        return None
    rows = _read(spark, root, state, [state["folders"][b] for b in _touched(keys, state) if b in state["folders"]])
    wanted = bounded_broadcast(keys)
    return rows.join(wanted, rows[state["key"]].eqNullSafe(wanted["_key"]), "left_semi")


def maximum(spark: SparkSession, root: str, name: str, expression: Column) -> dt.date | None:
    """The maximum of a date expression over the table, from the manifest if every bucket has it there,
    else from the rows (a table some batch of which was published without ``maxima``)."""
    state = manifest(spark, root)
    if state is None:
        return None
    per = state.get("maxima", {}).get(name, {})
    if not set(state["folders"]) <= set(per):
        return read_table(spark, root).agg(F.max(expression).cast("date")).first()[0]
    last = max((v for v in per.values() if v is not None), default=None)
    return dt.date.fromisoformat(last) if last else None


def append_results(df: DataFrame, root: str, batch_id: str | None = None, keep: int = KEEP, info=None) -> int:
    """Append a batch of results under its id; a retry of a held id changes nothing. Without
    an id the batch counts as a new one. ``info`` (``rows -> dict``) is called with the written rows;
    what it returns is kept in the manifest for the batch, so a reader can choose batches by it."""
    spark = df.sparkSession
    state = manifest(spark, root) or {"version": 0, "folders": {}, "n_batches": 0}
    batch_id = batch_id if batch_id is not None else uuid.uuid4().hex
    if batch_id in state["folders"]:
        return state["version"]
    number = state["n_batches"] + 1
    write = f"data/w{state['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
    df = df.withColumn(_BATCH_NO, F.lit(number).cast("long"))
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{write}")
    state = state | {"schema": json.loads(df.schema.json())}
    notes = state.get("info", {})
    if info is not None:
        notes = notes | {batch_id: info(_read(spark, root, state, [write]))}
    return _commit(spark, root, state | {
        "version": state["version"] + 1, "folders": state["folders"] | {batch_id: write}, "n_batches": number,
        "info": notes}, keep)["version"]


def read_batches(spark: SparkSession, root: str, state: dict, batch_ids: list[str]) -> DataFrame:
    """The rows of some appended batches, as one scan of their folders."""
    return _read(spark, root, state, [state["folders"][b] for b in batch_ids]).drop(_BATCH_NO)


def publish_layer(df: DataFrame, root: str, info: dict, whole: bool, keep: int = KEEP) -> int:
    """Write ``df`` as the whole table or as one more layer of its rows, with ``info`` in the manifest.
    ``df`` may read the table's last version: its folders stay until the next commit."""
    spark = df.sparkSession
    state = manifest(spark, root) or {"version": 0, "folders": {}}
    version = state["version"] + 1
    write = f"data/w{version:012d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{write}")
    folders = {} if whole else state["folders"]
    return _commit(spark, root, {"version": version, "folders": folders | {str(version): write}, "info": info,
                                 "schema": json.loads(df.schema.json())}, keep)["version"]


def drop_table(spark: SparkSession, root: str) -> None:
    """Remove a table and its versions."""
    _Folder(spark, root).remove("")


def read_results(spark: SparkSession, root: str, key: list[str]) -> DataFrame:
    """A11 read side: one row per key, that of the batch appended last."""
    df = read_table(spark, root).withColumn("_k", F.to_json(F.struct(*key)))
    return dedup_keep_last(df, "_k", [_BATCH_NO]).drop("_k", _BATCH_NO)
