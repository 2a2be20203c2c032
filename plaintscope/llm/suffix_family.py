"""Exact removal of repeated 100-byte strings by a logarithmic family of suffix arrays.

Suffixes are sampled by content: of the ``GRAM``-byte grams that start in a 100-byte
string, the one of the smallest hash (leftmost on ties) is the string's anchor, so equal
strings have their anchor at the same place and only suffixes at anchors are indexed, about
one in 35. All window starts that share an anchor form a run; its entry is (hash of the gram
that opens the suffix, hash of the run's whole span, document, place).

* Index: documents come in batches by ascending id. The entries of a batch go to shards by
  gram hash; each shard sorts them into the batch's suffix array, merge-scans it against the
  shard's existing levels, and writes it, merged with the levels of equal size (a binary
  counter, so n batches leave at most log2(n) + 1 levels), as a sorted Arrow file in the
  shared folder. Files are named per task attempt; the driver keeps one name per shard and
  level.
* An entry whose gram and span both occur earlier is covered whole. Entries that share a
  gram but not the span are contested: only parts of them may repeat.
* Contested spans (at most 168 bytes) are fetched from the texts and compared window by
  window among the entries of their gram: the first of equal windows stays.

Hashes are 64 bits wide; span and window hashes only meet hashes under the same gram hash.
Equal spans of ``ENTRY_ROWS`` documents are reduced to the first before the shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ODD, mix64, powers, release_memory, shared_folder, slices

LENGTH = 100
GRAM = 32
N_BATCHES = 4
GROUP_BYTES = 500_000  # bytes hashed at a time; four times this stays below 2 ** 24
ENTRY_ROWS = 3_000  # documents whose equal spans are reduced before the shuffle
MAX_BROADCAST_VALUES = 4_000_000  # 32 MB of packed spans
_STARTS = LENGTH - GRAM + 1
_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)
_ENTRY = ("key", "run", "doc", "p", "n", "d")
_FOUND = "kind int, shard int, doc long, p int, n int, d int, file string"
COVERED, CONTESTED, LEVEL = 0, 1, 2


@functools.lru_cache(maxsize=4)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(ODD, n), powers(_INVERSE, n)


def _prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (byte + 1) * ODD ** place, and the inverse powers."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _tables(size)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return total, down


def text_runs(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of the texts that lie end to end in ``data`` (text t from starts[t] to
    starts[t + 1]): arrays ``text, p, n, d, key, run``; a run has the window starts
    p .. p + n of its text and its anchor at p + d."""
    n = len(data)
    empty = {k: np.empty(0, dtype=np.uint64 if k in ("key", "run") else np.int64)
             for k in ("text", "p", "n", "d", "key", "run")}
    lengths = np.diff(starts)
    if n < LENGTH or lengths.max(initial=0) < LENGTH:
        return empty
    total, down = _prefix_hash(data)
    gram = mix64((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    value = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    low, span = value, 1
    while span * 2 <= _STARTS:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:len(value) - _STARTS + 1], low[_STARTS - span:])
    anchor = (low & _PLACE).astype(np.int64)
    # Window starts whose window lies within one text.
    windows = np.maximum(lengths - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(lengths)), windows)
    at = np.arange(len(text)) + np.repeat(starts[:-1] - (np.cumsum(windows) - windows), windows)
    a = anchor[at]
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    p1, p2, a = at[first], at[last], a[first]
    d = a - p1
    raw = (total[p2 + LENGTH] - total[p1]) * down[p1]
    run = mix64(raw ^ mix64((((p2 - p1) << 8) | d).astype(np.uint64) + ODD))
    text = text[first]
    return {"text": text, "p": p1 - starts[text], "n": p2 - p1, "d": d, "key": gram[a], "run": run}


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the texts' bounds in them (null: empty)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, dtype=np.uint8)
    return data, offsets


def _groups(offsets: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def _long_text_runs(data: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of one text of any length, by overlapping stretches. A run cut by the end of a
    stretch is left out there and found whole from its own start in the next one."""
    if len(data) <= 4 * GROUP_BYTES:
        return text_runs(data, np.array([0, len(data)]))
    parts, at = [], 0
    while True:
        end = min(len(data), at + 4 * GROUP_BYTES)
        r = text_runs(data[at:end], np.array([0, end - at]))
        keep = len(r["p"]) if end == len(data) else len(r["p"]) - 1
        step = int(r["p"][-1])
        parts.append({k: v[:keep] + at if k == "p" else v[:keep] for k, v in r.items()})
        if end == len(data):
            return {k: np.concatenate([x[k] for x in parts]) for k in parts[0]}
        at += step


def _order(e: dict[str, np.ndarray]) -> np.ndarray:
    return np.lexsort((e["p"], e["doc"], e["run"], e["key"]))


def _take(e: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[which] for k, v in e.items()}


def _concat(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([x[k] for x in parts]) for k in _ENTRY}


def _scan(e: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of entries in order: is it covered by an earlier equal one; is its gram contested."""
    n = len(e["key"])
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    same_key = np.zeros(n, bool)
    same_key[1:] = e["key"][1:] == e["key"][:-1]
    covered = same_key.copy()
    covered[1:] &= e["run"][1:] == e["run"][:-1]
    group = np.cumsum(~same_key) - 1
    spans = np.bincount(group[~covered], minlength=group[-1] + 1)
    return covered, (spans > 1)[group]


def _intervals(doc: np.ndarray, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered window-start ranges p .. p + n joined where they touch, per document."""
    o = np.lexsort((p, doc))
    doc, p, end = doc[o], p[o], (p + n)[o]
    if not len(doc):
        return doc, p, n
    group = np.zeros(len(doc), dtype=np.int64)
    group[1:] = doc[1:] != doc[:-1]
    group = np.cumsum(group)
    # Running maximum of the ends within a document.
    base = group * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + base) - base
    new = np.ones(len(doc), bool)
    new[1:] = (group[1:] != group[:-1]) | (p[1:] > reach[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], p[first], reach[last] - p[first]


def _released(fn):
    @functools.wraps(fn)
    def run(batches):
        yield from fn(batches)
        release_memory()
    return run


@_released
def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the documents, one per distinct span of an Arrow batch; rows whose span
    occurs earlier in the batch come as joined covered ranges (run null)."""
    for b in slices(batches, ENTRY_ROWS):
        data, bounds = _text_bytes(b.column("text"))
        ids = b.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
        parts = []
        for i, j in _groups(bounds):
            part = data[bounds[i]:bounds[j]]
            if j == i + 1:
                r = _long_text_runs(part)
            else:
                r = text_runs(part, bounds[i:j + 1] - bounds[i])
            r["doc"] = ids[i + r.pop("text")]
            parts.append(r)
        if not parts:
            continue
        e = _concat(parts)
        e = _take(e, _order(e))
        same = np.zeros(len(e["key"]), bool)
        same[1:] = (e["key"][1:] == e["key"][:-1]) & (e["run"][1:] == e["run"][:-1])
        doc, p, n = _intervals(e["doc"][same], e["p"][same], e["n"][same])
        e = _take(e, ~same)
        for lo in range(0, len(e["key"]), 200_000):
            x = {k: v[lo:lo + 200_000] for k, v in e.items()}
            yield pa.RecordBatch.from_pydict({
                "key": x["key"].view(np.int64), "run": x["run"].view(np.int64), "doc": x["doc"],
                "p": x["p"].astype(np.int32), "n": x["n"].astype(np.int32), "d": x["d"].astype(np.int32)})
        if len(doc):
            yield pa.RecordBatch.from_pydict({
                "key": mix64(doc.astype(np.uint64)).view(np.int64), "run": pa.nulls(len(doc), pa.int64()),
                "doc": doc, "p": p.astype(np.int32), "n": n.astype(np.int32),
                "d": np.full(len(doc), -1, dtype=np.int32)})


def _open_fs(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


_LEVEL_SCHEMA = pa.schema([("key", pa.uint64()), ("run", pa.uint64()), ("doc", pa.int64()),
                           ("p", pa.int32()), ("n", pa.uint8()), ("d", pa.uint8())])


def _read_level(folder: str, file: str) -> dict[str, np.ndarray]:
    fs, _ = _open_fs(folder)
    source = pa.memory_map(file) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(file)
    t = pa.ipc.open_file(source).read_all()
    return {k: t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in _ENTRY}


def _write_level(folder: str, e: dict[str, np.ndarray]) -> str:
    fs, root = _open_fs(folder)
    fs.create_dir(root, recursive=True)
    name = f"{root}/level-{uuid.uuid4().hex}.arrow"
    arrays = [pa.array(e[f.name].astype(f.type.to_pandas_dtype(), copy=False), f.type) for f in _LEVEL_SCHEMA]
    with fs.open_output_stream(name) as sink, pa.ipc.new_file(sink, _LEVEL_SCHEMA) as w:
        w.write_batch(pa.record_batch(arrays, schema=_LEVEL_SCHEMA))
    return name


class SuffixIndexFamily:
    """The levels of the index, each a sorted file per shard, in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark, "suffix-family")
        self.shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, dict[int, str]]] = []  # (batches in it, file by shard)

    def add(self, docs: DataFrame) -> DataFrame:
        """Index the next batch ``docs(doc, text)``, whose ids are above all earlier ones.
        Returns its findings, written: covered ranges and contested entries
        (``kind, doc, p, n, d``)."""
        size, merged, kept = 1, [], []
        for batches, files in reversed(self.levels):
            if batches == size:
                merged.append(files)
                size *= 2
            else:
                kept.append(files)
        folder = self.folder

        def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = TaskContext.get().partitionId()
            release_memory()
            held = list(rows)  # a shard without new entries still carries its levels on
            table = pa.Table.from_batches(held) if held else None
            return _merge_shard(table, shard, folder, merged, kept)

        # The shard is a function of the gram; repartitioning by it keeps it in one task.
        entries = (docs.mapInArrow(_entries, "key long, run long, doc long, p int, n int, d int")
                   .repartition(self.shards, "key"))

        def run(rows):
            yield from merge(rows)

        out = shared_folder(self.spark, "suffix-found")
        entries.mapInArrow(run, _FOUND).write.parquet(out)
        found = self.spark.read.schema(_FOUND).parquet(out)
        files = {r["shard"]: r["file"]
                 for r in found.where(F.col("kind") == LEVEL).select("shard", "file").collect()}
        self.levels = [x for x in self.levels if x[1] not in merged] + [(size, files)]
        return found.where(F.col("kind") != LEVEL).select("kind", "doc", "p", "n", "d")


def _merge_shard(table, shard, folder, merged, kept) -> Iterator[pa.RecordBatch]:
    def rows(kind: int, e: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(e["doc"]), 200_000):
            x = {k: e[k][lo:lo + 200_000] for k in ("doc", "p", "n", "d")}
            m = len(x["doc"])
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.full(m, kind, np.int32)), "shard": pa.array(np.full(m, shard, np.int32)),
                "doc": x["doc"].astype(np.int64), "p": x["p"].astype(np.int32), "n": x["n"].astype(np.int32),
                "d": x["d"].astype(np.int32), "file": pa.nulls(m, pa.string())})

    if table is not None and table.num_rows:
        run = table.column("run").combine_chunks()
        known = ~run.is_null().to_numpy(zero_copy_only=False)
        cols = {k: table.column(k).to_numpy() for k in ("doc", "p", "n", "d")}
        yield from rows(COVERED, _take(cols, ~known))
        new = _take(cols, known)
        new["key"] = table.column("key").to_numpy()[known].view(np.uint64)
        new["run"] = run.drop_null().to_numpy().view(np.uint64)
        new = _take(new, _order(new))
        covered, contested = _scan(new)
        yield from rows(COVERED, _take(new, covered))
        new, contested = _take(new, ~covered), contested[~covered]
    else:
        new = {k: np.empty(0, dtype=np.uint64 if k in ("key", "run") else np.int64) for k in _ENTRY}
        contested = np.zeros(0, bool)

    below = [_read_level(folder, files[shard]) for files in merged if shard in files]
    above = [_read_level(folder, files[shard]) for files in kept if shard in files]
    gone = np.zeros(len(new["key"]), bool)
    for level in below + above:
        keys = np.unique(new["key"])
        lo = np.searchsorted(level["key"], keys, "left")
        hi = np.searchsorted(level["key"], keys, "right")
        shared = hi > lo
        if not shared.any():
            continue
        lo, n = lo[shared], (hi - lo)[shared]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        old = _take(level, at)
        mine = np.flatnonzero(np.isin(new["key"], keys[shared]))
        both = _concat([old, _take(new, mine)])
        source = np.concatenate([np.full(len(at), -1), mine])
        o = _order(both)
        both, source = _take(both, o), source[o]
        covered, disputed = _scan(both)
        gone[source[covered & (source >= 0)]] = True
        contested[source[disputed & (source >= 0)]] = True
        yield from rows(CONTESTED, _take(both, disputed & (source < 0)))
    yield from rows(COVERED, _take(new, gone))
    yield from rows(CONTESTED, _take(new, contested & ~gone))
    level = _concat([*below, _take(new, ~gone)])
    level = _take(level, np.lexsort((level["run"], level["key"])))
    if len(level["key"]):
        name = _write_level(folder, level)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([LEVEL], pa.int32()), "shard": pa.array([shard], pa.int32()),
            "doc": pa.array([0], pa.int64()), "p": pa.array([0], pa.int32()), "n": pa.array([0], pa.int32()),
            "d": pa.array([0], pa.int32()), "file": [name]})


def _with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``docs`` left-joined to one packed list per document: broadcast when the measured
    size of the lists is small, else a shuffle join on the document."""
    lists = cut_lineage(lists)
    n = lists.agg(F.sum(F.size("items") + 4).alias("n")).first()["n"] or 0
    return docs.join(F.broadcast(lists) if n <= MAX_BROADCAST_VALUES else lists, "doc", "left")


@_released
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of contested entries with their gram's hash."""
    for b in slices(batches):
        data, bounds = _text_bytes(b.column("text"))
        docs = b.column("doc").to_pylist()
        out: dict[str, list] = {"key": [], "doc": [], "p": [], "n": [], "span": []}
        for i, items in enumerate(b.column("items").to_pylist()):
            if not items:
                continue
            raw = data[bounds[i]:bounds[i + 1]].tobytes()
            for x in items:
                p, n, d = x >> 16, (x >> 8) & 255, x & 255
                gram = raw[p + d:p + d + GRAM]
                out["key"].append(int.from_bytes(hashlib.blake2b(gram, digest_size=8).digest(), "little", signed=True))
                out["doc"].append(docs[i])
                out["p"].append(p)
                out["n"].append(n)
                out["span"].append(raw[p:p + n + LENGTH])
            if len(out["key"]) > 20_000:
                yield pa.RecordBatch.from_pydict(out, schema=_SPAN)
                out = {k: [] for k in out}
        if out["key"]:
            yield pa.RecordBatch.from_pydict(out, schema=_SPAN)


_SPAN = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("p", pa.int32()), ("n", pa.int32()),
                   ("span", pa.binary())])


def _equal_windows(t: pa.Table) -> pa.RecordBatch:
    """Ranges of window starts whose window occurs earlier under the same gram."""
    spans = t.column("span").combine_chunks().cast(pa.large_binary())
    bounds = np.frombuffer(spans.buffers()[1], dtype=np.int64)[spans.offset:spans.offset + len(spans) + 1]
    data = np.frombuffer(spans.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    total, down = _prefix_hash(data)
    count = t.column("n").to_numpy().astype(np.int64) + 1
    row = np.repeat(np.arange(len(count)), count)
    j = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = bounds[:-1][row] + j
    window = mix64((total[at + LENGTH] - total[at]) * down[at])
    key = t.column("key").to_numpy()[row]
    doc = t.column("doc").to_numpy()[row]
    p = t.column("p").to_numpy().astype(np.int64)[row] + j
    o = np.lexsort((p, doc, window, key))
    same = np.zeros(len(o), bool)
    same[1:] = (key[o][1:] == key[o][:-1]) & (window[o][1:] == window[o][:-1])
    hit = o[same]
    d, p, n = _intervals(doc[hit], p[hit], np.zeros(len(hit), np.int64))
    return pa.RecordBatch.from_pydict({"doc": d.astype(np.int64), "p": p.astype(np.int32), "n": n.astype(np.int32)})


@_released
def _windows(batches: Iterator[pa.RecordBatch], size: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Whole grams at a time, of rows sorted by gram."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= size:
            t = pa.Table.from_batches(held)
            keys = t.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield _equal_windows(t.slice(0, cut))
                held, rows = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if rows:
        yield _equal_windows(pa.Table.from_batches(held))


def repeated_ranges(docs: DataFrame, n_batches: int = N_BATCHES) -> DataFrame:
    """``doc, items`` of ``docs(doc, text)`` with unique ids: per document the ranges of
    window starts (p * 2 ** 32 + n) whose 100-byte string starts earlier as well."""
    family = SuffixIndexFamily(docs.sparkSession)
    cuts = docs.approxQuantile("doc", [i / n_batches for i in range(1, n_batches)], 0.02) if n_batches > 1 else []
    cuts = sorted(set(cuts))
    found = None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        batch = docs
        if lo is not None:
            batch = batch.where(F.col("doc") > F.lit(int(lo)))
        if hi is not None:
            batch = batch.where(F.col("doc") <= F.lit(int(hi)))
        part = family.add(batch)
        found = part if found is None else found.unionByName(part)
    item = F.col("p").cast("long") * F.lit(1 << 16) + F.col("n") * 256 + F.col("d")
    contested = (found.where(F.col("kind") == CONTESTED)
                 .groupBy("doc").agg(F.collect_set(item).alias("items")))
    spans = (_with_lists(docs, contested).where("items is not null")
             .mapInArrow(_contexts, "key long, doc long, p int, n int, span binary")
             .repartition("key").sortWithinPartitions("key"))
    windows = spans.mapInArrow(_windows, "doc long, p int, n int")
    out = shared_folder(docs.sparkSession, "suffix-windows")
    windows.write.parquet(out)
    windows = docs.sparkSession.read.schema("doc long, p int, n int").parquet(out)
    covered = found.where(F.col("kind") == COVERED).select("doc", "p", "n").unionByName(windows)
    return covered.groupBy("doc").agg(
        F.collect_list(F.col("p").cast("long") * F.lit(1 << 32) + F.col("n")).alias("items"))


def _kept(raw: bytes, items: list[int] | None) -> tuple[bytes, int, int]:
    if not items:
        return raw, 0, 0
    x = np.array(items, dtype=np.int64)
    _, p, n = _intervals(np.zeros(len(x), np.int64), x >> 32, (x & 0xFFFFFFFF) + LENGTH - 1)
    end = p + n + 1
    keep = np.ones(len(raw), bool)
    for a, b in zip(p.tolist(), end.tolist()):
        keep[a:b] = False
    return np.frombuffer(raw, np.uint8)[keep].tobytes(), int((end - p).sum()), len(p)


def remove_repeats(docs: DataFrame, n_batches: int = N_BATCHES, with_text: bool = False) -> DataFrame:
    """Remove from each text of ``docs(doc_id, text, ...)`` every byte of a 100-byte string
    that starts earlier too. Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``,
    or with ``with_text`` all input columns, ``text`` (bytes of a character cut in two are
    dropped) and ``n_chars`` replaced.

    Null text is the empty text. Null and repeated ids: the rows are first numbered in the
    order of id (nulls first), then text, so equal rows count as one after the other. Empty
    tables give no rows; other columns pass through untouched."""
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    rest = [c for c in docs.columns if with_text and c not in ("text", "n_chars")] or ["doc_id"]
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc"), F.struct(*rest).alias("rest"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if odd:
        numbered = cut_lineage(numbered.repartitionByRange("doc").sortWithinPartitions("doc", "text")
                               .withColumn("doc", F.monotonically_increasing_id()))
    ranges = repeated_ranges(numbered.select("doc", "text"), n_batches)
    schema = docs.select(*rest).schema
    types = ([("text", "string"), ("n_chars", "long")] if with_text else
             [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")])
    for name, kind in types:
        schema = schema.add(name, kind)
    joined = _with_lists(numbered, ranges)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, bounds = _text_bytes(b.column("text"))
            out = {name: [] for name, _ in types}
            for i, items in enumerate(b.column("items").to_pylist()):
                raw = data[bounds[i]:bounds[i + 1]].tobytes()
                kept, removed, spans = _kept(raw, items)
                if with_text:
                    text = kept.decode("utf-8", "ignore")
                    row = (text, len(text))
                else:
                    row = (len(raw), removed, spans, hashlib.sha256(kept).hexdigest())
                for (name, _), value in zip(types, row):
                    out[name].append(value)
            arrays = b.column("rest").flatten()
            arrays += [pa.array(out[name], pa.string() if kind == "string" else pa.int64()) for name, kind in types]
            yield pa.RecordBatch.from_arrays(arrays, names=[*rest, *out])

    result = joined.select("rest", "text", "items").mapInArrow(finish, schema)
    return result.select(*docs.columns) if with_text and "n_chars" in docs.columns else result
