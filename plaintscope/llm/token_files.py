"""Token ids as Arrow files of fixed-size-list batches.

One file pair per range of document ids, in ascending order:

* ``part-NNNNN.arrow`` (Arrow IPC file format, uncompressed): columns ``ids``
  (fixed-size list of ``sequence_length`` unsigned ids, 16 bits wide where the vocabulary
  allows) and ``mask`` (fixed-size list of booleans, false on padding). A sequence is a
  row of a record batch; row r of batch b is found by the file's footer, so a memory map
  gives its ids without copying (masks are packed bits, which numpy has to unpack). All batches but the last have ``BATCH_ROWS`` rows.
* ``part-NNNNN.docs.arrow``: ``doc_id``, ``start`` (in this part's id stream), ``n_tokens``.

Within a part the ids of all documents stand end to end, each closed by the end id; only a
part's last sequence is padded. The manifest (one row per part) names only the files of
task attempts that succeeded: each attempt writes under a name of its own, so a lost
executor or a speculative copy leaves an unread file, never a wrong one.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import shared_folder, slices
from .encoding import default_path, encoder, text_groups

BATCH_ROWS = 512
MANIFEST = "part int, file string, docs_file string, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long, part int"


def _filesystem(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _id_type(vocab_size: int):
    return (pa.uint16(), "<u2") if vocab_size <= 1 << 16 else (pa.uint32(), "<u4")


class _SequenceWriter:
    """Collects an id stream and writes it as batches of fixed-size lists."""

    def __init__(self, sink, length: int, kind, dtype: str):
        self.length, self.kind, self.dtype = length, kind, dtype
        self.schema = pa.schema([("ids", pa.list_(kind, length)),
                                 ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def _flush(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, dtype=self.dtype)
        padded[:len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length)
                 for x in (padded, mask)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.n_waiting += len(ids)
        step = BATCH_ROWS * self.length
        if self.n_waiting >= step:
            stream = np.concatenate(self.waiting)
            full = len(stream) // step * step
            for i in range(0, full, step):
                self._flush(stream[i:i + step])
            self.waiting, self.n_waiting = [stream[full:]], len(stream) - full

    def close(self) -> None:
        if self.n_waiting:
            self._flush(np.concatenate(self.waiting))
        self.writer.close()


def write_token_files(docs: DataFrame, folder: str | None = None, sequence_length: int = 1024,
                      end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs(doc_id, text)`` and return the manifest, checkpointed.

    Null text is the empty text; it still gets its end id. A repeated doc_id keeps all its
    rows, ordered by text. A null doc_id sorts first. An empty table gives no files. The
    documents are dealt to files by range of doc_id (sampled boundaries), so a source's
    size plays no part and no task holds more than its range; texts stream through.
    """
    path = tokenizer or default_path()
    out = folder or shared_folder(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind, dtype = _id_type(enc.vocab_size)
        rows = ((d, t or "") for b in slices(batches)
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        first = next(rows, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        fs, root = _filesystem(out)
        fs.create_dir(root, recursive=True)
        name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}"
        end = np.array([end_id], dtype="<u4")
        doc_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                                ("n_tokens", pa.int64())])
        n_docs = at = 0
        with fs.open_output_stream(f"{name}.arrow") as sink, \
                fs.open_output_stream(f"{name}.docs.arrow") as docs_sink, \
                pa.ipc.new_file(docs_sink, doc_schema) as index:
            seqs = _SequenceWriter(sink, sequence_length, kind, dtype)

            def with_first():
                yield first
                yield from rows

            for group in text_groups(with_first()):
                ids, starts, sizes = [], [], []
                for raw in enc.encode_many([t for _, t in group]):
                    x = np.frombuffer(raw, dtype="<u4")
                    ids += [x, end]
                    starts.append(at)
                    sizes.append(len(x) + 1)
                    at += len(x) + 1
                seqs.add(np.concatenate(ids))
                n_docs += len(group)
                index.write_batch(pa.record_batch(
                    [pa.array([d for d, _ in group], pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64())], schema=doc_schema))
            seqs.close()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "file": [f"{name}.arrow"],
            "docs_file": [f"{name}.docs.arrow"], "n_docs": [n_docs], "n_tokens": [at]})

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    manifest = ordered.mapInArrow(write, MANIFEST).withColumn("folder", F.lit(out))
    return cut_lineage(manifest)


def open_part(folder: str, file: str):
    """An Arrow file reader; memory-mapped where the shared folder is a mounted path."""
    fs, _ = _filesystem(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(file))
    return pa.ipc.open_file(fs.open_input_file(file))


def read_sequence(folder: str, file: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence, by its number in the part."""
    reader = open_part(folder, file)
    batch = reader.get_batch(row // BATCH_ROWS)
    return tuple(batch.column(c)[row % BATCH_ROWS].values.to_numpy(zero_copy_only=False)
                 for c in ("ids", "mask"))


def _stream(reader) -> Iterator[np.ndarray]:
    for i in range(reader.num_record_batches):
        b = reader.get_batch(i)
        ids = b.column("ids").flatten().to_numpy()
        mask = b.column("mask").flatten().to_numpy(zero_copy_only=False)
        yield ids[mask] if not mask.all() else ids


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: its ids' place in the whole stream, their
    count and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                index = open_part(row["folder"], row["docs_file"])
                stream = _stream(open_part(row["folder"], row["file"]))
                held, at = np.empty(0, dtype="<u4"), 0  # ids held, place of the first
                for i in range(index.num_record_batches):
                    d = index.get_batch(i)
                    starts = d.column("start").to_numpy()
                    sizes = d.column("n_tokens").to_numpy()
                    crcs = []
                    for s, n in zip(starts.tolist(), sizes.tolist()):
                        crc, left = 0, n
                        while left:
                            if at + len(held) <= s:
                                at += len(held)
                                held = next(stream).astype("<u4")
                                continue
                            piece = held[s - at:s - at + left]
                            crc = zlib.crc32(piece.tobytes(), crc)
                            left -= len(piece)
                            s += len(piece)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": d.column("doc_id"), "start": pa.array(starts + row["offset"]),
                        "n_tokens": d.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64()),
                        "part": pa.array([row["part"]] * len(starts), pa.int32())})

    # One row per file: a running sum over the files, then dealt out again.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, manifest.rdd.getNumPartitions())
    return files.repartition(n).mapInArrow(read, ROWS)
