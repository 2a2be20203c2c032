"""Harmonic packing of token ids into fixed-length sequences.

A document's ids (with its end id) fill whole sequences first; the rest r < capacity goes
to the reciprocal class k = capacity // r, whose bins always take k pieces. Where k pieces
of r would leave more than ``WASTE`` of a sequence empty, a piece of capacity // (k + 1)
ids is cut off for class k + 1 and the remainder is classed again. Each worker fills each
class's bins with k pieces on its own, in the order the pieces come. The pieces of each
worker's one unfinished bin per class are then numbered across workers (a running sum over
one count per worker and class) and fill bins of k again, so the whole corpus has at most
one unfinished bin per class. Those last pieces, fewer than the sum of k over the classes
whatever the corpus, are packed first-fit by falling length.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import release_memory, slices
from .encoding import MAX_CACHED_WORDS, default_path, encoder, text_groups

CAPACITY = 1024
WASTE = 1 / 64
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "worker long, k int, sequence_id long, offset long, left_rank long")
_NAMES = [c.split()[0] for c in _PIECE.split(", ")]
# Sequence numbers: full bins of a worker, shared bins of a class, the last bins.
_WORKER, _CLASS, _LAST = 1 << 36, 1 << 60, 1 << 61


@functools.lru_cache(maxsize=4096)
def tail_pieces(rest: int, capacity: int = CAPACITY) -> tuple[tuple[int, int], ...]:
    """``(length, class)`` of the pieces of a rest shorter than the capacity."""
    out = []
    while rest:
        k = capacity // rest
        if capacity - k * rest <= capacity * WASTE:
            out.append((rest, k))
            break
        cut = capacity // (k + 1)
        out.append((cut, k + 1))
        rest -= cut
    return tuple(out)


def pack_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0,
                tokenizer: str | None = None, with_ids: bool = False,
                max_words: int = MAX_CACHED_WORDS) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)`` with its sequence and its place there.

    Null text is the empty text: its document is the end id alone. Repeated or null
    doc_ids are packed as separate documents. An empty table gives no rows. Documents stay
    in their input partitions; no text is shuffled. ``with_ids`` keeps the ids (binary,
    little-endian unsigned 32-bit) as column ``ids``; ``max_words`` bounds the words whose
    ids a worker keeps.
    """
    path = tokenizer or default_path()
    names = _NAMES + ["ids"] * with_ids
    schema = _PIECE + ", ids binary" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, max_words)
        end = int(end_id).to_bytes(4, "little")
        worker = TaskContext.get().partitionId()
        next_id = worker * _WORKER
        open_bins: dict[int, list[list]] = {}
        filled: dict[int, int] = {}
        done: list[list] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done))
            done.clear()
            types = [pa.int32() if n == "k" else pa.binary() if n == "ids" else pa.int64()
                     for n in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=names)

        rows = ((d, t or "") for b in slices(batches)
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for group in text_groups(rows):
            for (doc, _), raw in zip(group, enc.encode_many([t for _, t in group])):
                raw += end
                total = len(raw) // 4
                cuts = [(capacity, 1)] * (total // capacity)
                cuts += tail_pieces(total % capacity, capacity)
                at = 0
                for length, k in cuts:
                    ids = raw[4 * at:4 * (at + length)]
                    row = [doc, at, length, zlib.crc32(ids), total, worker, k, None,
                           filled.get(k, 0), None] + [ids] * with_ids
                    at += length
                    bin_ = open_bins.setdefault(k, [])
                    bin_.append(row)
                    filled[k] = filled.get(k, 0) + length
                    if len(bin_) == k:
                        for r in bin_:
                            r[7] = next_id
                        next_id += 1
                        done += bin_
                        open_bins[k], filled[k] = [], 0
            if len(done) > 20_000:
                yield flush()
        for k, bin_ in open_bins.items():
            for i, r in enumerate(bin_):
                r[9] = i
            done += bin_
        if done:
            yield flush()
        release_memory()

    pieces = cut_lineage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                         .mapInArrow(work, schema))
    keep = [c for c in pieces.columns if c not in ("worker", "left_rank")]
    full = pieces.where("sequence_id is not null").select(keep)

    left = pieces.where("sequence_id is null")
    counts = left.groupBy("worker", "k").agg(F.count("*").alias("n"))
    w = Window.partitionBy("k")
    before = w.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("worker", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           F.sum("n").over(w).alias("n_class"))
    ranked = left.join(counts, ["worker", "k"]).withColumn("rank", F.expr("base + left_rank"))
    ranked = cut_lineage(ranked.withColumn("bin", F.expr("rank div k"))
                         .withColumn("is_full", F.expr("bin < n_class div k")))
    in_bin = Window.partitionBy("k", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    shared = (ranked.where("is_full")
              .withColumn("sequence_id", F.lit(_CLASS) + F.col("k") * F.lit(1 << 40) + F.col("bin"))
              .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
              .select(keep))

    def last_bins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "k", "rank"], ascending=[False, True, True])
        room: list[int] = []
        where, offsets = [], []
        for n in pdf["length"]:
            b = next((i for i, r in enumerate(room) if r >= n), len(room))
            if b == len(room):
                room.append(capacity)
            where.append(_LAST + b)
            offsets.append(capacity - room[b])
            room[b] -= n
        return pdf.assign(sequence_id=where, offset=offsets)[keep]

    # Fewer rows than the sum of k over the classes, whatever the corpus.
    last = (ranked.where("not is_full").groupBy(F.col("is_full").alias("g"))
            .applyInPandas(last_bins, full.schema))
    return full.unionByName(shared).unionByName(last)
