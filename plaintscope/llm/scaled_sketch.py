"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch holds every five-word shingle hash (48 bits) below a fixed fraction 1 / ``SCALE`` of the
hash range. The fraction, not a count, is fixed, so a sketch grows with its text, the sketch of a
union is the union of the sketches, and the share of A's hashes found in B estimates how much of
A is contained in B, however unequal the two are. A text with shingles but none below the
threshold keeps its smallest hash instead (above the threshold, so it can be told apart): it only
counts when both sketches are of that kind, and merging drops it.

``sketch_documents`` gives the sketches, ``merge_sketches`` those of groups of documents,
``likeness`` and ``containment`` are column functions over them. ``compare_with_next`` sketches
each text, an edited copy of it and compares it with its neighbour by descending id, in one
shuffle of the texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, slices
from .shingles import column_sets

SCALE = 4
BITS = 48
GROUP_CHARS = 2_000_000
_LOWEST = -(1 << 63)  # place of rows without an id: after all others
_EXACT = 1 << 53  # ids up to here are told apart as doubles


def sketch_of(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Of a text's shingle hashes (64 bits, ascending) the retained ones, as ascending longs."""
    top = hashes >> np.uint64(64 - BITS)
    n = int(np.searchsorted(top, (1 << BITS) // scale, side="left"))
    return np.unique(top[:n] if n else top[:1]).astype(np.int64)


def fingerprint_text(sketch: np.ndarray, scale: int = SCALE) -> str:
    """The sketch as text: the scale, then its hashes, six bytes each, in base 64."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:]
    return f"{scale}:{base64.b64encode(raw.tobytes()).decode()}"


def _shared(a: np.ndarray, b: np.ndarray, scale: int) -> tuple[int, int, int] | None:
    """Numbers of hashes below the threshold in a, in b and in both; None without any."""
    limit = (1 << BITS) // scale
    a, b = a[a < limit], b[b < limit]
    if not len(a) and not len(b):
        return None
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def compare(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> tuple[float, float]:
    """(estimated Jaccard likeness, estimated share of a contained in b). Two sketches without a
    hash below the threshold are alike if equal (so are two texts without words)."""
    n = _shared(a, b, scale)
    if n is None:
        return (float(np.array_equal(a, b)),) * 2
    return n[2] / (n[0] + n[1] - n[2]), n[2] / n[0] if n[0] else 0.0


def _below(sketch: Column, scale: int) -> Column:
    return F.filter(sketch, lambda h: h < (1 << BITS) // scale)


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """``compare(a, b)[0]`` on sketch columns."""
    x, y = _below(a, scale), _below(b, scale)
    n = F.size(F.array_union(x, y))
    return F.when(n == 0, (a == b).cast("double")).otherwise(F.size(F.array_intersect(x, y)) / n)


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """``compare(a, b)[1]`` on sketch columns."""
    x, y = _below(a, scale), _below(b, scale)
    return (F.when(F.size(F.array_union(x, y)) == 0, (a == b).cast("double"))
            .when(F.size(x) == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(x)))


def _sketches(column: pa.Array, scale: int) -> list[np.ndarray]:
    return [sketch_of(x, scale) for x in column_sets(column)]


def sketch_documents(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``n_chars``, ``sketch`` (ascending
    longs) and ``fingerprint``. Null text is the empty text, with an empty sketch; null and repeated
    ids stay rows of their own; other columns are not read; an empty table gives no rows. No shuffle:
    a hot source or id plays no part."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = _sketches(b.column(1), scale)
            offsets = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t or "") for t in b.column(1).to_pylist()], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array([fingerprint_text(x, scale) for x in found])],
                names=["doc_id", "n_chars", "sketch", "fingerprint"])
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        read, "doc_id long, n_chars long, sketch array<long>, fingerprint string")


def merge_sketches(sketches: DataFrame, by: str, scale: int = SCALE) -> DataFrame:
    """``(by, hash)``: the sketch of each group's union as a set of rows, combined before the
    shuffle; a group of a third of all documents is split over its hashes."""
    return (sketches.select(by, F.explode(_below(F.col("sketch"), scale)).alias("hash")).distinct())


def group_containment(merged: DataFrame, whole: DataFrame, by: str) -> DataFrame:
    """How much of each group of ``merged`` the one sketch ``whole(hash)`` contains:
    ``(by, n_hashes, contained)``."""
    hit = whole.select("hash", F.lit(1).alias("hit__")).distinct()
    return (merged.join(hit, "hash", "left").groupBy(by)
            .agg(F.count("*").alias("n_hashes"), (F.count("hit__") / F.count("*")).alias("contained")))


def _descending_parts(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs(doc_id, text)`` with ``part`` (ranges of ids, about equal in rows, ascending) and
    ``borrowed``: each part also holds the row that follows its smallest one by descending id, the
    first of the next lower part (of the highest for the lowest). Ties of an id go by descending
    hash of the text; an id of several parts' worth of rows is cut by that hash.

    Bounds come from the ids alone. The driver holds one bound and one head per part."""
    spark = docs.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(_LOWEST)))
    shares = [i / wanted for i in range(1, wanted)] or [0.5]
    bounds = rows.agg(F.percentile_approx("key", shares, max(10_000, 8 * wanted)).alias("b")).first()["b"] or []
    rows = rows.withColumn("hash", F.xxhash64("text"))
    if not bounds:  # no rows
        return rows.select(F.lit(0).alias("part"), F.lit(False).alias("borrowed"), "key", "hash", "doc_id", "text"), 1
    single = sorted(set(bounds))
    hot = {b: bounds.count(b) for b in single if bounds.count(b) > 1 and (abs(b) < _EXACT or b == _LOWEST)}
    splits, low = [-np.inf], []
    for b in single:
        if float(b) > splits[-1]:
            splits.append(float(b))
            low.append(b)
    splits.append(np.inf)
    # Numbers of the parts: one per bucket, and before it those of the bucket's hot lowest id.
    extra = [0] + [hot.get(b, 1) - 1 for b in low]
    base = np.cumsum(extra) + np.arange(len(extra))
    rows = (Bucketizer(splits=splits, inputCol="place", outputCol="bucket", handleInvalid="keep")
            .transform(rows.withColumn("place", F.col("key").cast("double"))).drop("place"))
    part = F.get(F.array(*[F.lit(int(x)) for x in base]), F.col("bucket").cast("int"))
    for b, m in hot.items():
        at = F.shiftright((F.shiftright("hash", 33) + F.lit(1 << 30)) * (m - 1), 31).cast("int")  # by rank of the hash
        part = F.when(F.col("key") == b, F.lit(int(base[low.index(b) + 1])) - (m - 1) + at).otherwise(part)
    rows = rows.withColumn("part", part).drop("bucket")
    n_parts = int(base[-1]) + 1
    place = ["key", "hash"] if hot else ["key"]
    heads = rows.groupBy("part").agg(F.max(F.struct(*place)).alias("h")).select("part", "h.*").collect()
    used = sorted(h["part"] for h in heads)
    after = dict(zip(used, used[1:] + used[:1]))  # the part that borrows this one's head
    small = spark.createDataFrame([(h["part"], *[h[c] for c in place], after[h["part"]]) for h in heads],
                                  ", ".join(["part int", *[f"{c} long" for c in place], "lender int"]))
    rows = rows.join(F.broadcast(small), ["part", *place], "left")
    own, lent = (F.struct(F.col(c).alias("part"), F.lit(x).alias("borrowed")) for c, x in (("part", False), ("lender", True)))
    rows = rows.withColumn("to", F.explode(F.when(F.col("lender").isNull(), F.array(own)).otherwise(F.array(own, lent))))
    return rows.select("to.part", "to.borrowed", "key", "hash", "doc_id", "text"), n_parts


NEXT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contained_edited double, contained_next double, n_retained int")


def compare_with_next(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` its fingerprint, that of the edited text, and the
    likeness to the edited text's and to the next document's (by descending id, the first after the
    last). Edited: the last n_chars // 2 code points are replaced by the first as many (or all) of
    the next document.

    Null text is the empty text. Rows without an id come last; rows of one id follow each other
    by descending hash of the text, identical rows in any order. A single row is its own next. Empty
    tables give no rows; other columns are not read. The texts are shuffled once, by ranges of
    ids; a task streams its range in order and holds about ``GROUP_CHARS`` characters, or one text
    and its neighbour if longer.
    """

    def out(seq: list[tuple]) -> pa.RecordBatch | None:
        """Of rows (id, text, sketch, borrowed) in order all but the last, unless borrowed."""
        pairs = [(a, b) for a, b in zip(seq, seq[1:]) if not a[3]]
        if not pairs:
            return None
        edited = []
        for (_, t, *_), (_, after, *_) in pairs:
            half = len(t) // 2
            edited.append(t[:len(t) - half] + after[:half])
        column = pa.array(edited, pa.large_string())
        other = _sketches(column, scale)
        alike = [compare(a[2], e, scale) for (a, _), e in zip(pairs, other)]
        near = [compare(a[2], b[2], scale) for a, b in pairs]
        return pa.RecordBatch.from_arrays([
            pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array([fingerprint_text(a[2], scale) for a, _ in pairs]),
            pa.array([fingerprint_text(e, scale) for e in other]),
            *[pa.array([x[i] for x in xs], pa.float64()) for i in (0, 1) for xs in (alike, near)],
            pa.array([len(a[2]) for a, _ in pairs], pa.int32())], names=[c.split()[0] for c in NEXT.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars = 0
        for b in slices(batches):
            found = _sketches(b.column(2), scale)
            for d, t, s, lent in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), found, b.column(0).to_pylist()):
                held.append((d, t, s, lent))
                chars += len(t)
                if chars >= GROUP_CHARS:
                    batch = out(held)
                    held, chars = held[-1:], 0
                    if batch is not None:
                        yield batch
        batch = out(held)
        if held and not held[-1][3]:
            raise RuntimeError("a part of the ids lacks the row that follows it")
        if batch is not None:
            yield batch
        release_memory()

    rows, n_parts = _descending_parts(docs)
    ordered = (rows.repartitionById(n_parts, F.col("part"))
               .sortWithinPartitions("part", "borrowed", F.desc("key"), F.desc("hash")))
    return ordered.select("borrowed", "doc_id", "text").mapInArrow(read, NEXT)
