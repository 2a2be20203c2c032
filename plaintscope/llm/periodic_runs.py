"""Maximal periodic runs of words by recursive frequency splitting and a lag scan.

Words are runs of characters other than space and U+0009..U+000D, numbered from 0 in a text.
A run is a stretch of words with smallest period q, at least ``min_words`` long and at least
``min_exponent`` times q, that no neighbouring word extends under q.

* Splitting: a word of a run stands ``min_exponent`` times in it at least, so a word found less
  often in its segment belongs to no run there. Such words split the segment, shorter pieces than
  ``min_words`` go, and the pieces are counted anew until nothing is rare any more. Prose is used
  up in two or three rounds. A round that takes next to nothing after ``FULL_ROUNDS`` ends the
  splitting early (the scan is exact on any segment), so no text costs a round per word.
* Lag scan: the surviving segments of many texts lie end to end, apart by words of their own,
  longest first. A run of period q gives at least ``reach`` = length - q equal pairs (i, i + q) in
  a row, so at lag q only every (reach / 2)-th place is looked at, by the hash of the ``reach / 2``
  words from there: N / q places per lag, N log N in all. A place that agrees is compared word by
  word in both directions, unless it lies in a run already found whose period divides q (a stretch
  with period q that holds q words of period p | q has period p throughout). Lags ascend, so a
  stretch that is long enough and not covered has q as its smallest period.

Texts are judged one by one inside the row's task; nothing is shuffled, and a hot source or id
plays no part. Memory: the words of ``BATCH_WORDS`` words' worth of texts, or of one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ODD, mix64, powers, release_memory, slices
from .line_rules import _let, words

MIN_WORDS = 24
MIN_EXPONENT = 3
BATCH_WORDS = 400_000
FULL_ROUNDS = 32
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def split_segments(w: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS,
                   min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """Ranges of ``w`` (word hashes of texts end to end, ``doc`` the text of each) in which no
    word is rarer than ``min_exponent``."""
    done: list[tuple[int, int]] = []
    _, word = np.unique(w, return_inverse=True)
    kinds = int(word.max(initial=0)) + 1
    at, seg, rounds = np.arange(len(w)), doc.astype(np.int64), 0
    while len(at):
        rounds += 1
        _, back, n = np.unique(seg * kinds + word[at], return_inverse=True, return_counts=True)
        keep = n[back] >= min_exponent
        left, part = at[keep], seg[keep]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1] + 1) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(left)))
        old = np.bincount(seg, minlength=int(seg.max()) + 1)[part[first]]
        long = size >= min_words
        still = size == old  # nothing in it was rare
        if rounds >= FULL_ROUNDS and 100 * (len(at) - int(size[long].sum())) < len(at):
            still |= True
        done += [(a, a + n) for a, n in zip(left[first[long & still]].tolist(), size[long & still].tolist())]
        again = np.repeat(long & ~still, size)
        at, seg = left[again], (np.cumsum(new) - 1)[again]
        if len(seg):
            _, seg = np.unique(seg, return_inverse=True)
    return done


def _stretch(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The places lo <= i <= hi with w[j] == w[j + q] for all j of lo .. hi - 1, as far as it goes."""
    lo, step = i, 32
    while lo:
        a = max(0, lo - step)
        other = np.flatnonzero(w[a:lo] != w[a + q:lo + q])
        if len(other):
            lo = a + int(other[-1]) + 1
            break
        lo, step = a, 2 * step
    hi, step, end = i, 32, len(w) - q
    while hi < end:
        b = min(end, hi + step)
        other = np.flatnonzero(w[hi:b] != w[hi + q:b + q])
        if len(other):
            hi += int(other[0])
            break
        hi, step = b, 2 * step
    return lo, hi


def _covered(found: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the ranges a .. b lie in one of the runs (starts, ends) of one period: those
    overlap by less than the period, so starts and ends ascend together."""
    k = np.searchsorted(found[0], a, side="right") - 1
    return (k >= 0) & (found[1][k] >= b)


def lag_scan(w: np.ndarray, lengths: np.ndarray, min_words: int = MIN_WORDS,
             min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of segments end to end in ``w``: ``lengths`` descending,
    each followed by a word found nowhere else."""
    out: list[tuple[int, int, int]] = []
    if not len(lengths):
        return out
    up = powers(ODD, len(w) + 1)
    total = np.zeros(len(w) + 1, dtype=np.uint64)
    np.cumsum(w * up[:-1], out=total[1:])
    ends = np.cumsum(lengths + 1)
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    periods = np.empty(0, np.int64)
    for q in range(1, int(lengths[0]) // min_exponent + 1):
        need = max(min_words, min_exponent * q)
        n = int(np.searchsorted(-lengths, -need, side="right"))  # segments long enough
        if not n:
            break
        reach = need - q
        k = max(1, reach // 2)
        step = reach - k + 1
        stop = int(ends[n - 1]) - q - k + 1
        if stop <= 0:
            continue
        x = total[k:stop + k:step] - total[:stop:step]
        y = total[q + k:stop + q + k:step] - total[q:stop + q:step]
        at = np.flatnonzero(x * up[q] == y) * step
        if not len(at):
            continue
        open_ = np.ones(len(at), bool)
        for p in periods[q % periods == 0].tolist():
            open_ &= ~_covered(found[p], at, at + q + k)
        hi, mine = -1, []
        for i in at[open_].tolist():
            if i + k <= hi:
                continue
            lo, hi = _stretch(w, i, q)
            if hi - lo >= reach:
                mine.append((lo, hi + q))
                out.append((lo, hi - lo + q, q))
        if mine:
            found[q] = tuple(np.array(mine).T)
            periods = np.append(periods, q)
    return out


def runs_of_texts(texts: list[list[bytes]], min_words: int = MIN_WORDS,
                  min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words) its runs ``(start, length, period)`` by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    w = np.fromiter((hash(x) for t in texts for x in t), np.int64, int(sizes.sum())).view(np.uint64)
    segments = split_segments(w, np.repeat(np.arange(len(texts)), sizes), min_words, min_exponent)
    if not segments:
        return out
    segments.sort(key=lambda s: (s[0] - s[1], s[0]))
    lengths = np.array([b - a for a, b in segments], dtype=np.int64)
    apart = mix64(np.arange(1, len(segments) + 1, dtype=np.uint64) * ODD)  # one word of its own each
    joined = np.concatenate([x for (a, b), s in zip(segments, apart) for x in (w[a:b], [s])])
    places = np.cumsum(lengths + 1) - lengths - 1
    for start, length, period in lag_scan(joined, lengths, min_words, min_exponent):
        s = int(np.searchsorted(places, start, side="right")) - 1
        place = segments[s][0] + start - int(places[s])
        doc = int(np.searchsorted(first, place, side="right")) - 1
        out[doc].append((place - int(first[doc]), length, period))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(text)
    gone = np.zeros(len(text), bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([text[i] for i in np.flatnonzero(~gone).tolist()])


def _batch(ids: list, texts: list[list[bytes]], **limits) -> pa.RecordBatch:
    found = runs_of_texts(texts, **limits)
    flat = np.array([r for rs in found for r in rs], dtype=np.int64).reshape(-1, 3)
    offsets = np.cumsum([0] + [len(r) for r in found]).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"]))
    text = pa.array([collapsed(t, r) for t, r in zip(texts, found)], pa.large_binary()).cast(pa.large_string())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), runs, text.cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``n_words``, ``runs`` by start and
    period, and ``collapsed``, the text's words joined by one space without the repeats.

    Null and empty texts and texts of blanks have no words, no runs and the empty collapsed text.
    Null and repeated ids stay rows of their own, with equal results for equal texts. Texts of any
    length are judged whole. Overlapping runs (also of one start, told apart by period) are all
    given. Columns beyond the two are not read, whatever their names; an empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        n = 0
        for b in slices(batches):
            for d, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids.append(d)
                texts.append(t.split() if t else [])  # bytes: exactly the six blanks
                n += len(texts[-1])
                if n >= BATCH_WORDS:
                    yield _batch(ids, texts, min_words=min_words, min_exponent=min_exponent)
                    ids, texts, n = [], [], 0
        if ids:
            yield _batch(ids, texts, min_words=min_words, min_exponent=min_exponent)
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, RUNS)


def with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``docs``; where crc32 of the decimal id is a multiple of 10, the words
    from a place of the id on repeat with a period of the id, joined by one space (ids that are
    null and texts without a word stay as they are)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def edited(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise("")

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(
        (F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), _let(words(text), edited)).otherwise(text).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs`` the number of runs, the run of the greatest length / period
    (ties: smallest start, then period; four nulls without a run), and two digests."""
    best = F.aggregate(
        F.slice("runs", 2, 1 << 30), F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"].cast("decimal(19,0)") * b["period"].cast("decimal(19,0)")
                            > b["length"].cast("decimal(19,0)") * r["period"].cast("decimal(19,0)"), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256", "n_words")
