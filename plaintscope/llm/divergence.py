"""Source divergence audit by single-pass in-memory indexing.

How the words of each (lang, source) group differ from those of the language and of its other
sources. Terms are runs of ASCII letters and of all characters beyond ASCII, A-Z lower-cased; a
language keeps the terms that ``MIN_DOCS`` of its documents hold.

* Blocks: a task counts its texts into postings (lang, term, source): occurrences and documents.
  When ``BLOCK_POSTINGS`` are held, the block is spilled as a term-sorted run: its entries, dealt
  to hash shards of (lang, term), leave as chunks of ascending keys. The texts are read once.
* Merge: a shard gets its chunks ordered by first key and merges the runs with a heap. A chunk is
  opened when its first key is due, so a task holds two open chunks or fewer per run that overlaps,
  whatever the shard holds. Entries of too few documents are dropped there; the rest, with the
  counts by source, is the frequency table, written once and read by all that follows.
* Pair sums need all kept terms, those found in neither source too. A pair starts from all terms
  at their smoothed zero, (number of terms) x f(zero, zero). One-sided corrections (as if the other
  source lacked the term) come from each source's histogram of probabilities, two-sided ones are
  streamed: each term's own sources in pairs, summed in the task before anything is shuffled.

All arithmetic is on integers. A document belongs to one group, so neither a hot source nor a hot
term is gathered in one task: a term of all documents is one entry per run. What grows with pairs
of sources is the result itself. The table of groups is broadcast behind its measured size.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast
from .common import release_memory, slices, written

MIN_DOCS = 10
TOP_TERMS = 10
BLOCK_POSTINGS = 400_000
CHUNK_KEYS = 256
CHUNK_POSTINGS = 2_048
PAIR_BLOCK = 1_000_000

_LETTER = [c >= 128 or chr(c).isascii() and chr(c).isalpha() for c in range(256)]
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if _LETTER[c] else 32 for c in range(256))
_END = b"\xff"  # never in UTF-8: ends the language in a key
_APART = b"\xfe"  # never in UTF-8 either: between keys and between names of a chunk
_RUN = "shard int, first binary, last binary, keys binary, ends binary, names binary, at binary, n binary, n_docs binary"
_FREQUENCY = "lang string, term string, sources array<string>, counts array<long>"


class Chunk(NamedTuple):
    """Entries in ascending order of key: entry i has the postings up to ``ends[i]``, by source
    (``names[at]``), each with its occurrences and documents."""

    keys: list[bytes]
    ends: np.ndarray
    names: list[bytes]
    at: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def part(self, i: int, j: int) -> Chunk:
        a = int(self.ends[i - 1]) if i else 0
        b = int(self.ends[j - 1])
        return Chunk(self.keys[i:j], self.ends[i:j] - a, self.names, self.at[a:b], self.n[a:b], self.docs[a:b])

    def packed(self) -> tuple:
        used, at = np.unique(self.at, return_inverse=True)
        return (self.keys[0], self.keys[-1], _APART.join(self.keys), self.ends.astype("<i4").tobytes(),
                _APART.join([self.names[i] for i in used.tolist()]), at.astype("<i4").tobytes(),
                self.n.astype("<i8").tobytes(), self.docs.astype("<i8").tobytes())

    @classmethod
    def unpacked(cls, keys: bytes, ends: bytes, names: bytes, at: bytes, n: bytes, docs: bytes) -> Chunk:
        return cls(keys.split(_APART), np.frombuffer(ends, "<i4").astype(np.int64), names.split(_APART),
                   np.frombuffer(at, "<i4"), np.frombuffer(n, "<i8"), np.frombuffer(docs, "<i8"))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, in order."""
    return text.translate(_FOLD).split()


class _Block:
    """Postings of some texts in memory."""

    def __init__(self):
        self.groups: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: bytes, source: bytes, words: list[bytes]) -> None:
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(n)
        n.update(words)
        docs.update(set(words))
        self.size += len(n) - before

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The block as a term-sorted run per shard, in chunks; the block is empty afterwards.
        The empty term marks each group."""
        names = sorted({source for _, source in self.groups})
        number = {x: i for i, x in enumerate(names)}
        by_lang: dict[bytes, list] = {}
        for (lang, source), held in self.groups.items():
            by_lang.setdefault(lang, []).append((number[source], *held))
        self.__init__()
        keys: list[bytes] = []
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for lang in sorted(by_lang, key=lambda x: x + _END):
            head = lang + _END
            found = sorted(set().union(*(n for _, n, _ in by_lang[lang])))
            place = dict(zip(found, range(len(keys) + 1, len(keys) + 1 + len(found))))
            mark = len(keys)
            keys.append(head)
            keys += [head + t for t in found]
            for source, n, docs in by_lang[lang]:
                at = np.fromiter(map(place.__getitem__, n), np.int64, len(n))
                for col, x in zip(columns, (at, np.full(len(n), source), np.fromiter(n.values(), np.int64, len(n)),
                                            np.fromiter(map(docs.__getitem__, n), np.int64, len(n)))):
                    col.append(x)
                for col, x in zip(columns, (mark, source, 0, 0)):
                    col.append(np.array([x], np.int64))
        if not keys:
            return
        place, source, n, docs = (np.concatenate(c) for c in columns)
        shard = np.fromiter((zlib.crc32(k) % shards for k in keys), np.int64, len(keys))
        order = np.lexsort((source, place, shard[place]))
        place, source, n, docs = place[order], source[order], n[order], docs[order]
        # Keys by shard, ascending in each, and where their postings end.
        by_shard = np.argsort(shard, kind="stable")
        count = np.bincount(place, minlength=len(keys))
        ends = np.cumsum(count[by_shard])
        bounds = np.searchsorted(shard[by_shard], np.arange(shards + 1))
        rows: list[tuple] = []
        for s in range(shards):
            i, stop = int(bounds[s]), int(bounds[s + 1])
            while i < stop:
                a = int(ends[i - 1]) if i else 0
                j = int(np.searchsorted(ends, a + CHUNK_POSTINGS, side="left")) + 1
                j = min(stop, i + CHUNK_KEYS, j)
                b = int(ends[j - 1])
                chunk = Chunk([keys[k] for k in by_shard[i:j].tolist()], ends[i:j] - a, names, source[a:b], n[a:b], docs[a:b])
                rows.append((s, *chunk.packed()))
                i = j
                if len(rows) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RUN_SCHEMA)], schema=_RUN_SCHEMA)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RUN_SCHEMA)], schema=_RUN_SCHEMA)


_RUN_SCHEMA = pa.schema([("shard", pa.int32()), *((c.split()[0], pa.binary()) for c in _RUN.split(", ")[1:])])


def _join(parts: list[Chunk]) -> Chunk:
    """One chunk of the parts' keys, equal postings added up; sources of a key ascend."""
    keys = sorted(set().union(*(p.keys for p in parts)))
    names = sorted(set().union(*(p.names for p in parts)))
    key_no, name_no = ({x: i for i, x in enumerate(xs)} for xs in (keys, names))
    rank = np.concatenate([np.repeat(np.fromiter(map(key_no.__getitem__, p.keys), np.int64, len(p.keys)),
                                     np.diff(p.ends, prepend=0)) for p in parts])
    code = np.concatenate([np.array([name_no[x] for x in p.names])[p.at] for p in parts])
    value = rank * len(names) + code
    order = np.argsort(value, kind="stable")
    value = value[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    n, docs = (np.add.reduceat(np.concatenate(x)[order], first) for x in ([p.n for p in parts], [p.docs for p in parts]))
    rank, code = np.divmod(value[first], len(names))
    return Chunk(keys, np.searchsorted(rank, np.arange(len(keys)), side="right"), names, code, n, docs)


def merged(chunks: Iterator[tuple[bytes, bytes, Callable[[], Chunk]]]) -> Iterator[Chunk]:
    """Heap merge of the chunks (first key, last key, opener) of any number of runs, given by
    ascending first key: chunks of distinct, ascending keys. The heap holds the open chunks by last
    key; the half that ends first is used up at a time, together with what the others hold up to
    there and the chunks that start before."""
    heap: list[tuple[bytes, int, Chunk]] = []
    waiting, opened = next(chunks, None), 0
    while heap or waiting:
        if not heap:
            heap, waiting = [(waiting[1], opened, waiting[2]())], next(chunks, None)
            opened += 1
        limit = heapq.nsmallest((len(heap) + 1) // 2, heap)[-1][0]
        while waiting and waiting[0] <= limit:
            heapq.heappush(heap, (waiting[1], opened, waiting[2]()))
            waiting, opened = next(chunks, None), opened + 1
        parts = []
        while heap and heap[0][0] <= limit:
            parts.append(heapq.heappop(heap)[2])
        for i, (last, serial, chunk) in enumerate(heap):
            cut = bisect.bisect_right(chunk.keys, limit)
            if cut:
                parts.append(chunk.part(0, cut))
                heap[i] = (last, serial, chunk.part(cut, len(chunk.keys)))
        yield _join(parts)


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, sources, counts``: per kept term the sources that hold it and how often; the
    empty term lists all sources of a language (counts 0). Written in the shared folder."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for b in slices(batches):
            for lang, source, text in zip(*(b.column(i).cast(pa.binary()).to_pylist() for i in range(3))):
                block.add(lang, source, terms(text))
                if block.size >= BLOCK_POSTINGS:
                    yield from block.run(shards)
        yield from block.run(shards)
        release_memory()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in merged(_chunks(batches)):
            start = np.append(0, chunk.ends[:-1])
            marks = np.fromiter((k.endswith(_END) for k in chunk.keys), bool, len(chunk.keys))
            keep = np.flatnonzero((np.add.reduceat(chunk.docs, start) >= min_docs) | marks)
            if not len(keep):
                continue
            size = (chunk.ends - start)[keep]
            at = np.repeat(start[keep] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            offsets = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            lang, term = zip(*(chunk.keys[i].split(_END) for i in keep.tolist()))
            names = pa.array(chunk.names, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.binary()).cast(pa.string()) for x in (lang, term)),
                 pa.ListArray.from_arrays(offsets, names.take(pa.array(chunk.at[at]))),
                 pa.ListArray.from_arrays(offsets, pa.array(chunk.n[at]))], names=["lang", "term", "sources", "counts"])
        release_memory()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    runs = docs.select(*text).mapInArrow(index, _RUN)
    ordered = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("first")
    return written(ordered.mapInArrow(merge, _FREQUENCY), "term-frequencies")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes, Callable[[], Chunk]]]:
    for b in batches:
        for i in range(b.num_rows):
            first, last, *packed = (b.column(c)[i].as_py() for c in range(1, b.num_columns))
            yield first, last, functools.partial(Chunk.unpacked, *packed)


def _probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact beyond 64 bits; null without terms."""
    big = lambda c: c.cast("decimal(19,0)")
    over = F.when(kept > 0, big(total + 2 * kept))
    return F.lit(1) + F.call_function("div", F.lit(10 ** 9).cast("decimal(10,0)") * big(count + 2), over)


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most 10^9 + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _two_sided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, ids, p, zero) of terms to sums per pair of ids (lo, hi)."""

    def gap(p, q):
        return (p - q) * (p - q) // (p + q)

    sums: dict[tuple[str, int, int], int] = {}

    def flush() -> pa.RecordBatch:
        lang, lo, hi = zip(*sums)
        batch = pa.RecordBatch.from_arrays([pa.array(lang), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
                                            pa.array(list(sums.values()), pa.int64())], names=["lang", "lo", "hi", "value"])
        sums.clear()
        return batch

    for b in batches:
        lists = [b.column(i) for i in (1, 2, 3)]
        size = np.diff(lists[0].offsets.to_numpy())
        start = np.cumsum(size) - size
        ids, p, zero = (x.flatten().to_numpy() for x in lists)
        lang = np.array(b.column(0).to_pylist(), dtype=object)
        kinds, code = np.unique(lang, return_inverse=True)
        wide = int(ids.max(initial=0)) + 1
        # Each posting with the later ones of its term; postings are ordered by id.
        row = np.repeat(np.arange(len(size)), size)
        later = (start + size)[row] - np.arange(len(ids)) - 1
        cuts = np.searchsorted(np.cumsum(later), np.arange(PAIR_BLOCK, int(later.sum()) + PAIR_BLOCK, PAIR_BLOCK))
        at = 0
        for cut in [*(cuts + 1).tolist(), len(ids)]:
            n = later[at:cut]
            a = np.repeat(np.arange(at, at + len(n)), n)
            i = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            at = cut
            if not len(a):
                continue
            value = gap(p[a], p[i]) - gap(p[a], zero[i]) - gap(zero[a], p[i]) + gap(zero[a], zero[i])
            key = (code[row[a]] * wide + ids[a]) * wide + ids[i]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for k, v in zip(key[first].tolist(), np.add.reduceat(value[order], first).tolist()):
                k = (kinds[k // wide ** 2], k // wide % wide, k % wide)
                sums[k] = sums.get(k, 0) + v
            if len(sums) >= PAIR_BLOCK:
                yield flush()
    if sums:
        yield flush()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) of ``docs(lang, source,
    text)``: part ``pair`` ranks the language's other sources by the summed gaps over all kept terms,
    part ``term`` the ``top_terms`` terms more probable in the group than in the language.

    Null lang, source and text are ''. Groups without terms take part (all counts 0); a language
    without kept terms has pairs of value 0. Repeated rows count each. Ties rank by item (UTF-8).
    Other columns are not read; an empty table gives no rows.
    """
    freq = frequencies(docs, min_docs)
    kept = freq.where("term <> ''")
    postings = kept.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", "term", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.expr(
        "aggregate(counts, 0L, (a, x) -> a + x)")).alias("lang_total"))
    groups = (freq.where("term = ''").select("lang", F.explode("sources").alias("source"))
              .join(totals, ["lang", "source"], "left").join(bounded_broadcast(langs), "lang", "left")
              .na.fill(0, ["total", "kept", "lang_total"]))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = written(groups.withColumn("id", number).withColumn(
        "zero", _probability(F.lit(0), F.col("total"), F.col("kept"))), "groups")

    # Per posting its probability; rows of one term stay together for the two-sided sums.
    near = postings.join(bounded_broadcast(groups), ["lang", "source"])
    near = near.withColumn("p", _probability(F.col("n"), F.col("total"), F.col("kept")))

    lang_n = kept.select("lang", "term", F.expr("aggregate(counts, 0L, (a, x) -> a + x)").alias("lang_n"),
                         F.arrays_zip("sources", "counts").alias("x"))
    found = (lang_n.select("lang", "term", "lang_n", F.explode("x").alias("x"))
             .select("lang", "term", "lang_n", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
             .join(bounded_broadcast(groups), ["lang", "source"])
             .withColumn("p", _probability(F.col("n"), F.col("total"), F.col("kept")))
             .withColumn("q", _probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
             .where("p > q"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_terms = (found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                             _gap(F.col("p"), F.col("q")).alias("value"))
                .withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= top_terms))

    # All pairs of a language's sources are the result itself.
    b = groups.select("lang", F.col("id").alias("id_b"), F.col("zero").alias("zero_b"))
    base = (groups.join(bounded_broadcast(b), "lang").where("id < id_b")
            .select("lang", F.col("id").alias("lo"), F.col("id_b").alias("hi"), F.when(
                F.col("kept") > 0, F.col("kept") * _gap(F.col("zero"), F.col("zero_b"))).otherwise(0).alias("value")))
    histogram = near.groupBy("lang", "id", "zero", "p").agg(F.count("*").alias("n"))
    one = (histogram.join(bounded_broadcast(b), "lang").where("id <> id_b")
           .groupBy("lang", F.least("id", "id_b").alias("lo"), F.greatest("id", "id_b").alias("hi"))
           .agg(F.sum(F.col("n") * (_gap(F.col("p"), F.col("zero_b")) - _gap(F.col("zero"), F.col("zero_b"))))
                .alias("value")))
    of_lang = groups.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct(
        "source", F.struct("id", "zero", "total", "kept")))).alias("known"))
    rows = kept.join(bounded_broadcast(of_lang), "lang").where(F.size("sources") > 1)
    # Sources of a row and their numbers ascend alike.
    rows = rows.select("lang", F.transform("sources", lambda s: F.col("known")[s]).alias("g"), "counts")
    rows = rows.select("lang", F.col("g.id").alias("ids"), F.zip_with("counts", "g", lambda n, g: _probability(
        n, g["total"], g["kept"])).alias("p"), F.col("g.zero").alias("zero"))
    both = rows.mapInArrow(_two_sided, "lang string, lo long, hi long, value long")
    pairs = base.unionByName(one).unionByName(both).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("lo").alias("id"), F.col("hi").alias("other")),
                              F.struct(F.col("hi").alias("id"), F.col("lo").alias("other"))))
    names = groups.select("lang", "id", "source")
    of_pairs = (pairs.select("lang", "value", sides.alias("s")).select("lang", "value", "s.*")
                .join(bounded_broadcast(names), ["lang", "id"])
                .join(bounded_broadcast(names.select("lang", F.col("id").alias("other"), F.col("source").alias("item"))),
                      ["lang", "other"])
                .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
                .withColumn("rank", F.row_number().over(best).cast("int")))
    return of_pairs.unionByName(of_terms)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
tok AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM tok GROUP BY lang, source, term),
dense AS (SELECT grp.lang, grp.source, kept.term, kept.lang_n, coalesce(n, 0)::HUGEINT AS n
  FROM grp JOIN kept USING (lang) LEFT JOIN cnt ON cnt.lang = grp.lang AND cnt.source = grp.source AND cnt.term = kept.term),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM dense GROUP BY lang, source),
prob AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v.v))::HUGEINT AS p,
  (1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v.v))::HUGEINT AS q
  FROM dense JOIN tot USING (lang, source) JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM prob a JOIN prob b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
found AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM prob WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
  PARTITION BY lang, source ORDER BY value DESC, item COLLATE "C") AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (
  PARTITION BY lang, source ORDER BY value DESC, item COLLATE "C") FROM found)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
