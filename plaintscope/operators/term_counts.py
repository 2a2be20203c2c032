"""Counts per term (T3-T6, E12) of rows that hold their words as a list.

A row per (document, term), dealt by the term and looked up in a hash table, costs far more than the
term itself: it was most of the work of the theme and vocabulary queries. Here a task numbers the
words of some rows, so that a pair of words is one integer, and adds up equal ones by sorting.
What it found is dealt by Spark as one row per group and bucket, with the terms and their numbers
in it. There terms are sorted by a 64-bit hash; those of one hash are compared as texts, and if two
differ, terms are numbered as texts instead.

The bucket follows from the term alone, so a hot group (a product) gathers in no task. Every term
of every row is counted. A task holds about ``BLOCK`` words at a time (or one row, if longer), and
after the exchange ``BLOCK`` terms or one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

BLOCK = 1 << 19

# Buckets at least; more where the session has many shuffle partitions.
BUCKETS = 1024

# Lists go to the workers some megabytes at a time, unless the session has its own bound.
ARROW_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    conf, key = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(ARROW_ROWS))


def count_terms(rows: DataFrame, groups: list[str], sums: list[str] = (), unigrams: bool = False,
                at_least: int = 1, block: int = BLOCK, buckets: int | None = None) -> DataFrame:
    """One row per ``groups`` and ``term`` that at least ``at_least`` rows hold: ``doc_freq`` (rows with the
    term) and ``sums``, whole numbers of a row added up over the rows with the term. Terms are the pairs
    of neighbours in the list ``words``; with ``unigrams`` the words too, and ``term_freq`` (occurrences). A word is not empty and holds no blank, as those of ``text.tokens``."""
    small_batches(rows.sparkSession)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = buckets or min(1 << 16, max(BUCKETS, 8 * parts))
    own = [f for f in rows.schema.fields if f.name in groups]
    names = ["doc_freq", *["term_freq"] * unigrams, *sums]
    k = 2 + len(names)  # numbers of a term: its hash, its length and those
    table = np.random.default_rng(0).integers(0, 1 << 63, 256, np.uint64)
    base, mix = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)

    def hashes_of(words: pa.Array) -> np.ndarray:
        """Per word the sum of a number of each byte times a power of ``base`` that tells its place."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        up, down = (np.cumprod(np.r_[np.uint64(1), np.full(len(data), x, np.uint64)])
                    for x in (base, pow(base, -1, 1 << 64)))
        upto = np.r_[np.uint64(0), np.cumsum(table[data] * up[:-1])]
        return np.diff(upto[ends]) * down[ends[:-1]]

    def group_codes(cols, n: int) -> np.ndarray:
        """A number per row that is the same for equal groups."""
        code = np.zeros(n, np.int64)
        for c in cols:
            d = c.dictionary_encode("encode")
            code = np.unique(code * len(d.dictionary) + d.indices.to_numpy(), return_inverse=True)[1]
        return code

    def starts_of(key: np.ndarray) -> np.ndarray:
        """Where a new value starts in an array that is not empty."""
        return np.flatnonzero(np.r_[True, key[1:] != key[:-1]])

    def together(batches) -> pa.RecordBatch:
        return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]

    def found(batch: pa.RecordBatch):
        """The terms of some rows, as one row per group and bucket."""
        lists = batch.column("words")
        words = pc.list_flatten(lists).dictionary_encode()
        coded, texts = words.indices.to_numpy().astype(np.int64), words.dictionary
        bits = len(texts).bit_length()  # of a word's number, or of one more for no second word
        low = (1 << bits) - 1
        if len(batch) > 1 and len(batch) << 2 * bits >> 62:
            half = len(batch) // 2
            yield from found(batch.slice(0, half))
            yield from found(batch.slice(half))
            return
        row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        at_word = (row << 2 * bits) + (coded << bits)
        key = (at_word[:-1] + coded[1:])[row[1:] == row[:-1]]
        if unigrams:
            key = np.concatenate((key, at_word + len(texts)))
        if not len(key):
            return
        key.sort()
        at = starts_of(key)
        times = np.diff(np.r_[at, len(key)])
        key = key[at]
        row = key >> 2 * bits
        lead = [batch.column(g) for g in groups]
        group = group_codes(lead, len(batch))
        key += (group[row] - row) << 2 * bits
        order = np.argsort(key)
        at = starts_of(key[order])
        first = order[at]
        numbers = [np.diff(np.r_[at, len(order)])]
        numbers += [np.add.reduceat(x[order], at) for x in
                    [*[times] * unigrams, *[batch.column(s).to_numpy()[row] for s in sums]]]
        key, first = key[first], row[first]
        one, two = (key >> bits) & low, key & low
        hashes = np.r_[hashes_of(texts), np.uint64(0)]
        hashed = (hashes[one] * mix + hashes[two]) * np.uint64(base)
        hashed ^= hashed >> np.uint64(32)
        group, bucket = group[first], (hashed % np.uint64(n_buckets)).astype(np.uint16)
        order = np.lexsort((bucket, group.astype(np.uint16) if group.max() < 1 << 16 else group))
        at = starts_of((group * n_buckets + bucket)[order])
        ends = np.r_[at, len(order)]
        seconds = pa.concat_arrays([texts, pa.nulls(1, texts.type)]).take(pa.array(two[order]))
        terms = pc.binary_join_element_wise(texts.take(pa.array(one[order])), seconds, " ", null_handling="skip")
        upto = np.frombuffer(terms.buffers()[1], np.int32)
        data = np.empty((len(order), k), np.int64)
        for i, x in enumerate([hashed.view(np.int64), *numbers]):
            data[:, i + (i > 0)] = x[order]
        data[:, 1] = np.diff(upto[:len(order) + 1])
        leader = order[at]

        def cut(offsets, values):
            return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int32)), values])

        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[leader].astype(np.int32)), *[c.take(pa.array(first[leader])) for c in lead],
             cut(upto[ends], terms.buffers()[2]), cut(8 * k * ends, pa.py_buffer(data))],
            names=["_bucket", *groups, "_terms", "_numbers"])

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(batch):  # some rows with ``block`` words in all
                before = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, before + block - n, "right")))
                held.append(batch.slice(at, to - at))
                n += int(upto[to - 1]) - before
                if n >= block or to < len(batch):
                    yield from found(together(held))
                    held, n = [], 0
                at = to
        if held:
            yield from found(together(held))

    def total(batches):
        """The rows of whole buckets as one row per group and term."""
        batch = together(batches)
        data = b"".join(batch.column("_terms").to_pylist())
        numbers = np.frombuffer(b"".join(batch.column("_numbers").to_pylist()), np.int64).reshape(-1, k)
        upto = np.r_[0, np.cumsum(numbers[:, 1])]
        terms = pa.Array.from_buffers(pa.large_string(), len(numbers), [None, pa.py_buffer(upto), pa.py_buffer(data)])
        lead = [batch.column(g) for g in groups]
        row = np.repeat(np.arange(len(batch)), pc.binary_length(batch.column("_numbers")).to_numpy() // (8 * k))
        group = group_codes(lead, len(batch))[row]

        def sorted_by(key):
            order = np.argsort(key)
            return order, starts_of(key[order])

        order, at = sorted_by(numbers[:, 0] + (group << 32) * 0x9E3779B1)
        more = np.ones(len(order), bool)
        more[at] = False
        same, other = np.repeat(order[at], np.diff(np.r_[at, len(order)]))[more], order[more]
        if (group[same] != group[other]).any() or not pc.all(pc.equal(terms.take(pa.array(same)), terms.take(pa.array(other)))).as_py():
            codes = terms.dictionary_encode()
            order, at = sorted_by(group * len(codes.dictionary) + codes.indices.to_numpy())
        sums_of = [np.add.reduceat(numbers[order, i], at) for i in range(2, k)]
        kept = sums_of[0] >= at_least
        first = order[at][kept]
        term = terms.take(pa.array(first)).cast(pa.string())
        yield from pa.Table.from_arrays(
            [*[c.take(pa.array(row[first])) for c in lead], term, *[pa.array(x[kept]) for x in sums_of]],
            names=[*groups, "term", *names]).to_batches()

    def add_up(batches):
        """The rows come in the order of their buckets; the last bucket of a batch may go on in the next."""
        held, n, last = [], 0, None
        for batch in batches:
            at = batch.column("_bucket").to_numpy()
            upto = np.cumsum(pc.binary_length(batch.column("_numbers")).to_numpy()) // (8 * k)
            begin = 0
            while begin < len(batch):  # one bucket after the other
                to = int(np.searchsorted(at, at[begin], "right"))
                if n >= block and at[begin] != last:
                    yield from total(held)
                    held, n = [], 0
                held.append(batch.slice(begin, to - begin))
                n += int(upto[to - 1]) - (int(upto[begin - 1]) if begin else 0)
                begin, last = to, at[begin]
        if held:
            yield from total(held)

    numbers = [StructField(c, LongType()) for c in names]
    block_row = StructType([StructField("_bucket", IntegerType()), *own, StructField("_terms", BinaryType()),
                            StructField("_numbers", BinaryType())])
    dealt = (rows.select(*groups, "words", *[F.col(s).cast("long").alias(s) for s in sums]).mapInArrow(pack, block_row)
             .repartition("_bucket").sortWithinPartitions("_bucket"))
    return dealt.mapInArrow(add_up, StructType([*own, StructField("term", StringType()), *numbers]))
