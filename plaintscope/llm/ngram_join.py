"""Exact n-gram Jaccard join by prefix filters under two global token orders.

A text's tokens are its distinct five-word shingles (64-bit hashes); texts of equal sets are
one class, and classes are compared. Two sets link when 100 |x & y| >= 75 |x | y|, so x may
hold at most n // 4 tokens that y lacks.

1. First order: tokens by hash. Each class posts its first n // 4 + l(n) tokens, with
   l(n) = 1 + n // 16. Linked sets share at least l(smaller n) tokens within both prefixes,
   so a class with fewer prefix tokens that another class posts as well is out. Most
   texts end here, having sent a third of their tokens once.
2. Second order: tokens by document frequency among the classes left, then hash. A class
   with fewer than ceil(3 n / 4) tokens of frequency 2 or more is out; the others post their
   rarest tokens up to n - ceil(3 n / 4) + 1. What passes both filters and shares a token
   here is a candidate.
3. No pairs are listed within a posting list: its most central member (largest share of
   common tokens) becomes the centre and each other member is compared with it. Members
   that share a list thus share a centre.
4. A centre all of whose members are linked is finished. Else the members outside the
   centre's component meet, in blocks of sets, the members of other components. A pair is
   verified if it passes the filters of both orders: it shares a list of the second order, and l
   tokens of both prefixes under the first; sizes and the triangle inequality of the Jaccard
   distance (to the centre) rule out further pairs.

A verification is an exact intersection of whole sets; members are verified against their centre
at once, since the distance to it serves as the pivot of step 4. A class whose texts are thousands of
exact copies posts once per batch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage
from .common import connected_components, mix64, written
from .shingles import column_sets
from .suffix_family import _released

LINK, OF = 75, 100  # OF * |x & y| >= LINK * |x | y|; the prefix lengths below fit 3 / 4
SALT_MEMBERS = 256
BLOCK = 1024


def _slack(n):
    return 1 + n // 16


def _common_least(n):
    """Fewest tokens a set of n shares with one it links to."""
    return -(-3 * n // 4)


def _fingerprint(s: np.ndarray) -> int:
    """64 bits of a set, from two order-free digests of its tokens and its size."""
    m = mix64(s)
    x = np.array([np.add.reduce(m), np.bitwise_xor.reduce(m), len(s)], dtype=np.uint64)
    return int(np.bitwise_xor.reduce(mix64(x + _PLACES)).view(np.int64))


_PLACES = mix64(np.array([1, 2, 3], dtype=np.uint64))


@_released
def _post_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (token spread by id, n set) and of first-order postings (n null)."""
    for b in batches:
        docs = b.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
        ns, fps, tokens, owners, seen = [], [], [], [], set()
        for s in column_sets(b.column("text")):
            n = len(s)
            fp = _fingerprint(s) if n else 0
            ns.append(n)
            fps.append(fp)
            if n and fp not in seen:
                seen.add(fp)
                part = _prefix(s)
                tokens.append(part)
                owners.append(np.full(len(part), fp, dtype=np.int64))
        yield pa.RecordBatch.from_pydict({
            "token": mix64(docs.astype(np.uint64)).view(np.int64), "fp": pa.array(fps, pa.int64()),
            "doc": docs, "n": pa.array(ns, pa.int32()), "h": b.column("h")})
        if tokens:
            token, owner = np.concatenate(tokens).view(np.int64), np.concatenate(owners)
            for i in range(0, len(token), 500_000):
                t, o = token[i:i + 500_000], owner[i:i + 500_000]
                yield pa.RecordBatch.from_pydict({"token": t, "fp": o, "doc": pa.nulls(len(t), pa.int64()),
                                                  "n": pa.nulls(len(t), pa.int32()), "h": pa.nulls(len(t), pa.int64())})


def _shared(token: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, fp) rows of tokens that two or more classes hold, and the number."""
    o = np.lexsort((fp, token))
    token, fp = token[o], fp[o]
    if len(token):
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (fp[1:] != fp[:-1])
        token, fp = token[new], fp[new]
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        group = np.cumsum(first) - 1
        df = np.bincount(group)[group]
        keep = df > 1
        return token[keep], fp[keep], df[keep]
    return token, fp, np.empty(0, np.int64)


@_released
def _count_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as they are; per class how many of its tokens here others post as well."""
    tokens, fps = [], []
    for b in batches:
        doc = b.column("n").is_valid()
        d = b.filter(doc)
        if d.num_rows:
            yield pa.RecordBatch.from_pydict({"fp": d.column("fp"), "doc": d.column("doc"), "n": d.column("n"),
                                              "h": d.column("h"), "hits": pa.nulls(d.num_rows, pa.int32())})
        p = b.filter(pc.invert(doc))
        tokens.append(p.column("token").to_numpy())
        fps.append(p.column("fp").to_numpy())
    if tokens:
        _, fp, _ = _shared(np.concatenate(tokens), np.concatenate(fps))
        fp, hits = np.unique(fp, return_counts=True)
        yield pa.RecordBatch.from_pydict({"fp": fp, "doc": pa.nulls(len(fp), pa.int64()),
                                          "n": pa.nulls(len(fp), pa.int32()), "h": pa.nulls(len(fp), pa.int64()),
                                          "hits": hits.astype(np.int32)})


@_released
def _post_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column("fp").to_numpy()
        tokens, owners, sizes, held = [], [], [], 0

        def out():
            return pa.RecordBatch.from_pydict({
                "token": np.concatenate(tokens).view(np.int64), "fp": np.repeat(owners, sizes),
                "n": np.repeat(sizes, sizes).astype(np.int32)})

        for i, s in enumerate(column_sets(b.column("text"))):
            tokens.append(s)
            owners.append(fps[i])
            sizes.append(len(s))
            held += len(s)
            if held > 500_000:
                yield out()
                tokens, owners, sizes, held = [], [], [], 0
        if held:
            yield out()


@_released
def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(batches), schema=_POSTING)
    size = dict(zip(t.column("fp").to_pylist(), t.column("n").to_pylist())) if t.num_rows < 50_000 else None
    token, fp, df = _shared(t.column("token").to_numpy(), t.column("fp").to_numpy())
    if size is not None:
        n = np.array([size[x] for x in fp.tolist()], dtype=np.int32)
    else:
        all_fp, first = np.unique(t.column("fp").to_numpy(), return_index=True)
        n = t.column("n").to_numpy()[first][np.searchsorted(all_fp, fp)]
    for i in range(0, len(token), 500_000):
        c = slice(i, i + 500_000)
        yield pa.RecordBatch.from_pydict({"fp": fp[c], "token": token[c], "df": df[c].astype(np.int64), "n": n[c]})


_POSTING = pa.schema([("token", pa.int64()), ("fp", pa.int64()), ("n", pa.int32())])
_FREQUENCY = pa.schema([("fp", pa.int64()), ("token", pa.int64()), ("df", pa.int64()), ("n", pa.int32())])


def _post_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second-order prefixes of the classes with enough common tokens."""
    t = pa.Table.from_batches(list(batches), schema=_FREQUENCY)
    if not t.num_rows:
        return
    fp, token, df, n = (t.column(c).to_numpy() for c in ("fp", "token", "df", "n"))
    o = np.lexsort((token, df, fp))
    fp, token, n = fp[o], token[o], n[o].astype(np.int64)
    first = np.ones(len(fp), bool)
    first[1:] = fp[1:] != fp[:-1]
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, len(fp)))
    group = np.cumsum(first) - 1
    rank = np.arange(len(fp)) - begin[group]
    least = _common_least(n)
    keep = (count[group] >= least) & (rank < count[group] - least + 1)
    yield pa.RecordBatch.from_pydict({"token": token[keep], "fp": fp[keep],
                                      "share": (count[group] / n)[keep]})


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(batches), schema=pa.schema(
        [("token", pa.int64()), ("fp", pa.int64()), ("share", pa.float64())]))
    if not t.num_rows:
        return
    token, fp, share = (t.column(c).to_numpy() for c in ("token", "fp", "share"))
    o = np.lexsort((fp, -share, token))
    token, fp = token[o], fp[o]
    first = np.ones(len(token), bool)
    first[1:] = token[1:] != token[:-1]
    centre = fp[np.flatnonzero(first)][np.cumsum(first) - 1]
    pairs = np.unique(np.stack([centre[~first], fp[~first]], axis=1), axis=0)
    for i in range(0, len(pairs), 500_000):
        yield pa.RecordBatch.from_pydict({"c": pairs[i:i + 500_000, 0].copy(), "m": pairs[i:i + 500_000, 1].copy()})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps, raws, size = [], [], 0
        names = b.column("fp").to_pylist()
        for fp, s in zip(names, column_sets(b.column("text"))):
            fps.append(fp)
            raws.append(s.tobytes())
            size += len(raws[-1])
            if size > 8_000_000:
                yield pa.RecordBatch.from_pydict({"fp": pa.array(fps, pa.int64()), "tokens": pa.array(raws, pa.binary())})
                fps, raws, size = [], [], 0
        if fps:
            yield pa.RecordBatch.from_pydict({"fp": pa.array(fps, pa.int64()), "tokens": pa.array(raws, pa.binary())})


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = [len(s) for s in column_sets(b.column("text"))]
        yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(len(n), pa.int64()), "n_shingles": pa.array(n, pa.int64()),
                                          "component_id": pa.nulls(len(n), pa.int64())})


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _prefix(s: np.ndarray) -> np.ndarray:
    """The tokens a set posts under the first order."""
    return s[:len(s) // 4 + _slack(len(s))]


def _compare_with_centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (c, salt, member first): the centre's set, then its members'."""
    at, centre = None, None
    for b in batches:
        out = {"c": [], "m": [], "common": [], "total": []}
        for c, salt, is_member, fp, raw in zip(*(b.column(k).to_pylist() for k in ("c", "salt", "is_member", "fp", "tokens"))):
            s = np.frombuffer(raw, dtype=np.uint64)
            if not is_member:
                at, centre = (c, salt), s
                continue
            assert at == (c, salt)
            n = _common(centre, s)
            for k, v in zip(out, (c, fp, n, len(s) + len(centre) - n)):
                out[k].append(v)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (c, yb, mb, side): outside members, then the members of a block."""
    at, outside, members = None, [], []

    def links():
        if not outside or not members:
            return
        sets = [np.frombuffer(r[3], dtype=np.uint64) for r in members]
        bounds = np.cumsum([0] + [len(s) for s in sets])
        every = np.concatenate(sets)
        fps = np.array([r[0] for r in members])
        comp = np.array([r[1] for r in members])
        dist = np.array([r[2] for r in members])
        size = np.diff(bounds)
        heads = [_prefix(s) for s in sets]
        head_bounds = np.cumsum([0] + [len(h) for h in heads])
        every_head = np.concatenate(heads)
        u, v = [], []
        for fp, own, d, raw in outside:
            s = np.frombuffer(raw, dtype=np.uint64)
            maybe = np.flatnonzero((comp != own) & (np.abs(dist - d) <= 0.25 + 1e-9)
                                   & (OF * np.minimum(size, len(s)) >= LINK * np.maximum(size, len(s))))
            if len(maybe):  # both prefixes under the first order must share enough tokens
                head = _prefix(s)
                if len(maybe) * 4 < len(sets):
                    n = np.array([_common(head, heads[i]) for i in maybe])
                else:
                    where = np.searchsorted(head, every_head)
                    where[where == len(head)] = 0
                    n = np.add.reduceat((head[where] == every_head).astype(np.int64), head_bounds[:-1])[maybe]
                maybe = maybe[n >= _slack(np.minimum(size[maybe], len(s)))]
            if not len(maybe):
                continue
            if len(maybe) * 4 < len(sets):
                n = np.array([_common(s, sets[i]) for i in maybe])
            else:
                where = np.searchsorted(s, every)
                where[where == len(s)] = 0
                n = np.add.reduceat((s[where] == every).astype(np.int64), bounds[:-1])[maybe]
            hit = maybe[OF * n >= LINK * (size[maybe] + len(s) - n)]
            u += [fp] * len(hit)
            v += fps[hit].tolist()
        if u:
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("c", "yb", "mb", "side", "m", "comp", "dist", "tokens")]
        for c, yb, mb, side, m, comp, dist, raw in zip(*cols):
            if (c, yb, mb) != at:
                yield from links()
                at, outside, members = (c, yb, mb), [], []
            (members if side else outside).append((m, comp, dist, raw))
    yield from links()


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, text, h``: rows are told apart by id and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("h"))


def shingle_classes(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``texts(doc, text, h)`` to its documents ``(doc, n, fp, h)`` and the classes that pass
    the first filter ``(fp, doc, h)`` with their smallest document."""
    first = (texts.mapInArrow(_post_first, "token long, fp long, doc long, n int, h long")
             .repartition("token").mapInArrow(_count_first, "fp long, doc long, n int, h long, hits int"))
    first = written(first, "jaccard-first")
    docs = first.where("n is not null").select("doc", "n", "fp", "h")
    classes = (docs.where("n > 0").groupBy("fp").agg(F.min(F.struct("doc", "h")).alias("at"), F.min("n").alias("n"))
               .select("fp", "at.doc", "at.h", "n"))
    hits = first.where("hits is not null").groupBy("fp").agg(F.sum("hits").alias("hits"))
    left = (classes.join(hits, "fp").where(F.expr("hits >= 1 + ((3 * n + 3) div 4) div 16"))
            .select("fp", "doc", "h"))
    return docs, cut_lineage(left)


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    # An id may name several texts; rows of one id and text hold the same set.
    return texts.join(bounded_broadcast(classes), ["doc", "h"]).select("fp", "text")


def class_links(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(u, v)`` between classes that connect every component completely."""
    posted = (_texts_of(texts, classes).mapInArrow(_post_all, "token long, fp long, n int")
              .repartition("token").mapInArrow(_frequencies, "fp long, token long, df long, n int")
              .repartition("fp").mapInArrow(_post_second, "token long, fp long, share double"))
    stars = cut_lineage(posted.repartition("token").mapInArrow(_stars, "c long, m long").distinct())
    wanted = stars.select(F.explode(F.array("c", "m")).alias("fp")).distinct()
    sets = written(_texts_of(texts, classes.join(wanted, "fp", "left_semi"))
                   .mapInArrow(_sets, "fp long, tokens binary"), "jaccard-sets")

    per = stars.groupBy("c").agg(F.ceil(F.count("*") / SALT_MEMBERS).cast("int").alias("salts"))
    members = (stars.join(per, "c").withColumn("salt", F.pmod(F.xxhash64("m"), F.col("salts")).cast("int"))
               .select("c", "salt", F.lit(True).alias("is_member"), F.col("m").alias("fp")).join(sets, "fp"))
    centres = (per.select("c", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
               .select("c", "salt", F.lit(False).alias("is_member"), F.col("c").alias("fp")).join(sets, "fp"))
    cols = ["c", "salt", "is_member", "fp", "tokens"]
    compared = cut_lineage(members.select(cols).unionByName(centres.select(cols))
                           .repartition("c", "salt").sortWithinPartitions("c", "salt", "is_member")
                           .mapInArrow(_compare_with_centre, "c long, m long, common long, total long"))
    linked = compared.where(f"{OF} * common >= {LINK} * total").select(F.col("c").alias("u"), F.col("m").alias("v"))
    comps = connected_components(linked)

    # Centres with members in other components, and two members at least.
    at = comps.select(F.col("id"), F.col("component_id").alias("comp"))
    inside = (compared.select("c", "m", (1 - F.col("common") / F.col("total")).alias("dist"))
              .unionByName(per.select("c", F.col("c").alias("m"), F.lit(0.0).alias("dist")))
              .join(at.withColumnRenamed("id", "m"), "m", "left").withColumn("comp", F.coalesce("comp", "m"))
              .join(at.select(F.col("id").alias("c"), F.col("comp").alias("home")), "c", "left")
              .withColumn("home", F.coalesce("home", "c")))
    inside = cut_lineage(inside)
    open_ = (inside.groupBy("c").agg(F.count("*").alias("n"), F.count_if(F.col("comp") != F.col("home")).alias("k"))
             .where("n > 2 and k > 0")
             .select("c", F.ceil(F.col("k") / BLOCK).cast("int").alias("kb"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")))
    inside = inside.join(open_, "c")
    block = lambda n: F.pmod(F.xxhash64("m"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ys = (inside.where("comp <> home").select("c", block("kb").alias("yb"), every("nb").alias("mb"),
                                              F.lit(0).alias("side"), "m", "comp", "dist"))
    ms = inside.select("c", every("kb").alias("yb"), block("nb").alias("mb"), F.lit(1).alias("side"), "m", "comp", "dist")
    cols = ["c", "yb", "mb", "side", "m", "comp", "dist", "tokens"]
    rest = (ys.unionByName(ms).join(sets.withColumnRenamed("fp", "m"), "m").select(cols)
            .repartition("c", "yb", "mb").sortWithinPartitions("c", "yb", "mb", "side")
            .mapInArrow(_compare_blocks, "u long, v long"))
    # One link per id of the first round's components is enough to join them.
    return comps.select(F.col("id").alias("u"), F.col("component_id").alias("v")).unionByName(cut_lineage(rest))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    Null and blank texts have no shingles and are their own component. A row without an
    id cannot name a component: it is sized, not compared, and its component is null. Rows
    with a repeated doc_id are compared each. Empty tables give no rows. Other columns
    are not read."""
    texts = _keyed(docs)
    unnamed = texts.where("doc is null").select("text").mapInArrow(_sizes, "doc_id long, n_shingles long, component_id long")
    rows, named = _components(texts.where("doc is not null"))
    return (rows.join(named.select("fp", F.col("first.doc").alias("component_id")), "fp", "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))
            .unionByName(unnamed))


def _components(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents ``(doc, n, fp, h)`` and per class ``fp`` the first row ``(doc, h)`` of its component."""
    rows, classes = shingle_classes(texts)
    links = class_links(texts, classes)
    comps = connected_components(links).select(F.col("id").alias("fp"), F.col("component_id").alias("comp"))
    first = rows.where("n > 0").groupBy("fp").agg(F.min(F.struct("doc", "h")).alias("first"))
    named = first.join(comps, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    named = cut_lineage(named)
    least = named.groupBy("comp").agg(F.min("first").alias("first"))
    return rows, named.select("fp", "comp").join(least, "comp").select("fp", "first")


def first_of_groups(docs: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` without near duplicates, with all their columns: of
    each component one row stays, that of the smallest id (of one id: of the smallest text hash; of
    identical rows any one). Rows without an id or without shingles stay. Rows of one id are judged
    by their own texts. Empty tables stay empty."""
    rows, named = _components(_keyed(docs).where("doc is not null"))
    placed = cut_lineage(rows.where("n > 0").join(named, "fp").select(
        F.col("doc").alias("dup__id"), F.col("h").alias("dup__h"),
        ((F.col("doc") == F.col("first.doc")) & (F.col("h") == F.col("first.h"))).alias("stays")))
    key = (F.col("doc_id").cast("long") == F.col("dup__id")) & (
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("dup__h"))
    gone = cut_lineage(placed.where("not stays").select("dup__id", "dup__h").distinct())
    left = docs.join(bounded_broadcast(gone), key, "left_anti")
    twice = cut_lineage(placed.where("stays").groupBy("dup__id", "dup__h").count().where("count > 1").drop("count"))
    if not twice.limit(1).count():
        return left
    again = left.join(bounded_broadcast(twice), key).dropDuplicates(["dup__id", "dup__h"]).select(*docs.columns)
    return left.join(bounded_broadcast(twice), key, "left_anti").unionByName(again)
