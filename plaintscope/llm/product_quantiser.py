"""Near-duplicate vectors by an inverted file with product-quantised residuals.

Vectors are compared within a label (and length) by cosine. On unit vectors cosine >= t is
distance <= r = sqrt(2 - 2 t), which bounds what must be read:

* Probes: x lies in the cell of its nearest centre c, so it is on c's side of the plane
  between c and q's own centre c0; q need search cell c only if it is near that plane,
  |q - c|^2 - |q - c0|^2 <= 2 r |c - c0|. No vector within r is missed, whatever the
  directions of the vectors.
* Codes: x is stored as its cell and one byte per subspace of its residual, with the error
  e of that approximation. A looked-up distance from q above r + e rules x out.

What passes is compared exactly, in double precision on the stored vectors. Centres and
codebooks are fitted on at most ``SAMPLE`` vectors (those of the smallest id hash); every
vector is indexed and every vector searches.

Equal vectors of a label are one entry with a count. Lists are cut into blocks of ``BLOCK``
entries, so a hot list is many tasks; a task counts links and emits only the links of a
spanning forest of its block, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import connected_components

THRESHOLD = 0.98
SAMPLE = 20_000
PER_LIST = 2_000  # vectors for one coarse centre
MAX_LISTS = 1_024
SUBSPACES = 8
CODES = 64
BLOCK = 1_024
ITERATIONS = 8


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(ITERATIONS):
        near = _nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_squared(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


class Codebook:
    """Coarse centres and residual codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centres = _kmeans(sample, lists, 1)
        residual = sample - self.centres[_nearest(sample, self.centres)]
        edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
        self.books = [_kmeans(residual[:, p], CODES, 2 + i) for i, p in enumerate(self.parts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes and approximation error of unit vectors."""
        cell = _nearest(x, self.centres)
        residual = x - self.centres[cell]
        codes = np.stack([_nearest(residual[:, p], b) for p, b in zip(self.parts, self.books)], axis=1)
        approx = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return cell, codes.astype(np.uint8), np.sqrt(((residual - approx) ** 2).sum(1))

    def probes(self, x: np.ndarray, radius: float) -> list[np.ndarray]:
        """Cells that may hold a vector within ``radius``, for each vector."""
        d = _squared(x, self.centres)
        own = d.argmin(1)
        apart = np.sqrt(_squared(self.centres, self.centres))
        ok = d - d[np.arange(len(x)), own][:, None] <= 2 * radius * apart[own] + 1e-9
        return [np.flatnonzero(row) for row in ok]

    def distances(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Looked-up distances of queries to coded entries of a cell."""
        residual = (q - self.centres[cell]).astype(np.float32)
        total = np.zeros((len(q), len(codes)), dtype=np.float32)
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            total += _squared(residual[:, p], b.astype(np.float32))[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two, their largest component between 1/2 and 1: exact, and neither a
    tiny nor a huge vector leaves the range of its squares."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    n = pc.list_value_length(b.column("embedding"))
    for size in pc.unique(n).to_pylist():
        yield size, b.filter(pc.equal(n, size))


def _forest(links: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[list, list]:
    """Links (row id, column id) that keep the components of a link matrix."""
    label = np.full(len(cols), -1)
    u, v = [], []
    for i in range(len(rows)):
        near = np.flatnonzero(links[i])
        if not len(near):
            continue
        seen, first = np.unique(label[near], return_index=True)
        for lab, f in zip(seen.tolist(), first.tolist()):
            if lab >= 0:
                u.append(rows[i])
                v.append(cols[near[f]])
        fresh = near[label[near] < 0]
        u += [rows[i]] * len(fresh)
        v += cols[fresh].tolist()
        old = seen[seen >= 0]
        if len(old):
            label[np.isin(label, old)] = i
        label[near] = i
    return u, v


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of
    ``vectors(vec_id, embedding, label)``.

    A null label or vector, a zero or empty vector, or null or non-finite components: no
    links, a component of its own. Vectors of any length above zero are compared (components of 1e-300
    or 1e300 too). Vectors of different lengths are not compared. A row
    without vec_id takes part in no link (null component, not kept). Rows with one vec_id
    are each compared; they share that id's component. Empty tables give no rows."""
    radius = float(np.sqrt(2 - 2 * threshold))
    e = F.col("embedding")
    ok = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
          & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists(e, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.cast("array<double>").alias("embedding"))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    keys = [F.xxhash64("label", "embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding", "label").alias("k2")]
    rows = cut_lineage(rows.select("vec_id", "label", "embedding", "ok", *keys))
    classes = cut_lineage(rows.where("ok").groupBy("k1", "k2")
                          .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"),
                               F.first("label").alias("label"), F.first("embedding").alias("embedding")))
    per_length = {r["d"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    sample = (classes.select("embedding", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE).select("embedding").toArrow())
    books: dict[int, Codebook] = {}
    for batch in sample.combine_chunks().to_batches():
        for size, part in _by_length(batch):
            x = _matrix(part.column("embedding"))
            lists = max(1, min(MAX_LISTS, per_length[size] // PER_LIST, len(x)))
            books[size] = Codebook(_unit(x), lists)
    for size in per_length:
        if size not in books:  # a length too rare for the sample: one list around zero
            books[size] = Codebook(np.zeros((1, size)), 1)
    shared = vectors.sparkSession.sparkContext.broadcast(books)  # at most SAMPLE-fitted codebooks
    blocks = F.pmod(F.xxhash64("id"), F.lit(1 << 30))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for size, part in _by_length(b):
                book = shared.value[size]
                for lo in range(0, part.num_rows, 2048):
                    piece = part.slice(lo, 2048)
                    x = _unit(_matrix(piece.column("embedding")))
                    cell, codes, err = book.encode(x)
                    probes = book.probes(x, radius)
                    yield pa.RecordBatch.from_arrays(
                        [*(piece.column(c) for c in ("id", "copies", "label", "embedding")),
                         pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()),
                         pa.array(err), pa.array([p.tolist() for p in probes], pa.list_(pa.int32()))],
                        names=["id", "copies", "label", "embedding", "cell", "codes", "err", "probes"])

    kind = dict(rows.dtypes)["label"]
    coded = cut_lineage(classes.select("id", "copies", "label", "embedding").mapInArrow(
        assign, f"id long, copies long, label {kind}, embedding array<double>, cell int, codes binary, err double, probes array<int>"))
    coded = coded.withColumn("d", F.size("embedding"))
    entries = coded.select("d", "label", "cell", "id", "copies", "embedding", "codes", "err")
    queries = coded.select("d", "label", F.explode("probes").alias("cell"), "id", "embedding")
    at = ["d", "label", "cell"]
    sizes = (entries.groupBy(at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("eb"))
             .join(queries.groupBy(at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qb")), at))
    own = lambda n: F.pmod(blocks, F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["d", "label", "cell", "i", "j", "side", "id", "copies", "embedding", "codes", "err"]
    es = (entries.join(F.broadcast(sizes) if len(books) * MAX_LISTS <= 20_000 and sizes.limit(100_001).count() <= 100_000 else sizes, at)
          .withColumn("i", own("eb")).withColumn("j", every("qb")).withColumn("side", F.lit(0)).select(cols))
    qs = (queries.join(sizes, at).withColumn("j", own("qb")).withColumn("i", every("eb"))
          .select(*at, "i", "j", F.lit(1).alias("side"), "id", F.lit(None).cast("long").alias("copies"), "embedding",
                  F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("err")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(t: pa.Table) -> Iterator[pa.RecordBatch]:
            side = t.column("side").to_numpy()
            e, q = t.filter(pa.array(side == 0)), t.filter(pa.array(side == 1))
            if not e.num_rows or not q.num_rows:
                return
            book = shared.value[t.column("d")[0].as_py()]
            cell = t.column("cell")[0].as_py()
            ids, qids = e.column("id").to_numpy(), q.column("id").to_numpy()
            x, y = (_scaled(_matrix(v.column("embedding").combine_chunks())) for v in (e, q))
            copies, err = e.column("copies").to_numpy(), e.column("err").to_numpy()
            codes = np.frombuffer(b"".join(e.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1)
            x_norm, y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            near = book.distances(y / y_norm[:, None], cell, codes) <= radius + err[None, :] + 1e-3
            near &= qids[:, None] != ids[None, :]
            links = np.zeros(near.shape, bool)
            for i in range(len(qids)):  # exact rerank of what the codes let through
                c = np.flatnonzero(near[i])
                if len(c):
                    links[i, c] = x[c] @ y[i] / (x_norm[c] * y_norm[i]) >= threshold
            n = links @ copies
            hit = n > 0
            u, v = _forest(links, qids, ids)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(qids[hit].tolist() + u, pa.int64()), "n": pa.array(n[hit].tolist() + [0] * len(u), pa.int64()),
                "other": pa.array([None] * int(hit.sum()) + v, pa.int64())})

        held: list[pa.RecordBatch] = []
        for b in batches:
            key = np.stack([b.column(k).to_numpy() for k in ("g",)], axis=1)[:, 0]
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                if held and held[-1].column("g")[0].as_py() != key[lo]:
                    yield from block(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from block(pa.Table.from_batches(held))

    grouped = (es.unionByName(qs).withColumn("g", F.xxhash64("d", "label", "cell", "i", "j"))
               .repartition("g").sortWithinPartitions("g", "side"))
    found = cut_lineage(grouped.mapInArrow(search, "id long, n long, other long"))
    counts = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("other is not null"), "id", "other")
    named = (classes.select("k1", "k2", "id", "copies").join(counts, "id", "left").join(comps, "id", "left")
             .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component_id", "id").alias("component_id"), F.lit(True).alias("ok")))
    return (rows.select("vec_id", "k1", "k2", "ok").join(named, ["k1", "k2", "ok"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
