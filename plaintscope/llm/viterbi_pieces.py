"""SentencePiece encoding by a max-plus parallel scan, and decoding.

The vocabulary and scores of a SentencePiece model are read as a unigram lattice: a text's
encoding is the piece sequence of the highest total score (ties: at every place the longest
last piece). The tokenizer files at hand hold one SentencePiece model, of the BPE kind; its
own merge order is not a shortest-path problem, so the ids are those of the unigram lattice
over the same pieces, and decode to the same text. White space is U+2581, one is put in front
of a non-empty text; a character without a piece becomes its UTF-8 byte pieces.

Short texts are encoded row by row. A giant text is split into chunks; the state at a chunk's
start is how many characters the last piece reaches into it (0 .. longest piece - 1):

1. each chunk yields a transfer matrix: best score from each entry state to each exit state;
2. the matrices combine associatively (max, +): products of blocks of chunks, a scan over
   blocks, a scan within blocks, which gives the best score of every state at every chunk;
3. with these, each chunk finds on its own which entry state each exit state goes back to;
   these maps compose, again by blocks, from the text's end;
4. each chunk is then traced back on its own and yields its ids.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import slices, written

DEFAULT_MODEL = "piece_bpe_32k.model"
CHUNK = 32_768
CHUNKS_PER_BLOCK = 64
SPACE = "▁"
MAX_CACHED_WORDS = 500_000
NEVER = -(1 << 60)
_NONE = object()
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def default_path(name: str = DEFAULT_MODEL) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class Lattice:
    """Pieces, integer scores and the search over them."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        self.byte_id = [0] * 256
        self.decoded: list[bytes] = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.decoded[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                self.decoded[i] = piece.replace(SPACE, " ").encode()
        normal = [s for s in scores.values() if s > -1e8]
        least = int(min(normal))
        # Pieces without a learnt score rank after all others; a byte sequence last.
        self.score = {p: int(s) if s > -1e8 else least - 1 for p, s in scores.items()}
        self.unknown = least - 10
        self.longest = max(map(len, self.ids))
        # Score of each piece, None for what only begins one.
        self.prefix: dict[str, int | None] = {p[:k]: None for p in self.ids for k in range(1, len(p))}
        self.prefix.update(self.score)
        # The same pieces by character: (score or None, id, what may follow).
        self.tree: dict = {}
        for p, w in self.score.items():
            at = self.tree
            for c in p[:-1]:
                at = at.setdefault(c, [None, -1, {}])[2]
            node = at.setdefault(p[-1], [None, -1, {}])
            node[0], node[1] = w, self.ids[p]
        # Neighbours inside a piece: every path passes between two characters that are none.
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.decoded_text = np.array(self.decoded, dtype=object)
        # No piece joins a character to a following space mark: words are separate.
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.words: dict[str, bytes] = {}
        self.word_scores: dict[str, int] = {}

    def normalise(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def forward(self, s: str, start: list[int], stop: int) -> tuple[list[int], list[int]]:
        """Best scores of places and the piece starts they come from (-1: entered), for
        pieces that start before ``stop``; ``start`` gives the scores of the first places."""
        n = len(s)
        best = [NEVER] * (n + 1)
        back = [-1] * (n + 1)
        best[:len(start)] = start
        get, none, reach, unknown = self.prefix.get, _NONE, self.longest, self.unknown
        for i in range(stop):
            b = best[i]
            if b == NEVER:
                continue
            w = get(s[i], none)
            w = b + (unknown if w is none or w is None else w)
            if w > best[i + 1]:  # an earlier start wins ties
                best[i + 1] = w
                back[i + 1] = i
            for j in range(i + 2, min(n, i + reach) + 1):
                w = get(s[i:j], none)
                if w is none:  # no piece begins like this
                    break
                if w is not None and b + w > best[j]:
                    best[j] = b + w
                    back[j] = i
        return best, back

    def piece_ids(self, s: str, i: int, j: int) -> list[int]:
        piece = self.ids.get(s[i:j])
        return [piece] if piece is not None else [self.byte_id[b] for b in s[i:j].encode("utf-8", "replace")]

    def trace(self, s: str, back: list[int], at: int) -> tuple[list[int], int]:
        """Ids up to ``at`` and the place the path was entered at."""
        out: list[list[int]] = []
        while back[at] >= 0:
            out.append(self.piece_ids(s, back[at], at))
            at = back[at]
        return [x for p in reversed(out) for x in p], at

    def search(self, s: str) -> tuple[bytes, int]:
        """``forward`` from the first place alone, traced back; every place is reached."""
        n = len(s)
        best = [0] + [NEVER] * n
        back = [0] * (n + 1)
        piece = [-1] * (n + 1)
        tree, unknown = self.tree, self.unknown
        for i in range(n):
            b = best[i]
            node = tree.get(s[i])
            if node is None or node[0] is None:
                w, x = b + unknown, -1
            else:
                w, x = b + node[0], node[1]
            j = i + 1
            if w > best[j]:  # an earlier start wins ties
                best[j], back[j], piece[j] = w, i, x
            if node is None:
                continue
            at = node[2]
            while at and j < n:
                node = at.get(s[j])
                if node is None:  # no piece begins like this
                    break
                w, x, at = node
                j += 1
                if w is not None and b + w > best[j]:
                    best[j], back[j], piece[j] = b + w, i, x
        out, at = [], n
        while at:
            i = back[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [self.byte_id[b] for b in reversed(s[i:at].encode("utf-8", "replace"))]
            at = i
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out), best[n]

    def word(self, s: str, held: dict[str, tuple[bytes, int]]) -> tuple[bytes, int]:
        """A word is searched in the parts that no piece joins; equal parts once per ``held``."""
        cuts = [i for i in range(1, len(s)) if s[i - 1:i + 1] not in self.inside]
        if not cuts:
            return held.get(s) or self.search(s)
        found = []
        for i, j in zip([0, *cuts], [*cuts, len(s)]):
            part = s[i:j]
            x = held.get(part)
            if x is None:
                x = ((self.words[part], self.word_scores[part]) if part in self.words
                     else held.setdefault(part, self.search(part)))
            found.append(x)
        return b"".join([x for x, _ in found]), sum([w for _, w in found])

    def encode_many(self, texts: list[str]) -> list[tuple[bytes, int]]:
        """Ids (little-endian 32-bit) and total score of whole texts. Each word that is not
        held is searched once per call."""
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif not self.by_words:
                split.append([self.normalise(t)])
            else:
                ws = t.split(" ")
                if "" in ws or SPACE in t:
                    ws = _WORDS.findall(self.normalise(t))
                else:
                    ws = [SPACE + w for w in ws]
                split.append(ws)
        ids, scores = self.words, self.word_scores
        new: set[str] = set()
        for ws in split:
            new.update([w for w in ws if w not in ids])
        full = len(ids) >= MAX_CACHED_WORDS
        parts: dict[str, tuple[bytes, int]] = {}
        for w in new:
            ids[w], scores[w] = self.word(w, parts)
        out = [(b"".join([ids[w] for w in ws]), sum([scores[w] for w in ws])) for ws in split]
        for w in new:
            if full or len(w) > 64:
                del ids[w], scores[w]
        return out

    def decode(self, ids: bytes) -> str:
        raw = b"".join(self.decoded_text[np.frombuffer(ids, dtype="<u4")].tolist())
        return raw.decode("utf-8", "replace")[1:]

    def transfer(self, s: str, stop: int) -> np.ndarray:
        """Best score from entry state i to exit state j of a chunk of ``stop`` characters
        whose text ``s`` goes on for the longest piece's reach (less at the text's end)."""
        m = self.longest
        out = np.full((m, m), NEVER, dtype=np.int64)
        # Word starts are passed by every path: between the first and the last one there
        # is one state, whose score is the words' sum.
        cuts = [w.start() for w in _WORDS.finditer(s) if m <= w.start() <= stop] if self.by_words else []
        if len(cuts) < 2:
            for i in range(min(m, stop + 1)):
                best, _ = self.forward(s, [NEVER] * i + [0], stop)
                n = min(m, len(best) - stop)
                out[i, :n] = best[stop:stop + n]
            return out
        first, last = cuts[0], cuts[-1]
        middle = self.encode_many([s[first + 1:last].replace(SPACE, " ")])[0][1]
        tail, _ = self.forward(s[last:], [0], stop - last)
        for i in range(m):
            head, _ = self.forward(s[:first], [NEVER] * i + [0], first)
            if head[first] > NEVER:
                n = min(m, len(tail) - (stop - last))
                exits = np.array(tail[stop - last:stop - last + n])
                out[i, :n] = np.where(exits > NEVER, exits + head[first] + middle, NEVER)
        return out


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; associative."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


def _short(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(path)
        for b in slices(batches):
            found = lat.encode_many(b.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({
                "row": b.column("row"), "part": pa.array([0] * len(found), pa.int32()),
                "ids": pa.array([x for x, _ in found], pa.binary()), "score": pa.array([w for _, w in found], pa.int64())})
    return work


def _rows(path: str, name: str, kind, make):
    """A map over chunk rows that adds the column ``name``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(path)
        for b in batches:
            for x in slices([b], 64):
                made = [make(lat, r) for r in x.to_pylist()]
                yield x.append_column(name, pa.array(made, kind))
    return work


def _matrix(raw: bytes) -> np.ndarray:
    m = np.frombuffer(raw, dtype=np.int64)
    n = int(len(m) ** 0.5)
    return m.reshape(n, n)


def _block_product(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("part")
    m = functools.reduce(combine, map(_matrix, pdf["matrix"]))
    return pd.DataFrame({"row": pdf["row"].iloc[:1], "block": pdf["block"].iloc[:1], "matrix": [m.tobytes()]})


def _scan_scores(pdf: pd.DataFrame, order: str, start: np.ndarray) -> list[bytes]:
    at, out = start, []
    for raw in pdf.sort_values(order)["matrix"]:
        out.append(at.tobytes())
        at = np.maximum((at[:, None] + _matrix(raw)).max(axis=0), NEVER)
    return out


def _compose(maps: list[np.ndarray]) -> np.ndarray:
    """The map of a run of chunks: exit state of the last to entry state of the first."""
    return functools.reduce(lambda a, b: np.where(b >= 0, a[b], -1), maps)


def encode_pieces(docs: DataFrame, model: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids (binary, little-endian unsigned 32-bit), n_pieces, score, n_chunks``
    for each row of ``docs(doc_id, text)``.

    Null text is the empty text, which has no pieces. Repeated and null ids stay rows of
    their own. An empty table gives no rows. Other columns are not read."""
    path = model or default_path()
    reach = lattice(path).longest
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    giant_size = 2 * chunk
    short = (base.where(F.length("text") <= giant_size).select(F.col("doc_id").alias("row"), "text"))
    kind = dict(docs.dtypes)["doc_id"]
    done = short.mapInArrow(_short(path), f"row {kind}, part int, ids binary, score long").select(
        F.col("row").alias("doc_id"), "ids", "score", F.lit(1).cast("long").alias("n_chunks"))

    # Giant texts: numbered once, in a written table, so that retries agree.
    giant = written(base.where(F.length("text") > giant_size).withColumn("row", F.monotonically_increasing_id()), "giant-texts")
    s = F.concat(F.lit(SPACE), F.translate("text", " ", SPACE))
    n = F.ceil(F.length("s") / chunk).cast("int")
    parts = (giant.select("row", s.alias("s"))
             .select("row", n.alias("parts"), F.explode(F.transform(
                 F.sequence(F.lit(0), n - 1),
                 lambda i: F.struct(i.alias("part"), F.substring("s", i * chunk + 1, chunk + reach).alias("s"),
                                    F.least(F.lit(chunk), F.length("s") - i * chunk).alias("stop")))).alias("c"))
             .select("row", "parts", "c.*").withColumn("block", F.expr(f"cast(part div {CHUNKS_PER_BLOCK} as int)"))
             .repartition("row", "part"))

    def transfer(lat, r):
        return lat.transfer(r["s"], r["stop"]).tobytes()

    types = "row long, parts int, part int, s string, stop int, block int"
    chunks = written(parts.select("row", "parts", "part", "s", "stop", "block")
                     .mapInArrow(_rows(path, "matrix", pa.binary(), transfer), types + ", matrix binary"), "piece-chunks")
    # Scores of the states at every block, then at every chunk.
    products = chunks.groupBy("row", "block").applyInPandas(_block_product, "row long, block int, matrix binary")

    def at_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        start = np.full(reach, NEVER, dtype=np.int64)
        start[0] = 0
        pdf = pdf.sort_values("block")
        return pdf[["row", "block"]].assign(entry=_scan_scores(pdf, "block", start))

    entries = products.groupBy("row").applyInPandas(at_blocks, "row long, block int, entry binary")

    def at_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        start = np.frombuffer(pdf["entry"].iloc[0], dtype=np.int64)
        return pdf[["row", "part"]].assign(states=_scan_scores(pdf, "part", start))

    states = (chunks.select("row", "block", "part", "matrix").join(entries, ["row", "block"])
              .groupBy("row", "block").applyInPandas(at_chunks, "row long, part int, states binary"))

    def local(lat, r):
        start = np.frombuffer(r["states"], dtype=np.int64).tolist()
        best, back = lat.forward(r["s"], start[:len(r["s"]) + 1], r["stop"])
        return best, back

    def entry_map(lat, r):
        best, back = local(lat, r)
        out = np.full(reach, -1, dtype=np.int64)
        for j in range(min(reach, len(best) - r["stop"])):
            if best[r["stop"] + j] > NEVER:
                at = r["stop"] + j
                while back[at] >= 0:
                    at = back[at]
                out[j] = at
        return out.tobytes()

    mapped = written(chunks.drop("matrix").join(states, ["row", "part"]).select("row", "parts", "part", "s", "stop", "block", "states")
                     .mapInArrow(_rows(path, "back", pa.binary(), entry_map), types + ", states binary, back binary"), "piece-maps")

    def block_map(pdf: pd.DataFrame) -> pd.DataFrame:
        maps = [np.frombuffer(x, dtype=np.int64) for x in pdf.sort_values("part")["back"]]
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "block": pdf["block"].iloc[:1], "back": [_compose(maps).tobytes()]})

    def block_exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ascending=False)
        at, out = 0, []
        for raw in pdf["back"]:
            out.append(at)
            at = int(np.frombuffer(raw, dtype=np.int64)[at])
        return pdf[["row", "block"]].assign(leave=out)

    leaves = (mapped.groupBy("row", "block").applyInPandas(block_map, "row long, block int, back binary")
              .groupBy("row").applyInPandas(block_exits, "row long, block int, leave int"))

    def chunk_exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part", ascending=False)
        at, out = int(pdf["leave"].iloc[0]), []
        for raw in pdf["back"]:
            out.append(at)
            at = int(np.frombuffer(raw, dtype=np.int64)[at])
        return pdf[["row", "part"]].assign(leave=out)

    exits = (mapped.select("row", "block", "part", "back").join(leaves, ["row", "block"])
             .groupBy("row", "block").applyInPandas(chunk_exits, "row long, part int, leave int"))

    def ids_of(lat, r):
        _, back = local(lat, r)
        return np.array(lat.trace(r["s"], back, r["stop"] + r["leave"])[0], dtype="<u4").tobytes()

    traced = (mapped.drop("back").join(exits, ["row", "part"])
              .select("row", "parts", "part", "s", "stop", "block", "states", "leave")
              .mapInArrow(_rows(path, "ids", pa.binary(), ids_of), types + ", states binary, leave int, ids binary")
              .select("row", "part", "ids"))
    total = products.groupBy("row").applyInPandas(
        lambda pdf: pd.DataFrame({"row": pdf["row"].iloc[:1], "score": [int(functools.reduce(
            combine, map(_matrix, pdf.sort_values("block")["matrix"]))[0, 0])]}), "row long, score long")
    joined = (traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("x"))
              .select("row", F.concat_ws("", F.transform("x", lambda x: F.hex(x["ids"]))).alias("hex"),
                      F.size("x").cast("long").alias("n_chunks"))
              .select("row", F.unhex("hex").alias("ids"), "n_chunks"))
    big = (giant.select("row", "doc_id").join(joined, "row").join(total, "row")
           .select("doc_id", "ids", "score", "n_chunks"))
    return (done.unionByName(big).withColumn("n_pieces", (F.length("ids") / 4).cast("long"))
            .select("doc_id", "ids", "n_pieces", "score", "n_chunks"))


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, ...`` to the same rows with ``text`` (the space mark before the first
    word dropped)."""
    path = model or default_path()

    def decode(lat, r):
        return lat.decode(r["ids"] or b"")

    schema = StructType([*encoded.schema.fields, StructField("text", StringType())])
    return encoded.mapInArrow(_rows(path, "text", pa.string(), decode), schema)


def piece_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: pieces, crc32 of the ids, score, and whether decoding gives the text
    back (with U+2581 read as a space)."""
    path = model or default_path()
    coded = encode_pieces(docs, path)
    fields = f"doc_id {dict(docs.dtypes)['doc_id']}, n_pieces long, ids_crc32 long, score long, n_chunks long, decoded_crc32 long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(path)
        for b in slices(batches):
            ids = b.column("ids").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_pieces": b.column("n_pieces"),
                "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()), "score": b.column("score"),
                "n_chunks": b.column("n_chunks"),
                "decoded_crc32": pa.array([zlib.crc32(lat.decode(x).encode("utf-8", "replace")) for x in ids], pa.int64())})

    return coded.mapInArrow(work, fields)
