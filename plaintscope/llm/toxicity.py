"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic fit.

Features per whole text: densities of a lexicon (whole words and word beginnings, two
strengths), its distinct entries, how near they stand to a second-person pronoun, capitals,
punctuation, digits and obfuscated or stretched words. The lexicon comes from the labelled
training rows: word forms and beginnings seen in toxic rows far more often than chance.

Three folds of the training rows by another hash of the id: lexicon and trees learn from
the first ones, the isotonic calibration from the last, so scores are calibrated on rows
the lexicon has not seen. At most ``MAX_LABELLED`` training rows (those of the smallest id
hash) are used; the scoring covers every row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage
from .common import release_memory, slices

MAX_LABELLED = 16_000
MIN_EVIDENCE = 9.0  # bits of surprise a lexicon entry needs under the base rate
STEMS = (4, 5, 6)
NEAR = 40  # characters on either side of a lexicon hit
THRESHOLD = 0.3

# Second-person forms (en, fr, de, es).
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
                 "euer tú ti tus usted ustedes vosotros")
_SECOND = re.compile(" (?:" + "|".join(SECOND_PERSON.split()) + ") ")
# Signs written for letters.
_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
# The sign and its two neighbours: letters before them need no second look, so it is linear.
_MASKED = re.compile(r"[^\W\d_][013457@$!*][^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_NOT_LETTERS = re.compile(r"[\W\d_]+")

NAMES = ("word_density", "stem_density", "strong_density", "any_hits", "distinct_hits", "near_second_person",
         "second_person_density", "capital_rate", "shout_rate", "exclaim_rate", "punct_rate", "digit_rate",
         "masked_rate", "stretched_rate", "log_words")


def _clean(text: str) -> str:
    """Lower-cased letters with one space around each word; masked letters restored."""
    low = text.lower()
    if _MASKED.search(low):
        low = _MASKED.sub(lambda m: m.group().translate(_LOOKALIKE).replace("*", ""), low)
    return " " + _NOT_LETTERS.sub(" ", low).strip() + " "


def tokens(text: str) -> set[str]:
    """Word forms (``" word "``) and beginnings (``" begin"``) of a text."""
    words = set(_clean(text).split())
    out = {f" {w} " for w in words}
    for n in STEMS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for b in slices(batches):
        for t, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            seen[int(y)].update(tokens(t or ""))
    names = list(seen[1])  # only tokens of toxic rows can enter the lexicon
    clean = [x for x in seen[0] if x not in seen[1]]
    yield pa.RecordBatch.from_pydict({
        "token": names + clean, "toxic": pa.array([seen[1][n] for n in names] + [0] * len(clean), pa.int64()),
        "clean": pa.array([seen[0][n] for n in names] + [seen[0][n] for n in clean], pa.int64())})


def learn_lexicon(train: DataFrame) -> list[tuple[str, float]]:
    """All entries that pass the two limits with their log-odds, the most surprising first. Their
    number is bounded by the labelled rows, of which there are ``MAX_LABELLED`` at most."""
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    toxic, clean = n.get(1.0, 0), n.get(0.0, 0)
    if not toxic or not clean:
        return []
    p = toxic / (toxic + clean)
    counts = (train.select("text", "label").mapInArrow(_count_tokens, "token string, toxic long, clean long")
              .groupBy("token").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
              .where(F.col("a") >= 2))
    # Surprise of a toxic rows among a + b at the base rate (relative entropy x count).
    share = F.col("a") / (F.col("a") + F.col("b"))
    other = F.when(F.col("b") > 0, F.col("b") * F.log2((1 - share) / (1 - p))).otherwise(0.0)
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    found = (counts.withColumn("bits", F.col("a") * F.log2(share / p) + other)
             .withColumn("odds", odds)
             .where((F.col("odds") > 1.0) & (F.col("bits") >= MIN_EVIDENCE))
             .orderBy(F.desc("bits"), "token").select("token", "odds").collect())
    return [(r["token"], float(r["odds"])) for r in found]


class _Features:
    def __init__(self, lexicon: list[tuple[str, float]]):
        import ahocorasick
        self.machine = None
        if lexicon:
            self.machine = ahocorasick.Automaton()
            for token, odds in lexicon:
                self.machine.add_word(token, (token, odds))
            self.machine.make_automaton()

    def __call__(self, text: str) -> list[float]:
        clean = _clean(text)
        n = max(1, clean.count(" ") - 1)
        word = stem = strong = near = 0
        distinct = set()
        if self.machine is not None:
            for end, (token, odds) in self.machine.iter(clean):
                distinct.add(token)
                if token.endswith(" "):
                    word += 1
                else:
                    stem += 1
                strong += odds > 3
                if _SECOND.search(clean, max(0, end - NEAR), min(len(clean), end + NEAR)):
                    near += 1
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        hist = np.bincount(raw, minlength=256)
        upper, lower = int(hist[65:91].sum()), int(hist[97:123].sum())
        digits = int(hist[48:58].sum())
        punct = int(hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum())
        shout = sum(1 for w in re.findall(r"\b[A-Z]{3,}\b", text)) if upper > 0.2 * (upper + lower) else 0
        masked = len(_MASKED.findall(text.lower())) if digits or hist[36] or hist[42] or hist[64] else 0
        return [word / n, stem / n, strong / n, float(word + stem > 0), float(len(distinct)), near / n,
                len(_SECOND.findall(clean)) / n, upper / max(1, upper + lower), shout / n, int(hist[33]) / n,
                punct / max(1, len(raw)), digits / max(1, len(raw)), masked / n,
                len(_STRETCHED.findall(clean)) / n, math.log1p(n)]


def with_features(docs: DataFrame, lexicon: list[tuple[str, float]], keep: list[str]) -> DataFrame:
    """``keep`` columns and the features of ``text`` (null: empty text)."""
    schema = docs.select(*keep).schema
    for name in NAMES:
        schema = schema.add(name, "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _Features(lexicon)
        for b in slices(batches):
            rows = np.array([make(t or "") for t in b.column("text").to_pylist()], dtype=float)
            rows = rows.reshape(-1, len(NAMES))
            cols = [b.column(k) for k in keep] + [pa.array(rows[:, i]) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays(cols, names=keep + list(NAMES))
        release_memory()

    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(work, schema)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs(doc_id, text)``, after the
    columns of ``docs`` named in ``keep``; one named like a result (but for ``doc_id``) is returned
    as ``kept_<name>``.

    ``labels(doc_id, toxic)``: rows with null id, null label or held-out id teach nothing;
    a repeated id counts as toxic if any row says so. Without both classes among the
    training rows every score is the base rate (0 without labels). Null text is empty; whole texts
    of any length are read, in linear time. Repeated ids and rows are scored each, equal texts alike.
    Empty tables give no rows."""
    keep = tuple(c for c in keep if c != "doc_id")
    taken = {"doc_id", "held_out", "score", "predicted"}
    names = [f"kept_{c}" if c.lower() in taken else c for c in keep]
    return _scored(docs, labels, keep).select(
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(names)], "doc_id", "held_out", "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with all their columns as they are."""
    return _scored(docs, labels, tuple(docs.columns)).where("predicted = 0").select(
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)])


def _scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``doc_id, held_out, kept_0 .., score, predicted``: results under reserved names."""
    own = ["doc_id", "held_out", *[f"kept_{i}" for i in range(len(keep))]]
    rows = docs.select("doc_id", "text", *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    lab = (labels.where("doc_id is not null and toxic is not null").where(~held_out())
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
           .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(MAX_LABELLED))
    # At most MAX_LABELLED rows, so the texts are found by a map-side join.
    train = rows.select("doc_id", "text").join(bounded_broadcast(cut_lineage(lab)), "doc_id").withColumn("fold", F.col("h").bitwiseAND(3))
    train = cut_lineage(train.select("text", "label", "fold").coalesce(16))
    learn = train.where("fold < 3")
    n = {(r["label"], r["f"]): r["count"]
         for r in train.groupBy("label", (F.col("fold") < 3).alias("f")).count().collect()}
    scored = rows.withColumn("held_out", held_out())
    if not all(n.get((y, f)) for y in (0.0, 1.0) for f in (True, False)):
        total = sum(n.values())
        base = (n.get((1.0, True), 0) + n.get((1.0, False), 0)) / total if total else 0.0
        out = scored.withColumn("score", F.lit(base))
    else:
        lexicon = learn_lexicon(learn)
        assemble = VectorAssembler(inputCols=list(NAMES), outputCol="features")
        data = cut_lineage(with_features(train, lexicon, ["label", "fold"]).coalesce(4))
        data = assemble.transform(data)
        trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, seed=7, cacheNodeIds=False)
        model = trees.fit(data.where("fold < 3"))
        margin = vector_to_array("rawPrediction")[1].alias("margin")
        fit = model.transform(data.where("fold = 3")).select(margin, "label")
        iso = IsotonicRegression(featuresCol="margin", labelCol="label").fit(fit)
        feats = with_features(scored, lexicon, own)
        out = model.transform(assemble.transform(feats)).select(*own, margin)
        # A little of the uncalibrated margin keeps the order within a level of the fit.
        out = iso.transform(out).withColumn(
            "score", 0.98 * F.col("prediction") + 0.02 / (1 + F.exp(-2 * F.col("margin"))))
    kept = own[2:]
    return out.select(*kept, "doc_id", "held_out", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score")
                      ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
