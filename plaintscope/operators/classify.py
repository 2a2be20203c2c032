"""Issue classifier: usable rows, class filter, exact stratified split, balanced
weights, TF-IDF, multinomial logistic regression and metrics (B6, B7, D4, T1-T17).

Scale notes:
* The split is exact without a per-class sort of all rows: each row gets a
  seeded md5 key; a (class, 16-bit key prefix) histogram (small, aggregated
  map-side) locates the prefix bucket where each class's test quota ends, and
  only rows of that one bucket per class are ranked. A class holding a third of
  all rows therefore never lands in a single task.
* The vocabulary is an exact top-k found from a term-frequency histogram
  (``topk.top_k_by_count``), so no task sorts all terms; its size is bounded by
  ``max_vocab`` - the one side joined by broadcast, behind that bound.
* The vocabulary's counts come from ``term_counts.count_terms``: blocks of documents are counted
  in a task and dealt by bucket, not a row per (document, term).
* A document's own counts are made inside its row (sorted array, run lengths).
* A vector needs its own document and the vocabulary alone: terms are looked up in the row by
  Arrow (``row_features``), nothing is shuffled. A vocabulary beyond the broadcast bound is joined
  (``tfidf_weights``). The vector is built as a struct and typed by reading the written table.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ..config import DEFAULTS, Thresholds
from ..functions.scalar import utrim
from ..functions.text import content_tokens, explode_terms, ngrams2
from ..session import BROADCAST_MAX_ROWS, bounded_broadcast, checkpoint_path, cut_lineage
from .term_counts import count_terms, small_batches
from .topk import top_k_by_count


def usable_narratives(df: DataFrame) -> DataFrame:
    """B6 + B7 + B4: narrative and issue present; both trimmed; empty narrative dropped."""
    # "not empty after trim" is tested on the raw text with a regex find that stops at
    # the first visible character; a filter on the trimmed column would be pushed
    # below the projection and trim every narrative twice.
    visible = F.col("consumer_complaint_narrative").rlike(r"[^\s\p{Z}]")
    return (df.where(F.col("consumer_complaint_narrative").isNotNull() & F.col("issue").isNotNull()
                     & visible)
            .select("complaint_id",
                    utrim("consumer_complaint_narrative").alias("consumer_complaint_narrative"),
                    utrim("issue").alias("issue")))


def class_counts(usable: DataFrame) -> DataFrame:
    """E3 on issue: usable narratives per class."""
    return usable.groupBy("issue").agg(F.count(F.lit(1)).alias("records"))


def eligible_rows(usable: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """T10 + D4: rows of classes with at least `min_class_size` usable narratives."""
    # One row per class: broadcast behind its measured size, so no narrative is shuffled
    # on a label with few values.
    big = cut_lineage(class_counts(usable).where(F.col("records") >= th.min_class_size).select("issue"))
    return usable.join(bounded_broadcast(big), "issue", "left_semi")


def _bp(th: Thresholds) -> int:
    return int(round(th.test_fraction * 10000))


def split_quotas(eligible: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Per class: rows and test quota. Total test = ceil(f * n); each class gets
    floor(f * n_c) and the rest goes one each to the largest remainders (ties: class
    name). Integer arithmetic in basis points, so no float rounding enters.

    The windows below run over the per-class aggregate (one row per class)."""
    bp = _bp(th)
    counts = class_counts(eligible).select(
        "issue", "records",
        F.floor(F.col("records") * bp / 10000).cast("bigint").alias("base"),
        ((F.col("records") * bp) % 10000).alias("rem"))
    every = Window.partitionBy()
    extra = (F.ceil(F.sum("records").over(every) * bp / 10000).cast("bigint")
             - F.sum("base").over(every))
    order = Window.orderBy(F.col("rem").desc(), "issue")
    return counts.select(
        "issue", "records",
        (F.col("base") + F.when(F.row_number().over(order) <= extra, 1).otherwise(0))
        .cast("bigint").alias("test_quota"))


def split_key(id_col: str, seed: int):
    """Seeded, engine-independent pseudo-random order key (md5 hex of 'seed:id')."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_split(eligible: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Exact stratified split; adds boolean ``is_test``. Within a class the test
    rows are those first in (md5 key, id) order."""
    keyed = (eligible.withColumn("_h", split_key("complaint_id", th.split_seed))
             .withColumn("_b", F.substring("_h", 1, 4)))
    quotas = split_quotas(eligible, th)
    hist = keyed.groupBy("issue", "_b").agg(F.count(F.lit(1)).alias("_n"))
    cum_w = Window.partitionBy("issue").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (hist.withColumn("_cum", F.sum("_n").over(cum_w))
           .join(quotas, "issue")
           .where((F.col("_cum") - F.col("_n") < F.col("test_quota"))
                  & (F.col("_cum") >= F.col("test_quota")))
           .select("issue", F.col("_b").alias("_edge"),
                   (F.col("test_quota") - (F.col("_cum") - F.col("_n"))).alias("_need")))
    marked = keyed.join(bounded_broadcast(cut_lineage(cum)), "issue", "left")
    below = F.col("_edge").isNotNull() & (F.col("_b") < F.col("_edge"))
    at_edge = F.col("_edge").isNotNull() & (F.col("_b") == F.col("_edge"))
    edge_rows = marked.where(at_edge)
    rank_w = Window.partitionBy("issue").orderBy("_h", "complaint_id")
    edge_ranked = edge_rows.withColumn("is_test", F.row_number().over(rank_w) <= F.col("_need"))
    rest = marked.where(~at_edge).withColumn("is_test", below)
    cols = eligible.columns + ["is_test"]
    return rest.select(*cols).unionByName(edge_ranked.select(*cols))


def prepare_split(labelled: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """B6/B7 + T10 + T11 as one materialised table, hash-partitioned by document.

    The trimmed narratives are read by the class counts, the eligibility
    semi-join and the split's histogram and row passes, so they are written once
    (reliable checkpoint). The split is hash-partitioned by ``complaint_id`` into
    at least ``defaultParallelism`` partitions and written once more (the
    vocabulary, weights, fit and reports all read it): AQE sizes partitions by
    bytes, while tokenising is CPU-bound, so a small-but-expensive split is not
    collapsed into one task.
    """
    spark = labelled.sparkSession
    usable = cut_lineage(usable_narratives(labelled))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            spark.sparkContext.defaultParallelism)
    return cut_lineage(stratified_split(eligible_rows(usable, th), th)
                       .repartition(n, "complaint_id"))


def class_weights(train: DataFrame) -> DataFrame:
    """Balanced weights n / (k * n_c) over the training rows (windows run over
    the per-class aggregate)."""
    every = Window.partitionBy()
    n = F.sum("records").over(every)
    k = F.count(F.lit(1)).over(every)
    return class_counts(train).select(
        "issue", "records", (n.cast("double") / (k * F.col("records")).cast("double")).alias("weight"))


def with_words(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """T1 + T2: per document the list ``words`` of its narrative, with the columns ``keep`` beside."""
    return docs.select("complaint_id", *keep, content_tokens("consumer_complaint_narrative").alias("words"))


def term_runs(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """T4: per document the list ``runs`` of its (term, tf), unigrams and bigrams, NULL or empty without
    any; with the columns ``keep`` beside. ``docs`` hold narratives or their ``words``.

    Counted inside the row: equal terms are neighbours in the sorted array, and a term's
    count is the distance between two run starts."""
    cols = ["complaint_id", *keep]
    staged = docs if "words" in docs.columns else with_words(docs, keep)
    staged = staged.select(*cols, F.sort_array(F.concat("words", ngrams2("words"))).alias("_s"))
    s, n = F.col("_s"), F.size("_s")
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1),
                                    lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))))
    staged = staged.withColumn("_at", starts)
    runs = F.transform("_at", lambda b, j: F.struct(
        F.get(s, b).alias("term"),
        (F.coalesce(F.get(F.col("_at"), j + 1), n) - b).cast("bigint").alias("tf")))
    return staged.select(*cols, runs.alias("runs"))


def explode_runs(runs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (document, term) of ``term_runs``."""
    cols = ["complaint_id", *keep]
    return explode_terms(runs, "runs", "_run", cols).select(*cols, "_run.term", "_run.tf")


def term_frequencies(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """T4: raw counts per (document, unigram or bigram), with the columns ``keep`` beside. ``docs``
    holds one row per document."""
    return explode_runs(term_runs(docs, keep), keep)


def tfidf_vocab(train: DataFrame, th: Thresholds = DEFAULTS, tf: DataFrame | None = None) -> DataFrame:
    """T6 + G8: terms in >= min_doc_freq training documents; the `max_vocab` most frequent
    (total count, ties by term) get indices 0..k-1 in that order. ``train`` holds narratives
    or their ``words``; ``tf`` may carry precomputed training term frequencies."""
    if tf is not None:
        stats = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("term_freq"))
                 .where(F.col("doc_freq") >= th.min_doc_freq))
    else:
        words = train if "words" in train.columns else with_words(train)
        stats = count_terms(words, [], unigrams=True, at_least=th.min_doc_freq)
    # Per-term statistics are read several times by the exact top-k: written once.
    stats = cut_lineage(stats)
    top = top_k_by_count(stats, [], "term_freq", "term", th.max_vocab)
    # At most max_vocab rows: a single-partition window is bounded by that cap.
    w = Window.orderBy(F.col("term_freq").desc(), "term")
    return top.withColumn("term_index", (F.row_number().over(w) - 1).cast("int"))


def tfidf_weights(docs: DataFrame, vocab: DataFrame, n_train=None, tf: DataFrame | None = None) -> DataFrame:
    """(1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), L2-normalised per document.

    ``vocab`` should be materialised: it is broadcast behind its measured size. ``n_train``
    of None is read from the vocabulary's own column (a saved classifier). ``tf`` may carry
    precomputed term frequencies of ``docs``."""
    tf = term_frequencies(docs) if tf is None else tf
    if n_train is not None:
        vocab = vocab.withColumn("n_train", n_train)
    vocab = vocab.select("term", "term_index", "doc_freq", "n_train")
    idf = F.log((F.lit(1.0) + F.col("n_train")) / (F.lit(1.0) + F.col("doc_freq"))) + 1.0
    w = (1.0 + F.log(F.col("tf").cast("double"))) * idf
    raw = tf.join(bounded_broadcast(vocab), "term") \
        .select("complaint_id", "term", "term_index", w.alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("complaint_id")))
    return raw.select("complaint_id", "term", "term_index", (F.col("w") / norm).alias("weight"))


def _vector(size: int, indices, values):
    """The fields of a sparse vector as Spark ML stores it (type 0 = sparse)."""
    return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                    indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def with_features(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``docs`` with the ``indices`` and ``values`` of its weights, both empty without any."""
    per = (weights.groupBy("complaint_id")
           .agg(F.sort_array(F.collect_list(F.struct("term_index", "weight"))).alias("p")))
    p = F.coalesce("p", F.array().cast("array<struct<term_index:int,weight:double>>"))
    return docs.join(per, "complaint_id", "left").select(
        *docs.columns, F.transform(p, lambda x: x["term_index"]).alias("indices"),
        F.transform(p, lambda x: x["weight"]).alias("values"))


def _row_weights(runs: pa.Array, terms: pa.Array, index: np.ndarray, idf: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """T9 for a batch of ``runs``: each document's term indices, ascending, and their weights."""
    n = len(runs)
    row = pc.list_parent_indices(runs).to_numpy()
    flat = pc.list_flatten(runs)
    at = pc.index_in(flat.field("term"), value_set=terms)
    known = at.is_valid().to_numpy(zero_copy_only=False)
    row, at = row[known], at.drop_null().to_numpy()
    w = (1.0 + np.log(flat.field("tf").to_numpy()[known].astype(np.float64))) * idf[at]
    order = np.lexsort((index[at], row))
    row, at, w = row[order], at[order], w[order]
    w /= np.sqrt(np.bincount(row, w * w, n))[row]
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(index[at])), pa.ListArray.from_arrays(offsets, pa.array(w))


def row_features(runs: DataFrame, vocab: list) -> DataFrame:
    """``runs`` (of ``term_runs``) with ``indices`` and ``values`` in place of the list, as ``with_features``
    has them. ``vocab``: rows of the vocabulary with ``n_train``, bounded by the caller."""
    terms = pa.array([r["term"] for r in vocab], pa.string())
    index = np.array([r["term_index"] for r in vocab], np.int32)
    df, n = (np.array([r[c] for r in vocab], np.float64) for c in ("doc_freq", "n_train"))
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    def weigh(batches):
        for b in batches:
            at = b.schema.get_field_index("runs")
            lists = _row_weights(b.column(at), terms, index, idf)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *lists], names=[*b.schema.names[:at], "indices", "values"])

    small_batches(runs.sparkSession)
    keep = [c for c in runs.columns if c != "runs"]
    schema = StructType([*runs.select(*keep).schema.fields, StructField("indices", ArrayType(IntegerType())),
                         StructField("values", ArrayType(DoubleType()))])
    return runs.select(*keep, "runs").mapInArrow(weigh, schema)


def tfidf_rows(runs: DataFrame, vocab: DataFrame, size: int, bound: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The columns of ``runs`` (of ``term_runs``) with each row's own ``indices`` and ``values``; a row without
    id has none. A vocabulary of more than ``bound`` terms (``size``) is joined by the row's number."""
    runs = runs.withColumn("runs", F.when(F.col("complaint_id").isNotNull(), F.col("runs")))
    if size <= bound:
        return row_features(runs, vocab.select("term", "term_index", "doc_freq", "n_train").collect())
    rows = cut_lineage(runs.withColumn("_row", F.monotonically_increasing_id()))
    own = rows.select(F.col("_row").alias("complaint_id"), "runs")
    lists = with_features(own.select("complaint_id"), tfidf_weights(own, vocab, tf=explode_runs(own)))
    return rows.drop("runs").join(lists.withColumnRenamed("complaint_id", "_row"), "_row").drop("_row")


def tfidf_vectors(runs: DataFrame, vocab: DataFrame, size: int) -> DataFrame:
    """The columns of ``runs`` with the TF-IDF vector ``features`` in place of the list, written to the
    shared folder and read back with the vector type."""
    spark = runs.sparkSession
    rows = tfidf_rows(runs, vocab, size)
    own = [f for f in rows.schema.fields if f.name not in ("indices", "values")]
    folder = checkpoint_path(spark, f"features-{uuid.uuid4().hex}")
    (rows.select(*[f.name for f in own], _vector(size, F.col("indices"), F.col("values")).alias("features"))
     .write.parquet(folder))
    return spark.read.schema(StructType([*own, StructField("features", VectorUDT())])).parquet(folder)


class IssueModel(NamedTuple):
    """A fitted classifier, as the sinks save and load it: ``vocab`` carries ``n_train``."""
    model: LogisticRegressionModel
    vocab: DataFrame
    classes: list[str]

    def pipeline(self) -> PipelineModel:
        """The classifier as one Spark ML model; it is saved and loaded as one folder."""
        from .issue_model import issue_pipeline
        return issue_pipeline(self.vocab, self.model, self.classes)


def score(fitted: IssueModel, docs: DataFrame) -> DataFrame:
    """T14 for new ``docs(complaint_id, consumer_complaint_narrative)``, one row each with
    ``predicted_issue``. ``IssueModel(*load_classifier(spark, path))`` scores as the model
    that was saved; a null or empty narrative has the zero vector."""
    docs = docs.select("complaint_id", "consumer_complaint_narrative")
    return fitted.pipeline().transform(docs).select("complaint_id", "predicted_issue")


ROWS_PER_FIT_PARTITION = 20000


def without_summary(spark: SparkSession, model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model as it is saved, read back. A freshly fitted one carries its training summary, and with
    two classes that holds the session; scoring would send both to the tasks, which fails once the
    session has observed metrics (``DataFrame.observe``)."""
    folder = checkpoint_path(spark, f"model-{uuid.uuid4().hex}")
    model.write().save(folder)
    return LogisticRegressionModel.load(folder)


def train_and_predict(split: DataFrame, th: Thresholds = DEFAULTS) -> tuple[DataFrame, IssueModel]:
    """Fit TF-IDF + multinomial L2 logistic regression on the training rows,
    predict the held-out rows. Raises ValueError when no class is large enough.

    ``split`` should come from ``prepare_split`` (materialised). The rows the optimizer
    iterates over are written once."""
    train = split.where(~F.col("is_test"))
    classes = [r[0] for r in class_counts(train).orderBy("issue").collect()]  # k labels, small
    if not classes:
        raise ValueError(f"no class has {th.min_class_size} usable narratives")
    # Each text is tokenised once: the training rows' words, one row per document, feed the vocabulary
    # and the weights; the held-out rows are scored by the finished model.
    words = cut_lineage(with_words(train, keep=("issue",)))
    runs = term_runs(words, keep=("issue",))
    n_train = train.count()
    vocab = cut_lineage(tfidf_vocab(words, th)
                        .withColumn("n_train", F.lit(float(n_train))))
    size = max(1, vocab.count())
    label_of = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("issue")) - 1
    cw = class_weights(train).select("issue", "weight")
    rows = tfidf_vectors(runs, vocab, size)
    fit_rows = (rows.withColumn("label", label_of.cast("double"))
            .join(bounded_broadcast(cw), "issue", "left"))
    # tol 1e-4 and at most max_iter L-BFGS steps, as the reference's solver settings.
    lr = LogisticRegression(family="multinomial", maxIter=th.max_iter, tol=1e-4,
                            regParam=1.0 / max(n_train, 1),
                            elasticNetParam=0.0, standardization=False, weightCol="weight",
                            featuresCol="features", labelCol="label")
    # Every L-BFGS step is one pass over the training rows; size their partitions
    # by row count (about ROWS_PER_FIT_PARTITION sparse rows each) so per-task
    # overhead does not dominate small inputs while large inputs keep parallelism.
    want = max(1, -(-n_train // ROWS_PER_FIT_PARTITION))
    if want < fit_rows.rdd.getNumPartitions():
        fit_rows = fit_rows.coalesce(want)
    model = without_summary(split.sparkSession, lr.fit(fit_rows))
    fitted = IssueModel(model, vocab, classes)
    held_out = split.where("is_test").select("complaint_id", "issue", "consumer_complaint_narrative")
    out = fitted.pipeline().transform(held_out).select("complaint_id", "issue", "predicted_issue")
    # Reports read the predictions several times: checkpoint them once (reliable
    # checkpoint in the shared folder, so a lost executor does not refit anything).
    return cut_lineage(out), fitted


def classification_report(pred: DataFrame, label: str = "issue",
                          predicted: str = "predicted_issue") -> DataFrame:
    """T15 + T16: per-class precision/recall/F1/support (0 on zero division), then
    accuracy (repeated in every column), macro avg and weighted avg rows."""
    tp = F.count_if(F.col(label) == F.col(predicted))
    by_true = pred.groupBy(F.col(label).alias("issue")).agg(
        F.count(F.lit(1)).alias("support"), tp.alias("tp"))
    by_pred = pred.groupBy(F.col(predicted).alias("issue")).agg(F.count(F.lit(1)).alias("predicted"))
    per = (by_true.join(by_pred, "issue", "full")
           .select("issue", F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("predicted", F.lit(0)).alias("pc")))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pc").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    classes = per.select(
        F.lit(0).alias("row_order"), "issue", p.alias("precision"), r.alias("recall"),
        F.when(p + r > 0, 2.0 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1_score"),
        F.col("support").cast("double").alias("support"))
    agg = classes.agg(
        F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    acc = F.try_divide(pred.agg(F.count_if(F.col(label) == F.col(predicted)).cast("double")).scalar(),
                       F.col("n"))
    def row(order, name, p_, r_, f_, s_):
        return F.struct(F.lit(order).alias("row_order"), F.lit(name).alias("issue"),
                        p_.alias("precision"), r_.alias("recall"), f_.alias("f1_score"),
                        s_.alias("support"))
    n = F.col("n")
    summary = agg.select(F.inline(F.array(
        row(1, "accuracy", acc, acc, acc, acc),
        row(2, "macro avg", F.col("mp"), F.col("mr"), F.col("mf"), n),
        row(3, "weighted avg", F.col("wp") / n, F.col("wr") / n, F.col("wf") / n, n))))
    return classes.unionByName(summary)


def run_summary(split: DataFrame, report: DataFrame) -> DataFrame:
    """One row with split sizes, class count and headline metrics (4 places)."""
    sizes = split.agg(F.count_if(~F.col("is_test")).alias("training_records"),
                      F.count_if("is_test").alias("testing_records"),
                      F.countDistinct("issue").alias("issue_categories"))
    m = report.where(F.col("row_order") > 0)
    get = lambda name, col: m.where(F.col("issue") == name).select(col).scalar()
    return sizes.select("*",
                        F.round(get("accuracy", "precision"), 4).alias("accuracy"),
                        F.round(get("macro avg", "f1_score"), 4).alias("macro_f1"),
                        F.round(get("weighted avg", "f1_score"), 4).alias("weighted_f1"))


def majority_baseline(split: DataFrame) -> DataFrame:
    """Most frequent training class predicted for every held-out row (ties: class name)."""
    top = (class_counts(split.where(~F.col("is_test")))
           .orderBy(F.col("records").desc(), "issue").limit(1).select("issue"))
    return split.where("is_test").select("complaint_id", "issue",
                                         top.scalar().alias("predicted_issue"))

