"""The classifier as one model: saved, loaded in another session, checked against a closed form."""

import math
import re
import subprocess
import sys
import textwrap
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel

from plaintscope.config import Thresholds
from plaintscope.functions.text import STOP_WORDS
from plaintscope.operators import classify as K
from plaintscope.operators.issue_model import NarrativeTfidf, NarrativeTfidfModel

TEXT = "consumer_complaint_narrative"
WORDS = {"a": "card charge dispute merchant", "b": "loan payment late fee", "c": "account closed card fee"}
ROWS = [(i, c, " ".join(WORDS[c].split()[i % 3:] + [f"word{i % 9}", "the", WORDS["abc"[i % 2]].split()[i % 4]]))
        for i, c in enumerate("abc" * 60)]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(ROWS, f"complaint_id long, issue string, {TEXT} string")
    split = K.prepare_split(df)
    return (split, *K.train_and_predict(split))


def terms(text):
    words = [w for w in re.findall(r"\w{2,}", (text or "").lower()) if w not in STOP_WORDS]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def closed_form(train, coefficients, intercepts, classes, texts):
    """TF-IDF and scores written out: vocabulary by total count, then the greatest linear score."""
    counts = [terms(t) for t in train]
    df = Counter(t for c in counts for t in c)
    total = Counter()
    for c in counts:
        total.update(c)
    vocab = {t: i for i, t in enumerate(sorted((t for t in df if df[t] >= 3), key=lambda t: (-total[t], t)))}
    out = []
    for text in texts:
        w = {vocab[t]: (1 + math.log(n)) * (math.log((1 + len(train)) / (1 + df[t])) + 1)
             for t, n in terms(text).items() if t in vocab}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        scores = [b + sum(row[i] * v / norm for i, v in w.items()) for row, b in zip(coefficients, intercepts)]
        out.append(classes[scores.index(max(scores))])
    return out


def test_predictions_equal_the_closed_form(fitted):
    split, pred, model = fitted
    train = [r[TEXT] for r in split.where("not is_test").collect()]
    test = {r.complaint_id: r[TEXT] for r in split.where("is_test").collect()}
    got = {r.complaint_id: r.predicted_issue for r in pred.collect()}
    want = closed_form(train, model.model.coefficientMatrix.toArray().tolist(), model.model.interceptVector.toArray().tolist(),
                       model.classes, list(test.values()))
    assert got == dict(zip(test, want)) and len(set(want)) == 3


def test_one_folder_scores_raw_text_in_a_fresh_session(spark, fitted, tmp_path):
    split, pred, model = fitted
    at, texts = str(tmp_path / "model"), str(tmp_path / "texts")
    model.pipeline().write().overwrite().save(at)
    model.pipeline().write().overwrite().save(at)  # saved again over itself
    split.where("is_test").select("complaint_id", TEXT).write.parquet(texts)
    want = sorted((r.complaint_id, r.predicted_issue) for r in pred.collect())
    loaded = PipelineModel.load(at)
    got = loaded.transform(spark.read.parquet(texts))
    assert sorted((r.complaint_id, r.predicted_issue) for r in got.collect()) == want
    code = textwrap.dedent(f"""
        from pyspark.ml import PipelineModel
        from plaintscope.session import get_spark
        spark = get_spark("fresh", master="local[2]", shuffle_partitions=2)
        out = PipelineModel.load({at!r}).transform(spark.read.parquet({texts!r}))
        print("GOT", sorted((r.complaint_id, r.predicted_issue) for r in out.collect()))""")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, check=True)
    assert f"GOT {want}" in run.stdout


def test_transform_keeps_rows_and_columns(spark, fitted):
    model = fitted[2].pipeline().stages[0]
    df = spark.createDataFrame([(None, "late loan payment", 1), (None, "late loan payment", 1), (7, None, 2), (8, "", 3),
                                (9, "zzz " * 50_000, 4)], f"complaint_id long, {TEXT} string, term int")
    out = model.transform(df)
    assert out.columns == ["complaint_id", TEXT, "term", "features"] and out.count() == 5
    by = {r.term: r.features for r in out.collect()}
    assert by[1].numNonzeros() > 0 and abs(by[1].norm(2) - 1) < 1e-9
    assert by[2].numNonzeros() == by[3].numNonzeros() == by[4].numNonzeros() == 0
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="features"):
        model.transform(out)


def test_estimator_fits_inside_a_pipeline_and_is_saved(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "complaint_id long, issue string, body string").drop("complaint_id")
    stage = NarrativeTfidf(inputCol="body", outputCol="v", minDocFreq=5, maxVocab=12)
    Pipeline(stages=[stage]).write().save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p")).getStages()[0]
    assert (again.getInputCol(), again.getOrDefault("minDocFreq")) == ("body", 5)
    model = Pipeline(stages=[again]).fit(df)
    tfidf = model.stages[0]
    assert isinstance(tfidf, NarrativeTfidfModel) and tfidf.size == 12
    docs = spark.createDataFrame(ROWS, f"complaint_id long, issue string, {TEXT} string")
    want = K.tfidf_vocab(docs, Thresholds(min_doc_freq=5, max_vocab=12))
    cols = ["term", "term_index", "doc_freq"]
    assert sorted(map(tuple, tfidf.vocab.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert model.transform(df).select("v").first().v.size == 12
