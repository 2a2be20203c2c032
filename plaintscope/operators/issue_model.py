"""The issue classifier as one saved model (A12, T14): raw narratives in, issue names out.

``NarrativeTfidf`` learns the vocabulary of a narrative column (T6, G8); its model adds the TF-IDF
vector (T9). With a logistic regression and the names of the classes it makes a ``PipelineModel``
that is saved as one folder and scores narratives in any session that can import this package.

``transform`` keeps the input's columns and rows (repeated ones too), so a table needs no id: rows
are numbered when they are written to the shared folder, and the vector is joined to the number. It is
therefore not lazy, as the vocabulary's size is measured before it is broadcast. Null and empty
narratives have the zero vector. Input columns named like the output columns are an error.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..session import cut_lineage
from . import classify as K

_ROW = "__row"


class _Columns(HasInputCol, HasOutputCol):
    def _check(self, df: DataFrame) -> None:
        taken = {c.lower() for c in df.columns} & {self.getOutputCol().lower(), _ROW}
        if taken:
            raise ValueError(f"the input already has a column {', '.join(sorted(taken))}")


class NarrativeTfidf(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the terms (words and bigrams) of ``inputCol`` and their document frequencies."""

    minDocFreq = Param(Params._dummy(), "minDocFreq", "narratives a term must occur in", TypeConverters.toInt)
    maxVocab = Param(Params._dummy(), "maxVocab", "most frequent terms kept", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="consumer_complaint_narrative", outputCol="features",
                 minDocFreq=DEFAULTS.min_doc_freq, maxVocab=DEFAULTS.max_vocab):
        super().__init__()
        self._setDefault(inputCol="consumer_complaint_narrative", outputCol="features",
                         minDocFreq=DEFAULTS.min_doc_freq, maxVocab=DEFAULTS.max_vocab)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> NarrativeTfidfModel:
        th = Thresholds(min_doc_freq=self.getOrDefault("minDocFreq"), max_vocab=self.getOrDefault("maxVocab"))
        docs = cut_lineage(df.select(F.monotonically_increasing_id().alias("complaint_id"),
                                     F.col(self.getInputCol()).alias("consumer_complaint_narrative")))
        vocab = K.tfidf_vocab(docs, th).withColumn("n_train", F.lit(float(docs.count())))
        return self._copyValues(NarrativeTfidfModel(cut_lineage(vocab)))


class NarrativeTfidfModel(Model, _Columns, MLReadable, MLWritable):
    """Adds ``outputCol``, the TF-IDF vector of ``inputCol``."""

    def __init__(self, vocab: DataFrame | None = None, size: int | None = None):
        super().__init__()
        self._setDefault(inputCol="consumer_complaint_narrative", outputCol="features")
        self.vocab = vocab
        self._size = size

    @property
    def size(self) -> int:
        """Length of the vectors."""
        if self._size is None:
            self._size = max(1, self.vocab.count())
        return self._size

    def _transform(self, df: DataFrame) -> DataFrame:
        self._check(df)
        rows = cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()))
        docs = rows.select(F.col(_ROW).alias("complaint_id"),
                           F.col(self.getInputCol()).alias("consumer_complaint_narrative"))
        vectors = K.tfidf_vectors(K.term_runs(docs), self.vocab, self.size)
        vectors = vectors.select(F.col("complaint_id").alias(_ROW), F.col("features").alias(self.getOutputCol()))
        return rows.join(vectors, _ROW).drop(_ROW)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: NarrativeTfidfModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"size": self.model.size})
        self.model.vocab.write.parquet(os.path.join(path, "vocab"))


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> NarrativeTfidfModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(os.path.join(path, "vocab")), meta["size"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def issue_pipeline(vocab: DataFrame, model: LogisticRegressionModel, classes: list[str]) -> PipelineModel:
    """The parts of a fitted classifier as one model from narratives to ``predicted_issue``."""
    names = IndexToString(inputCol=model.getPredictionCol(), outputCol="predicted_issue", labels=classes)
    return PipelineModel([NarrativeTfidfModel(vocab, model.numFeatures), model, names])
