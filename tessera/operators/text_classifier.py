"""Naive Bayes over any tokenizer as a ``pyspark.ml`` Estimator and Model.

The model is two tables (``operators.classify.NaiveBayes``), saved as Parquet
beside the parameters, so it fits in a Pipeline, a CrossValidator and the
usual save and load, for any number of classes and tokens.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.tokenizers import CHARACTERS, SPACED, WORDS
from tessera.operators import classify as CL
from tessera.operators import tokens as TK
from tessera.session import store

TOKENIZERS = {t.name: t for t in (WORDS, SPACED, CHARACTERS)}
_KEY = "_text_key"


class _TextParams(HasLabelCol, HasPredictionCol):
    textCol = Param(Params._dummy(), "textCol", "column of the text", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "count added to every token of a class", TypeConverters.toFloat)
    tokenizer = Param(Params._dummy(), "tokenizer", f"name of the tokenizer: {', '.join(TOKENIZERS)}",
                      TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(textCol="text", labelCol="label", predictionCol="prediction", smoothing=1.0,
                         tokenizer=WORDS.name)

    def _tokenizer(self):
        return TOKENIZERS[self.getOrDefault("tokenizer")]

    def _texts(self, data: DataFrame):
        """Text (null: empty) and the key under which equal texts are one."""
        return F.coalesce(F.col(self.getOrDefault("textCol")), F.lit(""))


class TextClassifier(Estimator, _TextParams, MLWritable, MLReadable):
    """Fits naive Bayes on (text, label).  Rows without a label are left out, null text counts as
    empty, repeated rows count each; other columns are not read.  A table without labelled
    rows gives a model that predicts null."""

    @keyword_only
    def __init__(self, *, textCol="text", labelCol="label", predictionCol="prediction", smoothing=1.0,
                 tokenizer="words"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextClassifierModel:
        rows = store(dataset.where(F.col(self.getLabelCol()).isNotNull()).select(
            self._tokenizer().tokens(self._texts(dataset)).alias("tokens"),
            F.col(self.getLabelCol()).cast("bigint").alias("class")))
        tokens = rows.select("class", F.explode_outer("tokens").alias("token")).where("token is not null")
        fitted = CL.train_naive_bayes(tokens, rows.select("class"), "class", self.getOrDefault("smoothing"))
        fitted.pairs = store(fitted.pairs)
        return self._copyValues(TextClassifierModel(fitted))

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class TextClassifierModel(Model, _TextParams, MLWritable, MLReadable):
    """Adds ``predictionCol`` (double).  Every row of the input stays, equal texts are scored once, and
    the prediction depends on nothing but the text."""

    def __init__(self, fitted: CL.NaiveBayes | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keyed = dataset.withColumn(_KEY, F.sha2(self._texts(dataset), 256))
        texts = store(dataset.select(self._texts(dataset).alias("text")).groupBy(
            F.sha2("text", 256).alias(_KEY)).agg(F.min("text").alias("text")))
        tokens = TK.token_blocks(texts, _KEY, counted=True, tokenizer=self._tokenizer())
        out = CL.classify_naive_bayes(self.fitted, tokens, texts, _KEY).select(
            _KEY, F.col("predicted").cast("double").alias(self.getPredictionCol()))
        return keyed.join(out, _KEY, "left").drop(_KEY)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.fitted = self.fitted
        return out

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, model: TextClassifierModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.fitted.save(f"{path}/data")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TextClassifierModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(CL.NaiveBayes.load(self.sparkSession, f"{path}/data"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
