"""Text classifiers: multinomial naive Bayes (exact, checkable) and a
``pyspark.ml`` logistic-regression head on frozen hashed features.

Train/score contract of the studied classifier: fit on labelled rows, score
any table, name the class ("spam" / "not spam"), save and load the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tokenizers import WORDS, Tokenizer
from tessera.operators import blocks as BL
from tessera.operators.lookup import salted_lookup
from tessera.session import materialize, store

#: Classes of one row of the class blocks that documents are scored against.
CLASS_BLOCK = 1024


@dataclass
class NaiveBayes:
    """Fitted model, all of it tables: ``classes`` (class, log_prior,
    log_unseen, n_tokens) and the observed ``pairs`` (class, token, log_p,
    gain, n), where gain = log_p - log_unseen > 0."""
    classes: DataFrame
    pairs: DataFrame

    def token_table(self) -> DataFrame:
        """(token, seen ARRAY<STRUCT<class, gain>>, freq): only observed classes."""
        return self.pairs.groupBy("token").agg(F.collect_list(F.struct("class", "gain")).alias("seen"),
                                               F.sum("n").alias("freq"))

    def save(self, path: str) -> None:
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        self.pairs.write.mode("overwrite").parquet(f"{path}/pairs")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NaiveBayes:
        return NaiveBayes(spark.read.parquet(f"{path}/classes"), spark.read.parquet(f"{path}/pairs"))


def train_naive_bayes(labelled_tokens: DataFrame, labelled_docs: DataFrame, class_col: str,
                      alpha: float = 1.0) -> NaiveBayes:
    """``labelled_tokens`` (doc_id, token, class_col), ``labelled_docs``
    (doc_id, class_col).  log p(t|c) = ln((n_ct + a) / (N_c + a|V|)).  Any
    number of classes; two scalars (documents, vocabulary size) reach the driver."""
    counts = store(labelled_tokens.groupBy(F.col(class_col).cast("bigint").alias("class"), "token").agg(
        F.count(F.lit(1)).alias("n")))
    v = counts.agg(F.countDistinct("token")).first()[0] or 0
    docs = labelled_docs.groupBy(F.col(class_col).cast("bigint").alias("class")).agg(F.count(F.lit(1)).alias("_d"))
    total = docs.agg(F.sum("_d")).first()[0] or 0
    tokens = counts.groupBy("class").agg(F.sum("n").alias("n_tokens"))
    denom = F.coalesce("n_tokens", F.lit(0)) + F.lit(alpha * v)
    classes = materialize(docs.join(tokens, "class", "left").select(
        "class", F.log(F.col("_d") / F.lit(float(total))).alias("log_prior"),
        F.when(denom > 0, F.log(F.lit(alpha) / denom)).otherwise(F.lit(float("-inf"))).alias("log_unseen"),
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")))
    per_class = classes.select("class", "log_unseen", "n_tokens", F.col("n_tokens").alias("freq"))
    pairs = salted_lookup(counts, per_class, "class", ["token"], how="inner", unique=True)
    log_p = F.log((F.col("n") + F.lit(alpha)) / (F.col("n_tokens") + F.lit(alpha * v)))
    return NaiveBayes(classes, pairs.select("class", "token", log_p.alias("log_p"),
                                            (log_p - F.col("log_unseen")).alias("gain"), "n"))


def classify_naive_bayes(model: NaiveBayes, tokens: DataFrame | BL.Blocks, docs: DataFrame,
                         id_col: str = "doc_id") -> DataFrame:
    """(id, predicted): argmax_c prior_c + sum_t count(t) log p(t|c); tokens
    outside the training vocabulary are ignored; ties -> lowest class.
    ``tokens``: token rows (id, token), or counted blocks of the documents,
    whose distinct tokens alone meet the model.

    A class that saw none of a document's T known tokens scores
    prior + T * log_unseen; one that saw some gains on top of it.  So the best
    of all classes on the first formula, one answer per distinct T, against the
    classes observed for the document gives the argmax without a row for every
    (document, class)."""
    if isinstance(tokens, BL.Blocks):
        found = BL.class_sums(tokens, model.token_table().drop("freq"), F.col("seen"))
        sums = found.groupBy(id_col, "class").agg(F.sum("_x").alias("_x"))
    else:
        counted = tokens.groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("_c"))
        looked = salted_lookup(counted, model.token_table(), "token", [id_col, "token"], how="inner", unique=True)
        # a null class stands for the document itself: its number of known tokens
        own = F.array(F.struct(F.lit(None).cast("bigint").alias("class"), F.lit(1.0).alias("gain")))
        sums = (looked.select(id_col, "_c", F.explode_outer(F.concat(own, "seen")).alias("_s"))
                .groupBy(id_col, F.col("_s.class").alias("class")).agg(F.sum(F.col("_c") * F.col("_s.gain")).alias("_x")))
    sums = materialize(sums)
    known = (docs.select(id_col).join(sums.where(F.col("class").isNull()).select(id_col, F.col("_x").alias("_t")),
                                      id_col, "left").fillna(0.0, ["_t"]))

    def score(extra):
        return F.struct((F.col("log_prior") + F.col("_t") * F.col("log_unseen") + extra).alias("s"),
                        (-F.col("class")).alias("c"))

    seen = (sums.where(F.col("class").isNotNull()).join(known, id_col)
            .join(model.classes, "class").groupBy(id_col).agg(F.max(score(F.col("_x"))).alias("_seen")))
    n_blocks = max(1, -(-model.classes.count() // CLASS_BLOCK))  # scalar
    blocks = (model.classes.groupBy(F.pmod(F.xxhash64("class"), F.lit(n_blocks)).alias("_block"))
              .agg(F.collect_list(F.struct("class", "log_prior", "log_unseen")).alias("_all")))
    by_length = (known.select("_t").distinct()
                 .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
                 .join(blocks, "_block"))
    plain = by_length.select("_t", F.array_max(F.transform("_all", lambda c: F.struct(
        (c["log_prior"] + F.col("_t") * c["log_unseen"]).alias("s"), (-c["class"]).alias("c")))).alias("_best"))
    plain = plain.groupBy("_t").agg(F.max("_best").alias("_plain"))
    return (known.join(plain, "_t", "left").join(seen, id_col, "left")
            .select(id_col, (-F.greatest("_seen", "_plain")["c"]).alias("predicted")))


def class_name(pred_col: str = "predicted") -> F.Column:
    """1 -> "spam", anything else -> "not spam"."""
    return F.when(F.col(pred_col) == 1, "spam").otherwise("not spam")


def linear_head_estimator(num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.01,
                         label_col: str = "label") -> Pipeline:
    """Frozen features (hashed term frequencies of word tokens, IDF) + a trained
    linear head (logistic regression, distributed tree aggregation)."""
    return Pipeline(stages=[
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter, regParam=reg),
    ])


def with_tokens(df: DataFrame, text_col: str = "text", tokenizer: Tokenizer = WORDS) -> DataFrame:
    return df.withColumn("tokens", tokenizer.tokens(text_col))


def fit_linear_head(train: DataFrame, label_col: str = "label", tokenizer: Tokenizer = WORDS, **kw) -> PipelineModel:
    data = with_tokens(train, tokenizer=tokenizer).withColumn(label_col, F.col(label_col).cast("double"))
    return linear_head_estimator(label_col=label_col, **kw).fit(data)


def score_linear_head(model: PipelineModel, df: DataFrame, id_col: str = "doc_id",
                      tokenizer: Tokenizer = WORDS) -> DataFrame:
    out = model.transform(with_tokens(df, tokenizer=tokenizer))
    return out.select(id_col, F.col("prediction").cast("bigint").alias("predicted"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def objective_trace(model: PipelineModel) -> list[float]:
    """Loss per solver iteration of the fitted head (small list)."""
    return list(model.stages[-1].summary.objectiveHistory)
