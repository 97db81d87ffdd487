"""Linear head on vectors and the evaluation metrics around it.

The head is a table, a row per class: ``class``, ``w`` (its weights) and ``b``
(its bias).  The nearest-centroid head has W[c] = mean of class c's training
vectors and b[c] = -|W[c]|^2 / 2, so argmax(W.x + b) is the closest centroid; its
fit is a partial/final aggregate per (class, dim).

Scoring is a blocked product: classes are dealt into blocks of about
``CLASS_BLOCK``, rows meet the blocks in a join, and a row's pieces are put
together by its id where there are several.  A head of up to
``BROADCAST_VALUES`` weights is broadcast (its size is counted first); a larger
one is shuffled, with the block keys salted so that no block is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.session import materialize, shuffle_partitions

CLASS_BLOCK = 256
BROADCAST_VALUES = 4_000_000


def fit_centroids(train: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """The nearest-centroid head (class, w, b) of the labelled vectors."""
    per_dim = (A.rows_of(train, [F.col(label_col).cast("bigint").alias("class")], A.as_double(F.col(vec_col)), "dim", "x")
               .groupBy("class", "dim").agg(F.avg("x").alias("m")))
    model = (per_dim.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("dim", "m"))).alias("s"))
             .select("class", F.transform("s", lambda x: x["m"]).alias("w")))
    return materialize(model.select("class", "w", (F.lit(-0.5) * A.dot(F.col("w"), F.col("w"))).alias("b")))


def head_size(head: DataFrame) -> tuple[int, int]:
    """(classes, weights): two scalars."""
    return tuple(head.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("w")), F.lit(0))).first())


def with_logits(df: DataFrame, head: DataFrame, vec_col: str, id_col: str = "vec_id",
                size: tuple[int, int] | None = None) -> DataFrame:
    """Adds ``classes`` (ascending) and ``logits`` (their W.x + b); both empty
    where the head has no classes.  ``id_col`` identifies the rows; ``size`` is
    the head's ``head_size`` where it is known."""
    size = size or head_size(head)
    n_blocks = max(1, -(-size[0] // CLASS_BLOCK))
    blocks = (head.groupBy(F.pmod(F.xxhash64("class"), F.lit(n_blocks)).cast("int").alias("_block"))
              .agg(F.sort_array(F.collect_list(F.struct("class", "w", "b"))).alias("_rows")))
    rows = df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))) if n_blocks > 1 else \
        df.withColumn("_block", F.lit(0))
    if size[1] <= BROADCAST_VALUES:
        met = rows.join(F.broadcast(blocks), "_block", "left")
    else:
        salts = 2 * shuffle_partitions(df.sparkSession)
        salted = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")).join(
            salted, ["_block", "_salt"], "left").drop("_salt")
    score = F.transform("_rows", lambda c: F.struct(c["class"].alias("class"), (
        A.dot(A.as_double(F.col(vec_col)), c["w"]) + c["b"]).alias("value")))
    met = met.withColumn("_scores", score).drop("_rows", "_block")
    if n_blocks > 1:  # a row's pieces together
        whole = met.groupBy(id_col).agg(F.sort_array(F.flatten(F.collect_list("_scores"))).alias("_scores"))
        met = df.join(whole, id_col)
    none = F.array().cast("array<struct<class:bigint,value:double>>")
    met = met.withColumn("_scores", F.coalesce("_scores", none))
    return (met.withColumn("classes", F.transform("_scores", lambda x: x["class"]))
            .withColumn("logits", F.transform("_scores", lambda x: x["value"])).drop("_scores"))


def per_class(df: DataFrame, id_col: str, values) -> DataFrame:
    """Explode an array of per-class values to (id, class, value)."""
    both = F.arrays_zip(F.col("classes").alias("class"), F.col(values).alias("value") if isinstance(values, str)
                        else values.alias("value"))
    return A.rows_of(df, [id_col], both, "_i", "_v").select(id_col, "_v.class", "_v.value")


def predictions(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds ``predicted`` (argmax class, ties -> lowest class) and ``nll`` of the
    true label: infinite for a label that the head has no class for."""
    at = F.array_position("classes", F.col(label_col).cast("bigint")).cast("int")
    best = A.argmax(F.col("logits")) + 1
    return (df.withColumn("predicted", F.when(F.size("classes") > 0, F.element_at("classes", F.greatest(best, F.lit(1)))))
              .withColumn("nll", F.when(at > 0, A.nll(F.col("logits"), F.greatest(at, F.lit(1)) - 1))
                          .otherwise(F.lit(float("inf")))))


def batch_table(df: DataFrame) -> DataFrame:
    """One row per (split, batch): rows, correct predictions, summed loss; every
    metric below can be read from it."""
    return df.groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted") == F.col("label")).alias("correct"),
        F.sum("nll").alias("nll"))


def report(per_batch: DataFrame, splits=("train", "validation", "test"), acc_batches: int | None = None,
           loss_batches: int | None = None) -> DataFrame:
    """Rows, batches, accuracy (row-weighted) and two-level loss (mean of the
    batches' means) of every split in ``splits``, over its first batches where a
    number is given.  A split without rows has 0 rows, accuracy null and loss NaN."""
    def first(n: int | None):
        return F.lit(True) if n is None else F.col("batch_id") < F.lit(n)

    got = per_batch.groupBy("split").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_batches"),
        (F.sum(F.when(first(acc_batches), F.col("correct"))) / F.sum(F.when(first(acc_batches), F.col("n")))
         ).alias("accuracy"),
        F.avg(F.when(first(loss_batches), F.col("nll") / F.col("n"))).alias("loss"))
    names = per_batch.sparkSession.createDataFrame([(s,) for s in splits], "split STRING")
    return names.join(got, "split", "left").select(
        "split", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.coalesce("n_batches", F.lit(0)).cast("long").alias("n_batches"), "accuracy",
        F.coalesce("loss", F.lit(float("nan"))).alias("loss"))


def accuracy_by(df: DataFrame, group_cols: list[str], num_batches: int | None = None) -> DataFrame:
    """Row-weighted accuracy over the first ``num_batches`` batches of each
    group: sum(correct) / rows.  No rows -> null."""
    if num_batches is not None:
        df = df.where(F.col("batch_id") < F.lit(num_batches))
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("accuracy"))


def loss_by(df: DataFrame, group_cols: list[str], num_batches: int | None = None) -> DataFrame:
    """Two-level cross-entropy: mean inside each batch, then a plain mean over
    batches (a short last batch weighs as much as a full one)."""
    if num_batches is not None:
        df = df.where(F.col("batch_id") < F.lit(num_batches))
    per_batch = df.groupBy(*group_cols, "batch_id").agg(F.avg("nll").alias("_b"))
    return per_batch.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_batches"),
                                              F.avg("_b").alias("loss"))
