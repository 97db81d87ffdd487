"""A linear classification head trained step by step (AdamW on mini-batches).

The optimiser's state is a table, a row per class: weights, first and second
moment (the bias is the last coordinate).  A step scores its batch against the
table, sums the gradient per class where the rows are (a partial aggregate
with one vector a class and task), joins it to the state and writes the new state to
the checkpoint folder, so a lost executor costs one step at most and the plan
never grows.  Epochs come from ``epochs.place_in_epoch``; each epoch's rows are
written once, a folder per batch, and a step reads its own folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import metrics as M
from tessera.operators.epochs import place_in_epoch
from tessera.operators.ranking import global_rank
from tessera.session import materialize, scratch_path

TRACE = ("event string, epoch bigint, step bigint, examples_seen bigint, train_loss double, validation_loss double, "
         "train_accuracy double, validation_accuracy double")


@dataclass(frozen=True)
class AdamW:
    rate: float = 0.05
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    decay: float = 0.1

    def update(self, state: DataFrame, gradient: DataFrame) -> DataFrame:
        """State after one more step; a class without gradient has gradient 0.
        The number of steps is a column, so all steps run the same generated code."""
        b1, b2 = F.lit(self.beta1), F.lit(self.beta2)
        g = F.coalesce("g", F.transform("w", lambda x: F.lit(0.0)))
        moved = state.join(gradient, "class", "left").select(
            "class", "w", (F.col("t") + 1).alias("t"),
            F.zip_with("m", g, lambda m, x: b1 * m + (F.lit(1.0) - b1) * x).alias("m"),
            F.zip_with("v", g, lambda v, x: b2 * v + (F.lit(1.0) - b2) * x * x).alias("v"))
        c1, c2 = (F.lit(1.0) - F.pow(b, F.col("t").cast("double")) for b in (b1, b2))
        step = F.zip_with("m", "v", lambda m, v: F.lit(self.rate) * (m / c1) / (F.sqrt(v / c2) + F.lit(self.eps)))
        kept = F.transform("w", lambda w: w * F.lit(1.0 - self.rate * self.decay))
        return moved.select("class", F.zip_with(kept, step, lambda w, s: w - s).alias("w"), "t", "m", "v")


def as_head(state: DataFrame) -> DataFrame:
    """(class, w, b) of rows whose vector ends in 1."""
    return state.select("class", "w", F.lit(0.0).alias("b"))


def gradient(batch: DataFrame, state: DataFrame, rows: int, size: tuple[int, int]) -> DataFrame:
    """(class, g): gradient of the batch's mean cross-entropy, summed per class.
    ``batch`` has ``id``, ``x`` (ending in 1) and ``label``."""
    scored = M.with_logits(batch, as_head(state), "x", "id", size)
    share = F.zip_with("classes", A.softmax(F.col("logits")), lambda c, p: F.struct(
        c.alias("class"), (p - F.when(c == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0))).alias("d")))
    each = scored.select("x", F.explode(share).alias("s"))
    vector = array_to_vector(F.transform("x", lambda x: x * F.col("s.d")))
    return (each.groupBy(F.col("s.class").alias("class")).agg(Summarizer.sum(vector).alias("g"))
            .select("class", F.transform(vector_to_array("g"), lambda x: x / F.lit(float(rows))).alias("g")))


def _measured(train: DataFrame, validation: DataFrame, head: DataFrame, size: tuple[int, int]) -> DataFrame:
    """One row: two-level loss and accuracy of both; loss NaN and accuracy null
    without rows."""
    both = train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    per = M.batch_table(M.predictions(M.with_logits(both, head, "x", "id", size)))
    return M.report(per, ("train", "validation")).groupBy().pivot("split", ["train", "validation"]).agg(
        F.first("loss").alias("loss"), F.first("accuracy").alias("accuracy"))


def train_head(train: DataFrame, validation: DataFrame, id_col: str, vec_col: str, label_col: str, *,
               epochs: int, batch_size: int, seed: int, eval_freq: int | None, eval_batches: int,
               optimiser: AdamW | None = None) -> tuple[DataFrame, DataFrame]:
    """(trace, state).  The trace has a row of losses for every step whose number
    (from 0) divides by ``eval_freq``, and a row of accuracies at the end of
    every epoch, both over the first ``eval_batches`` batches of the epoch's
    training order and of the validation rows by id; ``eval_freq`` None: no trace.
    Training drops a short
    last batch; without a full batch the weights stay 0.  Losses of an empty side are NaN."""
    optimiser = optimiser or AdamW()
    spark = train.sparkSession

    def rows(df: DataFrame) -> DataFrame:
        x = F.concat(A.as_double(F.col(vec_col)), F.array(F.lit(1.0)))
        return df.select(F.col(id_col).alias("id"), x.alias("x"), F.col(label_col).cast("bigint").alias("label"))

    numbered = materialize(global_rank(rows(train), ["id"], "row"))
    n, width = numbered.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    held = materialize(global_rank(rows(validation), ["id"], "row").withColumn(
        "batch_id", F.floor(F.col("row") / F.lit(batch_size)).cast("bigint")).where(
        F.col("batch_id") < eval_batches).drop("row"))
    zero = F.array_repeat(F.lit(0.0), width)
    state = materialize(numbered.select(F.col("label").alias("class")).where("class is not null").distinct().select(
        "class", zero.alias("w"), F.lit(0).cast("bigint").alias("t"), zero.alias("m"), zero.alias("v")))
    size = M.head_size(state)
    per_epoch, step, events = n // batch_size, -1, []

    def event(kind: str, epoch: int, order: DataFrame) -> DataFrame:
        got = _measured(order.where(F.col("batch_id") < eval_batches), held, as_head(state), size)
        none = F.lit(None).cast("double")
        loss, acc = kind == "step", kind == "epoch"
        return got.select(F.lit(kind).alias("event"), F.lit(epoch).cast("bigint").alias("epoch"),
                          F.lit(step).cast("bigint").alias("step"),
                          F.lit((step + 1) * batch_size).cast("bigint").alias("examples_seen"),
                          *[(F.col(f"{s}_loss") if loss else none).alias(f"{s}_loss") for s in ("train", "validation")],
                          *[(F.col(f"{s}_accuracy") if acc else none).alias(f"{s}_accuracy") for s in ("train", "validation")])

    for epoch in range(epochs):
        order = numbered.withColumn("place", place_in_epoch(F.col("row"), n, seed, epoch)).withColumn(
            "batch_id", F.floor(F.col("place") / F.lit(batch_size)).cast("bigint")).where(F.col("batch_id") < per_epoch)
        path = scratch_path(spark, "epoch")
        (order.select("id", "x", "label", "batch_id").repartitionByRange("batch_id", "id")
         .write.partitionBy("batch_id").parquet(path))
        order = (spark.read.schema("id bigint, x array<double>, label bigint, batch_id bigint").parquet(path)
                 if per_epoch else order.select("id", "x", "label", "batch_id"))
        for k in range(per_epoch):
            step += 1
            grad = gradient(order.where(F.col("batch_id") == k), state, batch_size, size)
            state = materialize(optimiser.update(state, grad))
            if eval_freq and step % eval_freq == 0:
                events.append(event("step", epoch, order))
        if eval_freq:
            events.append(event("epoch", epoch, order))
    trace = events[0] if events else spark.createDataFrame([], TRACE)
    for e in events[1:]:
        trace = trace.unionByName(e)
    return trace, state
