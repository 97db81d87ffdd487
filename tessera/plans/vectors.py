"""Registered queries: vector head, metrics, vector operators, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import metrics as M
from tessera.operators import vectors as V
from tessera.operators.conversations import until_exit
from tessera.operators.ranking import rank_within_groups, running_total
from tessera.operators.sampling import shuffle_key, three_way_split
from tessera.operators import tokens as TK
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import load_table

SOFT_WINDOW, CONTEXT_WINDOW, HEADS = 16, 1024, 4


def _r6(c):
    return F.round(c, 6)


def embedded_splits(spark, d):
    """embeddings + split (70/10/20 seeded) + fitted centroid head + logits."""
    emb = load_table(spark, d, "embeddings")
    split = three_way_split(emb.select("vec_id"), "vec_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC)
    e = emb.join(split.select("vec_id", "split"), "vec_id")
    head = M.fit_centroids(e.where(F.col("split") == "train"), "embedding", "label")
    return M.with_logits(e, head, "embedding")


def loader_keys(spark, d):
    """(vec_id, split, batch_id): train in seeded shuffled order with drop_last,
    the other splits in id order, short last batch kept.  Only keys are ranked."""
    ids = load_table(spark, d, "embeddings").select("vec_id")
    split = three_way_split(ids, "vec_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC).select("vec_id", "split")
    key = F.when(F.col("split") == "train", shuffle_key(C.SEED, "vec_id")).otherwise(F.lit(""))
    ranked = rank_within_groups(split.withColumn("_key", key), ["split"], ["_key", "vec_id"], "_r")
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}  # <= 3 scalars
    keep_train = sizes.get("train", 0) // C.BATCH
    b = ranked.select("vec_id", "split", F.floor(F.col("_r") / F.lit(C.BATCH)).cast("bigint").alias("batch_id"))
    return split, b.where((F.col("split") != "train") | (F.col("batch_id") < F.lit(keep_train)))


def batch_metrics(spark, d):
    """Rows, correct predictions and loss per (split, batch) of the centroid head."""
    split, keys = loader_keys(spark, d)
    emb = load_table(spark, d, "embeddings")
    head = M.fit_centroids(emb.join(split.where(F.col("split") == "train"), "vec_id"), "embedding", "label")
    e = M.predictions(M.with_logits(emb.join(keys, "vec_id"), head, "embedding"))
    return M.batch_table(e)


@query("centroid_logits")
def centroid_logits(spark, d):
    e = embedded_splits(spark, d)
    return M.per_class(e, "vec_id", F.col("logits")).withColumn("value", _r6(F.col("value")))


@query("softmax")
def softmax(spark, d):
    e = embedded_splits(spark, d)
    return M.per_class(e, "vec_id", A.softmax(F.col("logits"))).withColumn("value", _r6(F.col("value")))


@query("argmax_class")
def argmax_class(spark, d):
    e = embedded_splits(spark, d)
    return M.predictions(e).select("vec_id", "predicted")


@query("top_k_logits")
def top_k_logits(spark, d):
    e = embedded_splits(spark, d)
    return (M.per_class(e, "vec_id", A.top_k_mask(F.col("logits"), C.TOP_K))
            .withColumn("value", _r6(F.col("value"))))


def _report(spark, d, **first):
    r = M.report(batch_metrics(spark, d), **first)
    return r.withColumn("accuracy", _r6(F.col("accuracy"))).withColumn("loss", _r6(F.col("loss")))


@query("accuracy")
def accuracy(spark, d):
    return _report(spark, d).select("split", "n", "accuracy")


@query("cross_entropy")
def cross_entropy(spark, d):
    return _report(spark, d).select("split", "n_batches", "loss")


@query("split_report")
def split_report(spark, d):
    return _report(spark, d).select("split", "n", "accuracy", "loss")


@query("eval_first_batches")
def eval_first_batches(spark, d):
    """The quick evaluation: accuracy over the first 10 batches and loss over
    the first 5 batches of each split (fewer if a split has fewer)."""
    return _report(spark, d, acc_batches=10, loss_batches=5).select("split", "accuracy", "loss")


def _train_batches(spark, d):
    _, keys = loader_keys(spark, d)
    return keys.where(F.col("split") == "train").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("examples_seen")
def examples_seen(spark, d):
    """Running count of examples in batch order, whatever the batch sizes."""
    per = _train_batches(spark, d).withColumn("_all", F.lit(0))
    before = running_total(per, ["_all"], ["batch_id"], "n", "_before")
    return before.select("batch_id", "n", (F.col("_before") + F.col("n")).cast("bigint").alias("examples_seen"))


@query("eval_steps")
def eval_steps(spark, d):
    """Evaluation steps over EPOCHS passes of the training loader: the global
    step counts from 0 and an evaluation happens when step % EVAL_FREQ == 0."""
    per = _train_batches(spark, d)
    nb = per.count()  # scalar: batches per epoch
    steps = (per.select("batch_id", "n", F.explode(F.sequence(F.lit(0), F.lit(C.EPOCHS - 1))).alias("epoch"))
             .withColumn("step", (F.col("epoch") * F.lit(nb) + F.col("batch_id")).cast("bigint")))
    return (steps.where(F.col("step") % C.EVAL_FREQ == 0)
            .select(F.col("epoch").cast("bigint").alias("epoch"), "step",
                    ((F.col("step") + 1) * C.BATCH).cast("bigint").alias("examples_seen")))


def _vec_rows(df, id_col="vec_id", vec="vec"):
    return (A.rows_of(df, [id_col], vec, "dim")
            .select(id_col, F.col("dim").cast("bigint").alias("dim"), _r6(F.col("value")).alias("value")))


@query("standardize_vectors")
def standardize_vectors(spark, d):
    emb = load_table(spark, d, "embeddings").select("vec_id", "embedding")
    return _vec_rows(V.standardize(emb, "embedding"), vec="embedding")


@query("scaled_dot")
def scaled_dot(spark, d):
    emb = load_table(spark, d, "embeddings")
    return V.consecutive_scaled_dot(emb, "label", "vec_id", "embedding").withColumn("value", _r6(F.col("value")))


@query("soft_history")
def soft_history(spark, d):
    emb = load_table(spark, d, "embeddings")
    return _vec_rows(V.soft_history(emb, "label", "vec_id", "embedding", SOFT_WINDOW))


@query("soft_history_heads")
def soft_history_heads(spark, d):
    emb = load_table(spark, d, "embeddings")
    return _vec_rows(V.soft_history(emb, "label", "vec_id", "embedding", SOFT_WINDOW, heads=HEADS))


@query("soft_context")
def soft_context(spark, d):
    """Soft history over the whole context length, several heads."""
    emb = load_table(spark, d, "embeddings")
    return _vec_rows(V.soft_history(emb, "label", "vec_id", "embedding", CONTEXT_WINDOW, heads=HEADS, block=32))


@query("embed_tokens")
def embed_tokens(spark, d):
    # one tokenizing pass: occurrences per (doc, token), from which both the
    # vocabulary and the encoded counts come
    pairs = C.doc_token_arrays(spark, d, counted=True)
    ids = TK.encode_counts(pairs, C.vocab_of(pairs))
    return _vec_rows(V.pooled_token_embeddings(ids, load_table(spark, d, "embeddings")), "doc_id")


@query("conversation_until_exit")
def conversation_until_exit(spark, d):
    conv = load_table(spark, d, "conversations")
    return until_exit(conv, C.EXIT_WORDS).select("conv_id", "turn", "text")
