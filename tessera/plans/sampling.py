"""Registered queries: labels, shuffles, splits, samples, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import epochs as EP
from tessera.operators import positions as PO
from tessera.operators import sampling as SA
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import load_table


@query("filter_label")
def filter_label(spark, d):
    return load_table(spark, d, "labels").where(F.col("toxic") == 1).select("doc_id", "quality", "toxic")


@query("label_counts")
def label_counts(spark, d):
    return (load_table(spark, d, "labels").groupBy("quality")
            .agg(F.count(F.lit(1)).alias("n")))


@query("label_name")
def label_name(spark, d):
    lab = load_table(spark, d, "labels")
    return lab.select("doc_id", F.when(F.col("toxic") == 1, "spam").otherwise("not spam").alias("name"))


@query("row_fetch")
def row_fetch(spark, d):
    """The row at a position, by the table's file index: one file is read."""
    index = PO.file_index(load_table(spark, d, "labels"))
    return PO.fetch(spark, index, C.ROW).select("row_id", "doc_id", "quality", "toxic")


@query("row_ids")
def row_ids(spark, d):
    """Dataset index: stable row ids in the order of the key."""
    lab = load_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return SA.row_ids(lab, ["doc_id"]).select("row_id", "doc_id")


@query("epoch_batches")
def epoch_batches(spark, d):
    """Every epoch's batches of the orders, in an order of its own, by arithmetic
    on the rows' positions in their files."""
    orders = load_table(spark, d, "orders")
    index = PO.file_index(orders)
    rows = PO.with_row_id(orders.select("o_orderkey"), index)
    return EP.epoch_batches(rows, "row_id", PO.size(index), C.BATCH, C.SEED, C.EPOCHS).select(
        "o_orderkey", F.col("epoch").cast("bigint").alias("epoch"), "place", "batch_id", "step")


def _orders(spark, d):
    return load_table(spark, d, "orders").select("o_orderkey")


@query("shuffled_rank")
def shuffled_rank(spark, d):
    return SA.shuffled_rank(_orders(spark, d), "o_orderkey", C.SEED)


@query("batches")
def batches(spark, d):
    ranked = SA.shuffled_rank(_orders(spark, d), "o_orderkey", C.SEED)
    return SA.batches(ranked, C.BATCH, drop_last=True).select("o_orderkey", "batch_id")


@query("three_way_split")
def three_way_split(spark, d):
    return SA.three_way_split(_orders(spark, d), "o_orderkey", C.SEED, C.TRAIN_FRAC,
                              C.VALIDATION_FRAC).select("o_orderkey", "split")


@query("balanced_sample")
def balanced_sample(spark, d):
    lab = load_table(spark, d, "labels").select("doc_id", "toxic")
    return SA.balanced_sample(lab, "toxic", "doc_id", C.SEED)


@query("char_split")
def char_split(spark, d):
    return SA.char_split(C.docs(spark, d), "text", 0.9).select("doc_id", "train_text", "val_text")
