"""Registered queries: sources and sinks (write table data, read it back).

Intermediate files go under the reliable checkpoint folder (shared storage on
a cluster), never under a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.sampling import three_way_split
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import load_table, scratch_path
from tessera.sources import files as FS


def _labelled(spark, d):
    lab = load_table(spark, d, "labels")
    return C.docs(spark, d).join(lab, "doc_id").select(
        "doc_id", F.col("toxic").alias("Label"), F.col("text").alias("Text"))


@query("src_labelled_csv")
def src_labelled_csv(spark, d):
    path = scratch_path(spark, "labelled-csv")
    FS.write_labelled_csv(_labelled(spark, d), path)
    back = FS.read_labelled_csv(spark, path)
    return back.select(F.col("Label").cast("bigint").alias("label"), F.col("Text").alias("text"))


@query("src_text")
def src_text(spark, d):
    path = scratch_path(spark, "text-files")
    FS.write_text_per_key(C.docs(spark, d), "doc_id", "text", path)
    back = FS.read_text_files(spark, path)
    return back.select(FS.key_of_path("path", "doc_id").cast("bigint").alias("doc_id"),
                       FS.strip_written_newline("text").alias("text"))


@query("src_label_tsv")
def src_label_tsv(spark, d):
    path = scratch_path(spark, "label-tsv")
    raw = _labelled(spark, d).select(F.when(F.col("Label") == 1, "spam").otherwise("ham").alias("Label"), "Text")
    FS.write_label_tsv(raw, path)
    back = FS.read_label_tsv(spark, path)
    return back.select(F.col("Label").alias("label"), FS.raw_label_ids("Label").cast("bigint").alias("label_id"),
                       F.col("Text").alias("text"))


def _with_split(lab):
    split = three_way_split(lab.select("doc_id"), "doc_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC)  # keys only
    return lab.join(split.select("doc_id", "split"), "doc_id")


@query("sink_csv_splits")
def sink_csv_splits(spark, d):
    """The three labelled CSVs, written and read back whole."""
    path = scratch_path(spark, "csv-splits")
    FS.write_csv_splits(_with_split(_labelled(spark, d)), path)
    back = FS.read_csv_splits(spark, path)
    return back.select("split", F.col("Label").cast("bigint").alias("label"), F.col("Text").alias("text"))


@query("sink_splits")
def sink_splits(spark, d):
    lab = _labelled(spark, d)
    path = scratch_path(spark, "splits")
    FS.write_splits(_with_split(lab).select("doc_id", "Label", "Text", "split"), path)
    back = FS.read_splits(spark, path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum("Label").cast("bigint").alias("n_positive"))
