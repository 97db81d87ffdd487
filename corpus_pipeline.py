"""Corpus pipeline: five stages over ``documents``, each one of the dealt operators.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps, with all
columns of ``documents``; the last returns the token ids.  ``run`` writes each
stage's result as Parquet into the shared folder and rereads it as the next
one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from tessera.llm.common import stored, table

#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Dropped ids (8 bytes each) that are broadcast to the documents; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: A benchmark passage: this many consecutive words.
WINDOW = 10


#: Rows and bytes of the batches that tasks pass to their Python workers: what
#: is held on both sides of that is bounded by these, not by Spark's larger defaults.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def _small_batches(spark: SparkSession) -> None:
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``dropped`` (rows of a null id stay)."""
    ids = stored(dropped.select("doc_id").where("doc_id is not null").distinct(), "dropped")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)  # else: a shuffle join
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    _small_batches(spark)
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, scored.where("predicted = 1"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; a repeated row stays once."""
    _small_batches(spark)
    kept = _without(docs, exact_dedup.exact_dedup(docs, larger=True).where("not kept"))
    again = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
                            .select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    _small_batches(spark)
    groups = jaccard_join.jaccard_join(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    return _without(docs, groups.where("component_id != doc_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    _small_batches(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=WINDOW)
    return _without(docs, found.where("contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked by decoding them."""
    _small_batches(spark)
    import public_tokenizers

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode_checked(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: The toxicity stage is a fitted model, which SQL cannot express: run() is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
