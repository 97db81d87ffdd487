"""Shared inputs and fixed parameters of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tessera.functions import text as T
from tessera.operators import tokens as TK
from tessera.operators.blocks import Blocks
from tessera.session import load_table

SEED = 123
WINDOW_LENGTH, WINDOW_STRIDE = 8, 4
SKIP, CONTEXT = 50, 4
PACK_LENGTH, PACK_SHARDS = 64, 8
CROP = 16
SCORE_LENGTH, SCORE_CONTEXT = 120, 1024
TRAIN_FRAC, VALIDATION_FRAC = 0.7, 0.1
BATCH = 8
ROW = 7
TOP_K = 3
EPOCHS, EVAL_FREQ = 3, 5
STEPS_PER_EPOCH, EVAL_BATCHES = 6, 5
EXIT_WORDS = ("exit", "quit")


def docs(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "documents", spread=True).select("doc_id", "text")


def doc_tokens(spark: SparkSession, d: str) -> DataFrame:
    return TK.word_tokens(docs(spark, d))


def doc_vocab(spark: SparkSession, d: str) -> DataFrame:
    return TK.vocabulary(doc_tokens(spark, d))


def doc_token_arrays(spark: SparkSession, d: str, counted: bool = False) -> Blocks:
    """(doc_id, tokens), tokenized once and stored in blocks: the vocabulary
    and the encoding both read them."""
    return TK.token_blocks(docs(spark, d), counted=counted)


def vocab_of(tokens: Blocks) -> DataFrame:
    return TK.vocabulary(tokens)


def encoded_docs(spark: SparkSession, d: str, tokens: Blocks | None = None,
                 vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids) with the vocabulary of all documents (every token known)."""
    tokens = tokens if tokens is not None else doc_token_arrays(spark, d)
    return TK.encode(tokens, vocab if vocab is not None else vocab_of(tokens), unknown="keep")


def vocab_special(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary of all documents and the two special tokens; what the
    benchmark holds beyond it is unknown."""
    return TK.with_specials(doc_vocab(spark, d))


def benchmark(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "benchmark").select("item_id", "text")


def ids_str(col: str = "ids"):
    return T.ids_text(F.col(col)).alias(col)
