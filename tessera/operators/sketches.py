"""Approximate corpus statistics kept per input file and merged.

Exact distinct counts read and shuffle every token again whenever a file comes
in.  Here each file leaves one row: additive counts, a distinct-count sketch
(HyperLogLog) of its tokens and a quantile sketch (KLL) of its text lengths.
Files seen before are not read again; any set of rows merges into the whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.functions.tokenizers import WORDS, Tokenizer
from tessera.session import spread_input

#: 2^LG_K registers, and the relative standard error of a merged sketch of them.
LG_K = 12
VOCAB_ERROR = 1.04 / 2 ** (LG_K / 2)
#: Size of the quantile sketch, and the rank error it stays below (99 %: 2.3 / K).
KLL_K = 800
RANK_ERROR = 3 * 2.3 / KLL_K
#: The slashes behind the scheme of a file's address.
ROOT = ":/+"


def sketch_files(docs: DataFrame, text_col: str = "text", file_col: str = "file",
                 tokenizer: Tokenizer = WORDS) -> DataFrame:
    """(file, n_docs, n_chars, n_tokens, tokens_sketch, length_sketch): a partial/final aggregate per
    ``file_col``, so that one large file is no hot group.  Null text is a document without
    characters or tokens."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(file_col).alias("file"), F.length(text).cast("bigint").alias("_c"),
                       F.posexplode_outer(tokenizer.tokens(text)).alias("_pos", "_token"))
    first = F.col("_pos").isNull() | (F.col("_pos") == 0)
    return rows.groupBy("file").agg(
        F.count(F.when(first, 1)).alias("n_docs"),
        F.coalesce(F.sum(F.when(first, F.col("_c"))), F.lit(0)).alias("n_chars"),
        F.count("_token").alias("n_tokens"),
        F.hll_sketch_agg("_token", F.lit(LG_K)).alias("tokens_sketch"),
        F.kll_sketch_agg_bigint(F.when(first, F.col("_c")), F.lit(KLL_K)).alias("length_sketch"))


def merged(sketches: DataFrame, *by: str, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """One row of statistics per group of ``by`` (of all rows without it): ``n_docs``, ``n_chars``,
    ``n_tokens``, ``vocab_size`` (estimate) and ``length_quantiles`` (an array; null without
    documents)."""
    one = sketches.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_docs", "n_chars", "n_tokens")],
        F.hll_union_agg("tokens_sketch").alias("_hll"), F.kll_merge_agg_bigint("length_sketch").alias("_kll"))
    at = F.array(*[F.kll_sketch_get_quantile_bigint("_kll", F.lit(q)) for q in quantiles])
    return one.select(*by, "n_docs", "n_chars", "n_tokens", F.hll_sketch_estimate("_hll").alias("vocab_size"),
                      F.when(F.col("n_docs") > 0, at).alias("length_quantiles"))


@dataclass
class SketchStore:
    """Sketches of the Parquet files of one corpus, in a folder of the shared file system.  Files
    are taken as unchanging: a file of a known path is not read again."""
    spark: SparkSession
    path: str
    text_col: str = "text"
    tokenizer: Tokenizer = WORDS

    def sketches(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:  # nothing stored yet
            return None

    def refresh(self, corpus: str) -> int:
        """Sketches of the files of ``corpus`` that are not stored yet are added in one job, whole or
        not at all.  Returns their number."""
        docs = self.spark.read.parquet(corpus)
        stored = self.sketches()
        # the scan's own list of files, which the driver holds anyway
        known = {r.file for r in stored.select("file").toLocalIterator()} if stored is not None else set()
        # file:/a and file:///a are one file
        new = {re.sub(ROOT, ":/", f): f for f in docs.inputFiles()}
        new = {key: f for key, f in new.items() if key not in known}
        if new:
            rows = self.spark.read.schema(docs.schema).parquet(*[unquote(f) for f in new.values()]).select(
                F.regexp_replace("_metadata.file_path", ROOT, ":/").alias("file"), self.text_col)
            added = sketch_files(spread_input(rows), self.text_col, tokenizer=self.tokenizer)
            listed = self.spark.createDataFrame([(f,) for f in new], "file string")  # empty files have a row too
            added = listed.join(added, "file", "left")
            added.coalesce(1 + len(new) // 10000).write.mode("append").parquet(self.path)
        return len(new)

    def statistics(self, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
        return merged(self.sketches(), quantiles=quantiles)
