"""Windows, shifted targets, growing contexts, padding and document packing.

All of these are per-row array expressions over encoded documents (no shuffle)
except ``pack_documents``, which needs a running offset inside a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as T
from tessera.operators.ranking import running_total
from tessera.operators.tokens import gather


def token_windows(encoded: DataFrame, length: int, stride: int, id_col: str = "doc_id",
                  ids_col: str = "ids") -> DataFrame:
    """(id, win, start, input_ids, target_ids): full windows only, the tail is
    dropped; ``n <= length`` gives no window."""
    return (A.rows_of(encoded, [id_col], T.sliding_windows(F.col(ids_col), length, stride), "win", "w")
            .select(id_col, F.col("win").cast("bigint").alias("win"),
                    F.col("w.start").cast("bigint").alias("start"),
                    F.col("w.input_ids").alias("input_ids"), F.col("w.target_ids").alias("target_ids")))


def next_token(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, pos, token_id, next_id): target = input shifted by one (null at the
    end).  Read from the document's own array, so no window shuffle."""
    return (A.rows_of(encoded, [id_col, F.col(ids_col).alias("_ids")], ids_col, value="token_id")
            .select(id_col, F.col("pos").cast("bigint").alias("pos"), "token_id",
                    F.try_element_at(F.col("_ids"), F.col("pos") + 2).alias("next_id")))


def context_pairs(encoded: DataFrame, skip: int, context: int, id_col: str = "doc_id",
                  ids_col: str = "ids") -> DataFrame:
    """(id, i, context_ids, target) for i in 1..context after ``skip`` ids."""
    return (A.rows_of(encoded, [id_col], T.growing_contexts(F.col(ids_col), skip, context), value="p")
            .select(id_col, F.col("p.i").cast("bigint").alias("i"),
                    F.col("p.context_ids").alias("context_ids"), F.col("p.target").alias("target")))


def left_crop(encoded: DataFrame, context: int, ids_col: str = "ids") -> DataFrame:
    return encoded.withColumn(ids_col, T.left_crop(F.col(ids_col), context))


def pad_truncate(encoded: DataFrame, length: int, pad_id: int = T.PAD_ID,
                 ids_col: str = "ids") -> DataFrame:
    return encoded.withColumn(ids_col, T.pad_truncate(F.col(ids_col), length, pad_id))


def max_encoded_length(encoded: DataFrame, ids_col: str = "ids") -> DataFrame:
    """One row: max_len (0 for an empty input)."""
    return encoded.agg(F.coalesce(F.max(F.size(ids_col)), F.lit(0)).cast("bigint").alias("max_len"))


def prepare_for_scoring(encoded: DataFrame, max_length: int, context_length: int,
                        pad_id: int = T.PAD_ID, ids_col: str = "ids") -> DataFrame:
    """Truncate to min(max_length, context), pad to max_length.  A length past
    the context is refused when the plan is built."""
    if max_length is None:
        raise ValueError("max_length is required for scoring")
    if max_length > context_length:
        raise ValueError(f"max_length {max_length} exceeds the context length {context_length}")
    cut = T.truncate(F.col(ids_col), min(max_length, context_length))
    return encoded.withColumn(ids_col, T.pad_right(cut, max_length, pad_id))


def pack_documents(encoded: DataFrame, length: int, separator_id: int, shards: int,
                   id_col: str = "doc_id", ids_col: str = "ids",
                   shard_expr=None) -> DataFrame:
    """Concatenate documents (each followed by ``separator_id``) inside a shard
    in id order and cut the stream into blocks of ``length`` ids; the last block
    of a shard may be short.  Blocks never cross shards.  The running offset is
    a distributed running total over (doc_id, size) rows only — never over
    tokens, and never one task per shard.
    Output (shard, block, ids ARRAY<BIGINT>); gather groups hold <= length ids."""
    shard = shard_expr if shard_expr is not None else F.pmod(F.xxhash64(id_col), F.lit(shards))
    seq = encoded.select(id_col, shard.cast("bigint").alias("shard"),
                         F.concat(F.col(ids_col), F.array(F.lit(separator_id).cast("bigint"))).alias("_seq"))
    sizes = seq.select(id_col, "shard", F.size("_seq").cast("bigint").alias("_n"))
    offsets = running_total(sizes, ["shard"], [id_col], "_n", "_off").select(id_col, "_off")
    # a document is cut where blocks end: rows = documents + blocks, not tokens
    joined = seq.join(offsets, id_col).withColumn("_end", F.col("_off") + F.size("_seq"))
    blocks = F.sequence(F.floor(F.col("_off") / length), F.floor((F.col("_end") - 1) / length))
    cut = joined.select("shard", "_off", "_end", "_seq", F.explode_outer(blocks).alias("block"))
    begin = F.greatest(F.col("block") * length, F.col("_off"))
    stop = F.least((F.col("block") + 1) * length, F.col("_end"))
    piece = F.slice("_seq", (begin - F.col("_off") + 1).cast("int"), (stop - begin).cast("int"))
    packed = (cut.select("shard", F.col("block").cast("bigint").alias("block"), F.struct(
        begin.alias("at"), piece.alias("ids")).alias("p")).groupBy("shard", "block")
        .agg(F.sort_array(F.collect_list("p")).alias("_s")))
    return packed.select("shard", "block", F.flatten(F.transform("_s", lambda x: x["ids"])).alias("ids"))


__all__ = ["token_windows", "next_token", "context_pairs", "left_crop", "pad_truncate",
           "max_encoded_length", "prepare_for_scoring", "pack_documents", "gather"]
