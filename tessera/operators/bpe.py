"""Byte-pair encoding as a corpus job.

1. Native pre-token split (regexp_extract_all with Unicode classes): lossless,
   every character belongs to exactly one piece.
2. ``groupBy(piece)``: each distinct piece is encoded once, so the Python side
   sees distinct pieces only (Arrow batches, the merge loop runs in tiktoken's
   native code).
3. Documents stand in blocks as places in the block's dictionary of pieces: the
   piece ids return to a block as one array, not to every occurrence of a piece.

The rank table is user-supplied; ``build_ranks`` derives one from a corpus by
a rule: all 256 single bytes, then every byte prefix (length >= 2) of the most
frequent pieces, ordered by (length, bytes), so each chosen piece is reachable
by left-to-right merges.  Decoding looks ids up in the broadcast rank table (a
table of proven size) and concatenates their bytes, then UTF-8 decode.  Every row
is a text of its own, also where ids repeat or are null.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import blocks as BL

# Fixed value: the public GPT-2 pre-token pattern (Unicode classes).
PRETOKEN_PATTERN = (r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
TIKTOKEN_PATTERN = PRETOKEN_PATTERN[4:]

_ENCODERS: dict = {}


@dataclass
class BpeModel:
    broadcast: object          # Broadcast[list[tuple[bytes, int]]]
    special_id: int
    table: DataFrame           # (token_id, hex) for decoding; one row per rank
    size: int
    key: str                   # names the model in the per-worker encoder cache


def pretokens(text: F.Column) -> F.Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0)


def piece_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 special: str = "allow") -> BL.Blocks:
    """The pieces of ``docs`` in text order (``special`` as in ``piece_rows``),
    split once and stored in blocks."""
    def pieces(seg: F.Column, number: F.Column) -> F.Column:
        mark = F.when(number > 0, F.array(F.lit(T.END_OF_TEXT))).otherwise(F.array().cast("array<string>"))
        return F.concat(mark, pretokens(seg))

    parts = F.flatten(F.transform(_segments(text_col, special), pieces))
    return BL.pack(docs.select(id_col, parts.alias("tokens")), id_col)


def piece_counts(docs: DataFrame | BL.Blocks, text_col: str = "text", special: str = "allow") -> DataFrame:
    """(piece, freq) over a corpus (or its ``piece_blocks``): partial/final aggregation of
    the pre-token pieces.  Building a rank table and counting ids both start from it."""
    if isinstance(docs, BL.Blocks):
        return docs.words().groupBy(F.col("token").alias("piece")).agg(F.sum("freq").alias("freq"))
    rows = piece_rows(docs.select(F.lit(0).alias("_rid"), text_col), "_rid", text_col, special)
    return rows.groupBy("piece").agg(F.count(F.lit(1)).alias("freq"))


def build_ranks(spark: SparkSession, docs: DataFrame | None = None, text_col: str = "text",
                pieces: int = 2048, max_piece_bytes: int = 16,
                counts: DataFrame | None = None) -> BpeModel:
    counted = counts if counts is not None else piece_counts(docs, text_col, "text")
    nbytes = F.octet_length("piece")
    top = (counted.where((nbytes >= 2) & (nbytes <= max_piece_bytes) & (F.col("piece") != T.END_OF_TEXT))
           .orderBy(F.desc("freq"), F.asc("piece")).limit(pieces))
    hexed = top.select(F.hex(F.encode("piece", "UTF-8")).alias("h"))
    prefixes = (hexed.select(F.explode(F.transform(F.sequence(F.lit(2), (F.length("h") / 2).cast("int")),
                                                    lambda i: F.substring(F.col("h"), F.lit(1), i * 2))).alias("p"))
                .distinct())
    # bounded by pieces * max_piece_bytes rows: a model, read to the driver
    merged = [bytes.fromhex(r["p"]) for r in prefixes.collect()]
    merged.sort(key=lambda b: (len(b), b))
    ranks = [(bytes([i]), i) for i in range(256)] + [(b, 256 + i) for i, b in enumerate(merged)]
    special_id = len(ranks)
    bc = spark.sparkContext.broadcast(ranks)
    rows = [(r, b.hex().upper()) for b, r in ranks]
    table = spark.createDataFrame(rows, "token_id INT, hex STRING")
    import uuid

    return BpeModel(bc, special_id, table, len(ranks) + 1, uuid.uuid4().hex)


def _encoder(bc, special_id: int, key: str):
    enc = _ENCODERS.get(key)
    if enc is None:
        import tiktoken

        enc = tiktoken.Encoding(name=f"corpus-bpe-{key}", pat_str=TIKTOKEN_PATTERN,
                                mergeable_ranks=dict(bc.value),
                                special_tokens={T.END_OF_TEXT: special_id})
        _ENCODERS[key] = enc
    return enc


def _piece_encoder(model: BpeModel):
    bc, special_id, key = model.broadcast, model.special_id, model.key

    @F.pandas_udf("array<int>")
    def encode_pieces(pieces: pd.Series) -> pd.Series:
        enc = _encoder(bc, special_id, key)
        plain = [p for p in pieces if p != T.END_OF_TEXT]
        coded = iter(enc.encode_ordinary_batch(plain, num_threads=1))
        return pd.Series([[special_id] if p == T.END_OF_TEXT else next(coded) for p in pieces])

    return encode_pieces


def _segments(text_col: str, special: str) -> F.Column:
    text = F.col(text_col)
    if special == "error":
        text = F.when(F.instr(text, T.END_OF_TEXT) > 0,
                      F.raise_error(F.lit("text holds a special token; allow it or treat it as text"))
                      .cast("string")).otherwise(text)
    if special == "allow":
        return F.split(text, F.lit(r"\Q" + T.END_OF_TEXT + r"\E"), -1)
    return F.array(text)


def piece_rows(docs: DataFrame, id_col: str, text_col: str, special: str = "allow") -> DataFrame:
    """(id, seg, pos, piece).  special = "allow": the end-of-text string is one
    piece of its own (text split on it first); "text": it is ordinary text;
    "error": a text containing it fails the job."""
    # outer generators + filters on their outputs (see tokens.word_tokens)
    seg_rows = (docs.select(id_col, F.posexplode_outer(_segments(text_col, special)).alias("seg", "s"))
                .where(F.col("seg").isNotNull()))
    body = (seg_rows.select(id_col, "seg", F.posexplode_outer(pretokens(F.col("s"))).alias("pos", "piece"))
            .where(F.col("pos").isNotNull()))
    if special != "allow":
        return body
    marks = (seg_rows.where(F.col("seg") > 0)
             .select(id_col, "seg", F.lit(-1).alias("pos"), F.lit(T.END_OF_TEXT).alias("piece")))
    return body.unionByName(marks)


def encode_distinct(pieces: DataFrame, model: BpeModel, counted: DataFrame | None = None) -> DataFrame:
    """(piece, ids, freq) — one Python call per distinct piece."""
    distinct = counted if counted is not None else pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("freq"))
    return distinct.select("piece", _piece_encoder(model)(F.col("piece")).alias("ids"), "freq")


def encode(docs: DataFrame, model: BpeModel, id_col: str = "doc_id", text_col: str = "text",
           special: str = "allow", counts: DataFrame | None = None, blocks: BL.Blocks | None = None) -> DataFrame:
    """(id, ids ARRAY<INT>) in text order, a row per row of ``docs``.  ``counts`` = precomputed
    ``piece_counts``, ``blocks`` = precomputed ``piece_blocks`` of the same documents and mode
    (each saves a regex pass)."""
    blocks = blocks or piece_blocks(docs, id_col, text_col, special)
    coded = encode_distinct(None, model, counts if counts is not None else piece_counts(blocks))
    table = coded.select(F.col("piece").alias("token"), F.col("ids").cast("array<bigint>").alias("ids"))
    kind = blocks.table.schema["ids"].dataType.elementType.simpleString()
    answers = BL.answered(blocks, table, F.col("ids")).select(
        "ids", "slots", F.lit(None).cast("array<bigint>").alias("one"), F.col("codes").alias("many"))
    return BL.encoded(answers, id_col, kind).select(id_col, F.col("ids").cast("array<int>").alias("ids"))


def token_counts(docs: DataFrame | None, model: BpeModel, text_col: str = "text",
                 special: str = "allow", counts: DataFrame | None = None) -> DataFrame:
    """(token_id, n) over a whole corpus without building per-document arrays:
    piece counts x piece ids, summed per id (partial/final aggregation)."""
    counted = counts if counts is not None else piece_counts(docs, text_col, special)
    coded = encode_distinct(None, model, counted)
    return (coded.select(F.explode("ids").alias("token_id"), "freq")
            .groupBy("token_id").agg(F.sum("freq").alias("n")))


def decode(encoded: DataFrame, model: BpeModel, id_col: str = "doc_id") -> DataFrame:
    """(id, text), a row per row of ``encoded``: ids -> bytes via the (bounded, broadcast)
    rank table, ordered concatenation, UTF-8 decode.  Ids that the table lacks stand for nothing."""
    rows = encoded.select(id_col, F.col("ids").cast("array<int>").alias("ids"))
    return _joined_bytes(rows, model, id_col).select(id_col, F.decode(F.col("_b"), "UTF-8").alias("text"))


def _joined_bytes(rows: DataFrame, model: BpeModel, id_col: str) -> DataFrame:
    """(id, _b): the bytes of each row's ids, in order."""
    bc, special_id = model.broadcast, model.special_id

    def run(batches):
        of = {**{i: b for b, i in bc.value}, special_id: T.END_OF_TEXT.encode()}
        table = pa.array([of.get(i, b"") for i in range(max(of) + 1)], pa.binary())
        for b in batches:
            lists = b.column(1)
            for lo in range(0, b.num_rows, 1024):  # a bounded number of texts at once
                part = lists.slice(lo, 1024)
                ids = part.flatten()
                known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(table)))
                found = pc.fill_null(table.take(pc.if_else(known, ids, None)), b"")
                sizes = pc.fill_null(pc.list_value_length(part), 0)
                offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
                text = pc.binary_join(pa.ListArray.from_arrays(offsets, found), pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 1024), text], names=[id_col, "_b"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, _b binary")
