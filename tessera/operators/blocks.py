"""Documents packed into blocks, each with a dictionary of its own tokens.

A lookup of every token of a corpus (its id, its class weights) by a join of
token rows sends each occurrence through two shuffles: to the table and back to
its document.  Here consecutive documents form a block of at most
``BLOCK_TOKENS`` tokens (a longer document is a block of its own).  A block
keeps its tokens as places in its dictionary, so only a block's distinct tokens
meet the table, each a row; the answers return to the block as one array in
dictionary order.  A frequent token is a row per block, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

#: Tokens of a block.
BLOCK_TOKENS = 1 << 19


@dataclass
class Blocks:
    """``table`` (block, ids, slots, words, freqs), a stored row per block: the
    ids of its documents, their tokens as places in ``words``, and how often
    each word occurs.  ``counted``: a document's distinct tokens, in ``slots``,
    with their numbers in ``counts``."""
    table: DataFrame
    id_col: str
    counted: bool

    def words(self) -> DataFrame:
        """(block, slot, token, freq): a row per distinct token of a block."""
        rows = self.table.select("block", F.posexplode(F.arrays_zip("words", "freqs")).alias("slot", "w"))
        return rows.select("block", "slot", F.col("w.words").alias("token"), F.col("w.freqs").alias("freq"))

    def ids(self) -> DataFrame:
        return self.table.select(F.explode("ids").alias(self.id_col))


def _stretches(lists: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + BLOCK_TOKENS, side="right")))
        yield lo, hi
        lo = hi


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _one(values: pa.Array) -> pa.Array:
    return _lists(np.array([0, len(values)]), values)


def pack(tokens: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", counted: bool = False) -> Blocks:
    """The documents of ``tokens`` (id, ARRAY<STRING>; null: no tokens) in stored blocks."""
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for b in batches:
            for lo, hi in _stretches(b.column(1)):
                ids, lists = b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo)
                coded = lists.flatten().dictionary_encode()
                words, slots = coded.dictionary, coded.indices
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                known = pc.is_valid(slots).to_numpy(zero_copy_only=False)
                at = pc.fill_null(slots, 0).to_numpy(zero_copy_only=False).astype(np.int64)
                freqs = np.bincount(at[known], minlength=len(words))
                columns = [pa.array([number], pa.int64()), _one(pa.concat_arrays([ids]))]
                if counted:
                    doc = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
                    pairs, n = np.unique((doc * max(len(words), 1) + at)[known], return_counts=True)
                    slots = pa.array((pairs % max(len(words), 1)).astype(np.int32))
                    lengths = np.bincount(pairs // max(len(words), 1), minlength=len(lists))
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                columns.append(_one(_lists(offsets, slots)))
                if counted:
                    columns.append(_one(_lists(offsets, pa.array(n.astype(np.int32)))))
                columns += [_one(words), _one(pa.array(freqs.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                number += 1

    names = ["block", "ids", "slots", *(["counts"] if counted else []), "words", "freqs"]
    types = ["bigint", f"array<{kind}>", "array<array<int>>", *(["array<array<int>>"] if counted else []),
             "array<string>", "array<bigint>"]
    packed = tokens.select(id_col, tokens_col).mapInArrow(run, ", ".join(map(" ".join, zip(names, types, strict=True))))
    return Blocks(materialize(packed), id_col, counted)


def answered(blocks: Blocks, table: DataFrame, value: Column) -> DataFrame:
    """The blocks with ``codes``: for each of a block's words the ``value`` (over
    the columns of ``table``, null where it lacks the token; and ``token``).
    ``table`` has one row a token."""
    rows = blocks.words().join(table, "token", "left").select("block", F.struct("slot", value.alias("v")).alias("_s"))
    # dealt by block before they are collected: the lists are not built twice
    codes = rows.repartition("block").groupBy("block").agg(F.sort_array(F.collect_list("_s")).alias("_s"))
    return blocks.table.drop("words", "freqs").join(
        codes.select("block", F.transform("_s", lambda x: x["v"]).alias("codes")), "block", "left")


def encoded(answers: DataFrame, id_col: str, kind: str) -> DataFrame:
    """(id, ids ARRAY<BIGINT>, at) of blocks with ``one``, an id for each of a block's
    words, and ``many``: lists of ids, where a word has several (else null, and
    so is ``at``, the places of the ids)."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, slots = b.column(0).slice(i, 1).flatten(), b.column(1).slice(i, 1).flatten()
                lengths = pc.list_value_length(slots).to_numpy(zero_copy_only=False)
                offsets, at = np.concatenate([[0], np.cumsum(lengths)]), None
                if b.column(3).is_valid()[i].as_py():
                    found = b.column(3).slice(i, 1).flatten().take(slots.flatten())
                    sizes = pc.fill_null(pc.list_value_length(found), 1).to_numpy(zero_copy_only=False)
                    at = np.repeat(np.arange(len(found)) - np.repeat(offsets[:-1], lengths), sizes)
                    offsets = np.concatenate([[0], np.cumsum(sizes)])[offsets]
                    values = pc.if_else(found.is_valid(), found, pa.scalar([None], found.type)).flatten()
                else:
                    values = b.column(2).slice(i, 1).flatten().take(slots.flatten())
                for lo in range(0, len(ids), 1024):  # batches of a bounded size
                    part = offsets[lo:lo + 1025]
                    lists = _lists(part - part[0], values.slice(part[0], part[-1] - part[0]))
                    places = pa.nulls(len(lists), pa.list_(pa.int32())) if at is None else _lists(
                        part - part[0], pa.array(at[part[0]:part[-1]], pa.int32()))
                    yield pa.RecordBatch.from_arrays([ids.slice(lo, 1024), lists, places], names=["id", "ids", "at"])

    return answers.select("ids", "slots", "one", "many").mapInArrow(
        run, f"id {kind}, ids array<bigint>, at array<int>").select(F.col("id").alias(id_col), "ids", "at")


def counted_rows(blocks: Blocks, table: DataFrame, value: Column, out: str) -> DataFrame:
    """(id, out, _c) of the distinct tokens of each document that have a value."""
    def found(slots: Column, counts: Column) -> Column:
        return F.filter(F.zip_with(slots, counts, lambda s, c: F.struct(F.get(F.col("codes"), s).alias(out), c.alias("_c"))),
                        lambda x: x[out].isNotNull())
    docs = F.zip_with("ids", F.zip_with("slots", "counts", found), lambda i, t: F.struct(i.alias("id"), t.alias("t")))
    rows = answered(blocks, table, value).select(F.explode(docs).alias("_d")).select(
        F.col("_d.id").alias(blocks.id_col), F.explode("_d.t").alias("_t"))
    return rows.select(blocks.id_col, "_t.*")


def class_sums(blocks: Blocks, table: DataFrame, value: Column) -> DataFrame:
    """(id, class, _x) where ``value`` is an ARRAY<STRUCT<class BIGINT, gain DOUBLE>>
    of a token: for every document with a known token, the sums of count times
    gain per class, and its number of known tokens under the null class."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, slots, counts = (b.column(c).slice(i, 1).flatten() for c in range(3))
                seen = b.column(3).slice(i, 1).flatten()
                if not len(seen):
                    continue
                per_doc = pc.list_value_length(slots).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(ids), dtype=np.int64), per_doc)
                slot = slots.flatten().to_numpy(zero_copy_only=False)
                n = counts.flatten().to_numpy(zero_copy_only=False).astype(float)
                known = seen.is_valid().to_numpy(zero_copy_only=False)[slot]
                doc, slot, n = doc[known], slot[known], n[known]
                sizes = pc.fill_null(pc.list_value_length(seen), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                pairs = seen.flatten()
                classes = pairs.field("class").dictionary_encode()
                codes = classes.indices.to_numpy(zero_copy_only=False)
                gains = pairs.field("gain").to_numpy(zero_copy_only=False)
                times = sizes[slot]
                at = np.repeat(starts[slot] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                width = max(len(classes.dictionary), 1)
                keys, where = np.unique(np.repeat(doc, times) * width + codes[at], return_inverse=True)
                sums = np.bincount(where, weights=np.repeat(n, times) * gains[at], minlength=len(keys))
                total = np.bincount(doc, weights=n, minlength=len(ids))
                some = np.flatnonzero(np.bincount(doc, minlength=len(ids)))
                rows = pa.array(np.concatenate([some, keys // width]))
                of = pa.concat_arrays([pa.nulls(len(some), pa.int64()), classes.dictionary.take(pa.array(keys % width))])
                yield pa.RecordBatch.from_arrays([ids.take(rows), of, pa.array(np.concatenate([total[some], sums]))],
                                                 names=["id", "class", "_x"])

    kind = blocks.table.schema["ids"].dataType.elementType.simpleString()
    rows = answered(blocks, table, value).select("ids", "slots", "counts", "codes")
    return rows.mapInArrow(run, f"id {kind}, class bigint, _x double").withColumnRenamed("id", blocks.id_col)
