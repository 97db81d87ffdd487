"""Language model of any order: interpolated Kneser-Ney over count tables.

Order n counts how often a token follows its n-1 predecessors; every lower
order counts in how many different ways a shorter context is extended to the
left (continuation counts), each from the table above it.  Probabilities are
then worked out upwards, level by level:

    p_k(w | c) = max(n(c, w) - D, 0) / n(c) + b_k(c) p_{k-1}(w | c without its first token)
    b_k(c)     = D * (tokens seen after c) / n(c),      p_0 = 1 / |V|

with V the training vocabulary and <|unk|>; an unseen context leaves the
probability of the level below as it is.

Tokens are encoded by block dictionaries, and a gram is its predecessors, the
nearest first, and its token, packed into 64-bit words.  Then the grams that
share a context's last tokens share a prefix: a part holds all grams of its
prefixes, sorted, so the counts of every longer context are made from that part
alone, in one shuffle for all orders.  A prefix with too many grams for a part
(a frequent token, a frequent pair; the empty one always) is *heavy*: its grams
are dealt by the token that comes next, and its counts, summed over parts, are
tables of (heavy prefix, token) dealt by token.  Heavy prefixes are found in a
sample of the grams; a poor sample makes uneven parts, never other counts.  A
held-out target first asks for the probability at its longest heavy prefix,
once for all of a block's equal questions, and then meets the part of its context.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.operators import blocks as BL
from tessera.operators import tokens as TK
from tessera.session import materialize, scratch_path

DISCOUNT = 0.75
#: Training grams of a part, about.
GRAMS = 1 << 20
#: Of so many grams, those that tell heavy prefixes; a heavy one has half of them.
SAMPLES = 64
#: Grams of a stored row at most.
CHUNK = 1 << 15


@dataclass
class Grams:
    """Token arrays in blocks: a gram is every token but a document's first, with
    its ``order - 1`` predecessors in the document (places before it are empty)."""
    blocks: BL.Blocks
    order: int


@dataclass
class Layout:
    """How grams are packed and dealt.  Ids: 0 an empty place, ``top`` an unknown
    token.  ``heavy``: per length of a prefix, the sorted codes (place of the
    prefix without its last token, that token) of the heavy ones.  All heavy
    prefixes are numbered, the empty one 0, by length and then by code."""
    order: int
    top: int
    parts: int
    heavy: list[np.ndarray]

    def __post_init__(self):
        self.bits = max(1, self.top.bit_length())
        self.per_word = 63 // self.bits
        self.words = -(-self.order // self.per_word)
        sizes = [1, *map(len, self.heavy)]
        self.starts = np.cumsum([0, *sizes])
        self.number = int(self.starts[-1])
        self.length = np.repeat(np.arange(len(sizes)), sizes)
        self.parent = np.zeros(self.number, np.int64)
        for k, codes in enumerate(self.heavy, 1):
            self.parent[self.starts[k]:self.starts[k + 1]] = self.starts[k - 1] + codes // (self.top + 1)

    def longest_heavy(self, columns: list[np.ndarray]) -> np.ndarray:
        """The number of each gram's longest heavy prefix."""
        found = np.zeros(len(columns[0]), np.int64)
        rows, at = np.arange(len(found)), np.zeros(len(found), np.int64)
        for k, codes in enumerate(self.heavy, 1):
            place, there = _find(codes, at * (self.top + 1) + columns[k - 1][rows])
            rows, at = rows[there], place[there]
            found[rows] = self.starts[k] + at
        return found

    def part(self, columns: list[np.ndarray], heavy: np.ndarray) -> np.ndarray:
        """By the longest heavy prefix and the token after it."""
        return self.dealt(np.choose(self.length[heavy], columns), heavy)

    def dealt(self, token: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        x = token.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93) * np.asarray(salt, np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) % np.uint64(self.parts)
        return x.astype(np.uint16 if self.parts <= 1 << 16 else np.int32)  # numpy sorts 16 bits by counting

    def pack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        return [reduce(lambda word, c: (word << self.bits) | c, columns[i:i + self.per_word])
                for i in range(0, self.order, self.per_word)]

    def unpack(self, words: np.ndarray) -> list[np.ndarray]:
        out = []
        for i in range(self.order):
            last = min(self.order, (i // self.per_word + 1) * self.per_word) - 1
            out.append((words[:, i // self.per_word] >> (self.bits * (last - i))) & ((1 << self.bits) - 1))
        return out


@dataclass
class Model:
    """``vocabulary`` (token, id); ``parts`` (part, grams): sorted distinct grams
    with their numbers; ``low`` (part, low): counts (heavy prefix, token, count)
    dealt by token; ``totals``: per heavy prefix the sum and the number of its counts."""
    layout: Layout
    vocabulary: DataFrame
    parts: DataFrame
    low: DataFrame
    totals: np.ndarray
    discount: float


def grams(token_arrays: DataFrame, id_col: str, order: int, tokens_col: str = "tokens") -> Grams:
    """The grams of (id, ARRAY<STRING>) rows, in stored blocks."""
    return Grams(BL.pack(token_arrays, id_col, tokens_col), order)


# ---------------------------------------------------------------- arrays of a task
def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in a sorted ``table``, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _columns(slots: pa.Array, codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(document, pos, [predecessors, the nearest first, and the token]) of a block's grams."""
    lengths = pc.fill_null(pc.list_value_length(slots), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = codes[slots.flatten().to_numpy(zero_copy_only=False)]
    pos = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.flatnonzero(pos >= 1)
    doc, pos = np.repeat(np.arange(len(lengths)), lengths)[at], pos[at]
    before = [np.where(pos >= j, ids[np.maximum(at - j, 0)], 0) for j in range(1, order)]
    return doc, pos, [*before, ids[at]]


def _codes(codes: pa.Array, unknown: int) -> np.ndarray:
    return pc.fill_null(codes, unknown).to_numpy(zero_copy_only=False).astype(np.int64)


def _cuts(part: np.ndarray) -> np.ndarray:
    """Ends of the stretches of sorted rows that become a row: of a part, CHUNK at most."""
    return np.unique(np.concatenate([np.flatnonzero(part[1:] != part[:-1]) + 1, np.arange(0, len(part), CHUNK), [len(part)]]))


def _binary(rows: np.ndarray, cuts: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    offsets = (cuts * (rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _rows(column: pa.ChunkedArray, width: int, kind=np.int64) -> np.ndarray:
    found = [np.frombuffer(x.as_buffer(), kind).reshape(-1, width) for x in column if x.is_valid]
    return np.concatenate(found) if found else np.zeros((0, width), kind)


def _order(layout: Layout, words: list[np.ndarray]) -> np.ndarray:
    """The places of packed grams in their order: by 16 bits at a time, which numpy
    sorts by counting."""
    order = None
    for k in range(layout.words - 1, -1, -1):
        held = min(layout.per_word, layout.order - k * layout.per_word) * layout.bits
        for low in range(0, held, 16):
            digit = ((words[k] >> low) & 0xFFFF).astype(np.uint16)
            step = np.argsort(digit if order is None else digit[order], kind="stable")
            order = step if order is None else order[step]
    return order


def _distinct(layout: Layout, rows: np.ndarray) -> np.ndarray:
    """The distinct grams of ``rows`` (words, number), sorted, with the sums of their numbers."""
    rows = rows[_order(layout, [rows[:, k] for k in range(layout.words)])]
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = reduce(np.logical_or, [np.diff(rows[:, k]) != 0 for k in range(layout.words)])
    starts = np.flatnonzero(new)
    found = rows[starts]
    if len(rows):
        found[:, -1] = np.add.reduceat(rows[:, -1], starts)
    return found


def _added(layout: Layout, columns: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """What a part's sorted distinct grams add to the counts of heavy prefixes:
    (prefix, token, count).  A longer context is one way to extend a prefix."""
    heavy, size = layout.longest_heavy(columns), layout.top + 1
    length, out = layout.length[heavy], []
    for k in range(layout.order):
        rows = np.flatnonzero(length == k)
        if k == layout.order - 1:  # whole contexts: each gram is one of their tokens
            out.append(np.stack([heavy[rows], columns[-1][rows], n[rows]], axis=1))
            break
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for c in columns[:k + 1]:
            new[1:] |= np.diff(c[rows]) != 0
        keys = np.unique((np.cumsum(new) - 1) * size + columns[-1][rows])  # (context of k + 1 tokens, token)
        prefix = heavy[rows[new]][keys // size]
        keys, ways = np.unique(prefix * size + keys % size, return_counts=True)
        out.append(np.stack([keys // size, keys % size, ways], axis=1))
    return np.concatenate(out)


def _levels(layout: Layout, columns: list[np.ndarray], n: np.ndarray):
    """Of a part's sorted distinct grams: ``paths``, per length the sorted codes
    (place of the context without its farthest token, that token); and ``tables``,
    per length of the contexts that are not heavy (codes of (context, token),
    counts, totals, numbers of tokens), the last two by context."""
    longest, size = layout.order - 1, layout.top + 1
    length = layout.length[layout.longest_heavy(columns)]
    new = np.zeros(len(n), bool)
    new[:1] = True
    places, firsts, paths = [np.zeros(len(n), np.int64)], [np.flatnonzero(new)], [None]
    for k in range(longest):
        new[1:] |= np.diff(columns[k]) != 0
        firsts.append(np.flatnonzero(new))
        places.append(np.cumsum(new) - 1)
        paths.append(places[k][firsts[-1]] * size + columns[k][firsts[-1]])
    context, token, counts, tables = places[longest], columns[-1], n, {}
    for k in range(longest, 0, -1):  # contexts of k tokens
        whole = (length[firsts[k]] < k)[context]  # else heavy: other parts have grams of it
        if not whole.all():
            context, token, counts = context[whole], token[whole], counts[whole]
        of = len(firsts[k])
        tables[k] = context * size + token, counts, np.bincount(context, counts, of), np.bincount(context, minlength=of)
        if k > 1:  # a longer context is one way to extend a shorter one
            keys, counts = np.unique(places[k - 1][firsts[k]][context] * size + token, return_counts=True)
            context = keys // size
            token = keys - context * size
    return paths, tables


def _blended(p: np.ndarray, n: np.ndarray, total: np.ndarray, kinds: np.ndarray, discount: float) -> np.ndarray:
    """The probability one level up from ``p``."""
    return np.maximum(n - discount, 0.0) / total + discount * kinds / total * p


def _climb(layout: Layout, part: np.ndarray, columns: list[np.ndarray], p: np.ndarray, discount: float) -> np.ndarray:
    """The probabilities of targets, from those at their longest heavy prefixes."""
    own = layout.unpack(part)
    paths, tables = _levels(layout, own, part[:, -1])
    size, length = layout.top + 1, layout.length[layout.longest_heavy(columns)]
    rows, context = np.arange(len(p)), np.zeros(len(p), np.int64)
    for k in range(1, layout.order):
        at, there = _find(paths[k], context * size + columns[k - 1][rows])
        rows, context = rows[there], at[there]
        beyond = length[rows] < k  # the prefix of k tokens is not heavy: this part has all its grams
        some, c = rows[beyond], context[beyond]
        keys, counts, totals, kinds = tables[k]
        at, seen = _find(keys, c * size + columns[-1][some])
        n = np.zeros(len(some))
        n[seen] = counts[at[seen]]
        p[some] = _blended(p[some], n, totals[c], kinds[c], discount)
    return p


# ---------------------------------------------------------------- jobs
def _keep(df: DataFrame) -> DataFrame:
    """As ``store``, for rows of some 100 KB: the writer looks at its size after each."""
    path = scratch_path(df.sparkSession, "stored")
    (df.write.option("compression", "zstd").option("parquet.page.size.row.check.min", 1)
     .option("parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
     .option("parquet.block.size.row.check.max", 1).option("parquet.block.size", 32 << 20).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1)


def _layout(blocks: BL.Blocks, vocabulary: DataFrame, order: int, size: int, tokens: int) -> Layout:
    parts = max(1, -(-tokens // GRAMS))
    share, least, seen = SAMPLES / GRAMS, max(1, SAMPLES // 2), Counter()
    layout = Layout(order, size + 1, parts, [np.zeros(0, np.int64)] * (order - 1))
    if parts == 1 or order == 1:
        return layout

    def run(batches):
        for b in _blocks(batches):
            words, number = b.column(2).flatten(), b.column(0)[0].as_py()
            _, _, columns = _columns(b.column(1).flatten(), np.arange(1, len(words) + 1), order)
            draw = np.random.default_rng(number)
            rows = draw.integers(0, max(1, len(columns[-1])), draw.binomial(len(columns[-1]), min(1.0, share)))
            words = pa.concat_arrays([pa.array([""], words.type), words])
            yield pa.RecordBatch.from_arrays([words.take(pa.array(c[rows])) for c in columns[:-1]], names=names)

    names = [f"t{k}" for k in range(order - 1)]
    drawn = blocks.table.select("block", "slots", "words").mapInArrow(run, ", ".join(f"{x} string" for x in names))
    for row in drawn.collect():
        seen.update(tuple(row[:k]) for k in range(1, order))
    found = [p for p, n in seen.items() if n >= least]
    ids = {r.token: r.id for r in vocabulary.where(F.col("token").isin([*{t for p in found for t in p}])).collect()} | {"": 0}
    heavy, place = [], {(): 0}
    for k in range(1, order):
        some = sorted((place[p[:-1]] * (size + 2) + ids[p[-1]], p) for p in found if len(p) == k)
        place |= {p: i for i, (_, p) in enumerate(some)}
        heavy.append(np.array([code for code, _ in some], np.int64))
    return Layout(order, size + 1, parts, heavy)


def _dealt_grams(blocks: BL.Blocks, vocabulary: DataFrame, layout: Layout) -> DataFrame:
    """(part, grams): the grams of each block with their numbers, rows of one part each."""
    order = layout.order

    def run(batches):
        for b in _blocks(batches):
            if not b.column(1).is_valid()[0].as_py():
                continue
            _, _, columns = _columns(b.column(0).flatten(), _codes(b.column(1).flatten(), layout.top), order)
            heavy, n = layout.longest_heavy(columns), np.ones(len(columns[-1]), np.int64)
            at, part = np.arange(len(n)), layout.part(columns, heavy)
            whole = layout.length[heavy] == order - 1
            if whole.any():  # grams of heavy contexts go once, with their numbers
                some = np.flatnonzero(whole)
                _, first, times = np.unique(heavy[some] * (layout.top + 1) + columns[-1][some], return_index=True, return_counts=True)
                n[some[first]] = times
                at = np.concatenate([np.flatnonzero(~whole), some[first]])
            at = at[np.argsort(part[at], kind="stable")]
            part, cuts = part[at], _cuts(part[at])
            rows = np.stack([*(w[at] for w in layout.pack(columns)), n[at]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), _binary(rows, cuts)], names=["part", "grams"])

    coded = BL.answered(blocks, vocabulary, F.col("id")).select("slots", "codes")
    return coded.mapInArrow(run, "part int, grams binary")


def _sorted_parts(dealt: DataFrame, layout: Layout) -> DataFrame:
    """(part, grams, low): the sorted distinct grams of each part; and in rows of
    their own what they add to the counts of heavy prefixes, dealt by token."""
    schema = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("low", pa.binary())])

    def run(key, table):
        rows = _distinct(layout, _rows(table["grams"], layout.words + 1))
        low = _added(layout, layout.unpack(rows), rows[:, -1])
        cuts = _cuts(np.zeros(len(rows), np.int32))
        of = layout.dealt(low[:, 1])
        order = np.argsort(of, kind="stable")
        of, low_cuts = of[order], _cuts(of[order])
        some, many = len(cuts) - 1, len(low_cuts) - 1
        part = np.concatenate([np.full(some, key[0].as_py(), np.int32), of[low_cuts[:-1]].astype(np.int32)])
        return pa.Table.from_arrays([
            pa.array(part), pa.concat_arrays([_binary(rows, cuts), pa.nulls(many, pa.binary())]),
            pa.concat_arrays([pa.nulls(some, pa.binary()), _binary(low[order], low_cuts)])], schema=schema)

    return dealt.groupBy("part").applyInArrow(run, "part int, grams binary, low binary")


def _low_counts(added: DataFrame, layout: Layout) -> DataFrame:
    """(part, low, totals): the counts of heavy prefixes, sorted by token and prefix,
    and what they add to the prefixes' totals."""
    schema = pa.schema([("part", pa.int32()), ("low", pa.binary()), ("totals", pa.list_(pa.struct([
        ("prefix", pa.int64()), ("total", pa.int64()), ("kinds", pa.int64())])))])

    def run(key, table):
        rows, size = _rows(table["low"], 3), layout.number
        found, keys, counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k in range(layout.order - 1, -1, -1):
            own = rows[layout.length[rows[:, 0]] == k]
            # a heavy prefix, as a longer context, is one way to extend the shorter one
            longer = keys // size * size + layout.parent[keys % size]
            keys, at = np.unique(np.concatenate([own[:, 1] * size + own[:, 0], longer]), return_inverse=True)
            more = np.concatenate([own[:, 2], np.ones(len(longer), np.int64)])
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, more)
            found.append(np.stack([keys, counts], axis=1))
        low = np.concatenate(found)
        low = low[np.argsort(low[:, 0])]
        prefix = low[:, 0] % size
        kinds = np.bincount(prefix, minlength=size)
        some = np.flatnonzero(kinds)
        total = np.zeros(size, np.int64)
        np.add.at(total, prefix, low[:, 1])
        totals = [{"prefix": int(h), "total": int(total[h]), "kinds": int(kinds[h])} for h in some]
        cuts = _cuts(np.zeros(len(low), np.int32))
        return pa.Table.from_arrays([
            pa.array(np.full(len(cuts) - 1, key[0].as_py(), np.int32)), _binary(low, cuts),
            pa.array([totals] + [[]] * (len(cuts) - 2), schema.field("totals").type)[:len(cuts) - 1]], schema=schema)

    return added.groupBy("part").applyInArrow(
        run, "part int, low binary, totals array<struct<prefix bigint, total bigint, kinds bigint>>")


def fit(token_arrays: DataFrame, id_col: str, order: int, tokens_col: str = "tokens",
        discount: float = DISCOUNT) -> tuple[Model, int]:
    """(model, vocabulary size)."""
    blocks = grams(token_arrays, id_col, order, tokens_col).blocks
    known = TK.vocabulary(blocks)
    vocabulary = materialize(known.select("token", F.when(F.col("token") == "", 0).otherwise(F.col("token_id") + 1).alias("id")))
    size, tokens = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("freq"), F.lit(0))).first()
    layout = _layout(blocks, vocabulary, order, size, tokens)
    kept = _keep(_sorted_parts(_dealt_grams(blocks, vocabulary, layout), layout))
    low = _keep(_low_counts(kept.where(F.col("low").isNotNull()).select("part", "low"), layout))
    totals = np.zeros((layout.number, 2), np.int64)
    sums = low.select(F.explode("totals").alias("t")).groupBy("t.prefix").agg(
        F.sum("t.total").alias("total"), F.sum("t.kinds").alias("kinds"))
    for r in sums.collect():
        totals[r.prefix] = r.total, r.kinds
    parts = kept.where(F.col("grams").isNotNull()).select("part", "grams")
    return Model(layout, vocabulary, parts, low.select("part", "low"), totals, discount), size + 1


def _asked(layout: Layout, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (longest heavy prefix, token) of a block's targets as codes, sorted
    by the part of the token; their parts; and for each target its place among them."""
    keys, at = np.unique(columns[-1] * layout.number + layout.longest_heavy(columns), return_inverse=True)
    part = layout.dealt(keys // layout.number)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return keys[order], part[order], place[at]


def _base(model: Model, vocab_size: int, keys: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The probabilities at heavy prefixes of ``keys``, codes as in ``_asked``."""
    layout = model.layout
    token, prefix = keys // layout.number, keys % layout.number
    chain = [prefix]  # from the longest to the empty one; a shorter start repeats the empty one
    for _ in range(layout.order - 1):
        chain.append(layout.parent[chain[-1]])
    p, done = np.full(len(keys), 1.0 / vocab_size), np.full(len(keys), -1)
    for h in reversed(chain):
        rows = np.flatnonzero((h != done) & (model.totals[h, 0] > 0))
        at, seen = _find(low[:, 0], token[rows] * layout.number + h[rows])
        n = np.zeros(len(rows))
        n[seen] = low[at[seen], 1]
        total, kinds = model.totals[h[rows]].T
        p[rows] = _blended(p[rows], n, total, kinds, model.discount)
        done = h
    return p


def nll_per_target(targets: Grams, model: Model, vocab_size: int, id_col: str, order: int) -> DataFrame:
    """(id, pos, nll) of the held-out ``grams`` of the same order.  Rows that
    share an id are one document: a place of it is a target once, with the
    largest of its probabilities."""
    layout, parts, low = model.layout, model.parts, model.low
    bare = Model(layout, None, None, None, model.totals, model.discount)  # goes to the tasks
    coded = materialize(BL.answered(targets.blocks, model.vocabulary, F.col("id")).select("block", "ids", "slots", "codes"))
    kind = coded.schema["ids"].dataType.elementType.simpleString()

    def columns_of(slots: pa.Array, codes: pa.Array):
        known = codes.flatten() if codes.is_valid()[0].as_py() else pa.array([], pa.int64())
        return _columns(slots.flatten(), _codes(known, layout.top), layout.order)

    def ask(batches):
        for b in _blocks(batches):
            _, _, columns = columns_of(b.column(1), b.column(2))
            keys, part, _ = _asked(layout, columns)
            cuts = _cuts(part)
            number = np.full(len(cuts) - 1, b.column(0)[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(number), pa.array(cuts[:-1].astype(np.int64)), _binary(keys, cuts)],
                names=["part", "block", "first", "keys"])

    def answer(asked, counts):
        low = _rows(counts["low"], 2)
        keys = [np.frombuffer(x.as_buffer(), np.int64) for x in asked["keys"]]
        p = _base(bare, vocab_size, np.concatenate([*keys, np.zeros(0, np.int64)]), low)
        cuts = np.cumsum([0, *map(len, keys)])
        return pa.table({"block": asked["block"], "first": asked["first"], "p": _binary(p, cuts)})

    def deal(blocks, answers):
        b = blocks.combine_chunks().to_batches()[0]
        doc, pos, columns = columns_of(b.column("slots"), b.column("codes"))
        _, _, place = _asked(layout, columns)
        p = np.zeros(sum(len(x.as_buffer()) for x in answers["p"]) // 8)
        for first, x in zip(answers["first"].to_pylist(), answers["p"], strict=True):
            some = np.frombuffer(x.as_buffer(), np.float64)
            p[first:first + len(some)] = some
        part = layout.part(columns, layout.longest_heavy(columns))
        order = np.argsort(part, kind="stable")
        part, cuts = part[order], _cuts(part[order])
        ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), b.column("ids").flatten().take(pa.array(doc[order])))
        rows = np.stack([*(w[order] for w in layout.pack(columns)), pos[order]], axis=1)
        return pa.Table.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), ids, _binary(rows, cuts), _binary(p[place][order], cuts)],
                                    names=names)

    def climb(asked, counts):
        rows = _rows(asked["targets"], layout.words + 1)
        if not len(rows):
            return nothing
        p = _rows(asked["p"], 1, np.float64)[:, 0]
        p = _climb(layout, _rows(counts["grams"], layout.words + 1), layout.unpack(rows), p.copy(), bare.discount)
        return pa.table([asked["ids"].combine_chunks().flatten(), pa.array(rows[:, -1]), pa.array(-np.log(p))], names=[id_col, "pos", "nll"])

    names = ["part", "ids", "targets", "p"]
    nothing = to_arrow_schema(StructType().add(id_col, coded.schema["ids"].dataType.elementType).add("pos", "long").add("nll", "double")).empty_table()
    asks = coded.select("block", "slots", "codes").mapInArrow(ask, "part int, block bigint, first bigint, keys binary")
    answers = asks.groupBy("part").cogroup(low.groupBy("part")).applyInArrow(answer, "block bigint, first bigint, p binary")
    dealt = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        deal, f"part int, ids array<{kind}>, targets binary, p binary")
    nll = dealt.groupBy("part").cogroup(parts.groupBy("part")).applyInArrow(climb, f"{id_col} {kind}, pos bigint, nll double")
    if targets.blocks.ids().groupBy(id_col).count().where("count > 1").isEmpty():
        return nll
    return nll.groupBy(id_col, "pos").agg(F.min("nll").alias("nll"))
