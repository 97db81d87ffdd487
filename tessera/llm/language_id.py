"""Language identification by prediction by partial matching (PPM).

Per language a variable-order byte context tree (orders 0 to 3) holds frozen
statistics: how often each byte followed each context.  A byte is coded in the
longest context the tree holds; where it was never seen there, an escape
(method C: distinct over total plus distinct) leads to the next shorter one,
with the bytes of the longer context excluded, down to all bytes alike.  The
exact code length of every (context, byte) is worked out once per language, so
scoring a text is a table look-up per byte; the language of the shortest code
wins.

Counting covers every byte of every training row, is combined per task and
summed by Spark; the driver receives at most ``max_nodes`` tree leaves, an equal
share of them for every language whatever its part of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_text, spread
from tessera.operators.ranking import rank_within_groups

#: Bytes scored at once, and counted at once.
WINDOW = 1 << 20
_UNKNOWN = "und"


def _codes(buf: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For bytes lo..hi: the byte and the three before it in its text (0 before
    its start), as one 32-bit number."""
    out = buf[lo:hi].astype(np.uint32)
    where = np.arange(lo, hi)
    start = offsets[np.searchsorted(offsets, where, side="right") - 1]
    for k in (1, 2, 3):
        there = where - k >= start
        prev = np.zeros(hi - lo, np.uint32)
        prev[there] = buf[where[there] - k]
        out |= prev << np.uint32(8 * k)
    return out


def _count(batches):
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
    names: dict[str, int] = {}
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(k, n):
        u, inv = np.unique(k, return_inverse=True)
        return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64)

    def flush():
        lang = pa.DictionaryArray.from_arrays(pa.array((keys >> np.uint64(32)).astype(np.int32)),
                                              pa.array(list(names), pa.string())).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [lang, pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)], schema=schema)

    for b in batches:
        buf, offsets = arrow_text(b)
        of = np.array([names.setdefault(x, len(names)) for x in b.column(0).to_pylist()], np.uint64)
        edges = offsets[:-1]
        for lo in range(int(offsets[0]), int(offsets[-1]), 4 * WINDOW):
            hi = min(lo + 4 * WINDOW, int(offsets[-1]))
            row = np.searchsorted(edges, np.arange(lo, hi), side="right") - 1
            k, n = np.unique((of[row] << np.uint64(32)) | _codes(buf, offsets, lo, hi), return_counts=True)
            keys, counts = merge(np.concatenate([keys, k]), np.concatenate([counts, n]))
            if len(keys) > 2_000_000:
                yield flush()
                keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield flush()


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray   # byte -> symbol
    state: np.ndarray    # three symbols -> row of the longest known context
    bits: np.ndarray     # (row, symbol, language) -> code length


def _tree_bits(codes: np.ndarray, n: np.ndarray, symbols: int, share: np.ndarray,
               contexts: list[np.ndarray]) -> np.ndarray:
    """Code lengths (rows: the given contexts of order 0, 1, 2, 3 in turn; one
    column per symbol) of one language.  ``codes``: four symbols in base
    ``symbols``; ``share``: bits of telling apart the bytes of a symbol."""
    s = symbols
    below = None
    rows = []
    for order, known in enumerate(contexts):
        width = s ** (order + 1)
        u, inv = np.unique(codes % width, return_inverse=True)
        total = np.bincount(inv, weights=n)
        ctx, sym = u // s, (u % s).astype(np.int64)
        count = np.zeros((len(known), s), np.float64)
        at = np.searchsorted(known, ctx)
        ok = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == ctx)
        count[at[ok], sym[ok]] = total[ok]
        if below is None:
            lower = np.full((len(known), s), 1.0)
            lower *= 2.0 ** share  # order -1: every byte alike
            lower /= lower.sum(axis=1, keepdims=True)
        else:
            parent = np.searchsorted(contexts[order - 1], known % (s ** (order - 1)))
            lower = below[parent]
        sums, distinct = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
        unseen = np.where(count > 0, 0.0, lower)  # exclusion: what the longer context holds cannot follow an escape
        left = unseen.sum(axis=1, keepdims=True)
        escape = np.where(sums > 0, distinct / np.maximum(sums + distinct, 1), 1.0)
        escape = np.where(left > 0, escape, 0.0)
        seen = np.where(left > 0, count / np.maximum(sums + distinct, 1), count / np.maximum(sums, 1))
        p = seen + escape * unseen / np.maximum(left, 1e-300)
        below = p
        rows.append(p)
    return (-np.log2(np.maximum(np.concatenate(rows), 1e-12)) + share).astype(np.float32)


def build_model(languages: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray,
                max_contexts: int = 40_000) -> Model:
    """Context trees from counts of (language, three context bytes, byte).  Every
    byte that occurs has its own symbol; contexts of three bytes are each
    language's own most frequent ones, ``max_contexts`` over all languages."""
    total = np.bincount((code & 255).astype(np.int64), weights=n, minlength=256)
    total[0] = total.sum() + 1  # the byte before a text's start always has its own symbol
    own = np.argsort(-total, kind="stable")
    own = own[total[own] > 0]
    s = len(own) + 1
    symbol = np.zeros(256, np.int64)
    symbol[own] = np.arange(1, s)
    share = np.zeros(s)
    share[0] = np.log2(max(256 - len(own), 1))
    parts = [symbol[(code >> sh) & 255] for sh in (24, 16, 8, 0)]
    number = ((parts[0] * s + parts[1]) * s + parts[2]) * s + parts[3]
    context = number // s
    contexts = [np.zeros(1, np.int64), np.arange(s), np.arange(s * s)]
    contexts[2] = np.unique(context % (s * s))
    each = max(max_contexts // len(languages), 1)
    chosen = []
    for k in range(len(languages)):
        u, inv = np.unique(context[lang == k], return_inverse=True)
        chosen.append(u[np.argsort(-np.bincount(inv, weights=n[lang == k]), kind="stable")[:each]])
    contexts.append(np.unique(np.concatenate(chosen)))
    at = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    state = np.empty(s ** 3, np.int32)
    for first in range(s):  # by the first of three symbols, which bounds the working arrays
        every = np.arange(first * s * s, (first + 1) * s * s)
        here = at[1] + every % s  # order 1 always holds
        for order in (2, 3):
            known = contexts[order]
            c = every % (s ** order)
            i = np.minimum(np.searchsorted(known, c), len(known) - 1)
            here = np.where(known[i] == c, at[order] + i, here)
        state[every] = here
    # an order-3 or order-1 context whose order-2 parent is unknown falls back to order 1
    bits = np.stack([_tree_bits(number[lang == k], n[lang == k], s, share, contexts)
                     for k in range(len(languages))], axis=2)
    return Model(languages, symbol, state, bits)


def fit(docs: DataFrame, held_out_mod: int = 3, held_out_rest: int = 1, max_nodes: int = 1_500_000) -> Model | None:
    """Context trees of every language of the rows with a text, an id and a
    language whose ``crc32(id as text) mod held_out_mod`` is not
    ``held_out_rest``.  All their bytes are counted; of each language's distinct
    (context, byte) leaves its own most frequent ``max_nodes / languages`` stay
    (the bound of the model), so no language crowds out another.  None without
    such rows."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
            .where("lang is not null and text is not null and doc_id is not null")
            .where(F.crc32(F.col("doc_id").cast("string")) % held_out_mod != held_out_rest).select("lang", "text"))
    counts = (spread(rows).mapInArrow(_count, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    ranked = rank_within_groups(counts, ["lang"], [F.desc("n"), F.col("code")])
    each = max(max_nodes // max(ranked.select("lang").distinct().count(), 1), 1)
    counts = ranked.where(F.col("rank") < each).orderBy(F.desc("n"), "lang", "code").select("lang", "code", "n").toArrow()
    if not counts.num_rows:
        return None
    lang = counts.column("lang").combine_chunks().dictionary_encode()
    names = lang.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    back = np.argsort(order)
    return build_model([names[i] for i in order], back[lang.indices.to_numpy()],
                       counts.column("code").to_numpy(), counts.column("n").to_numpy().astype(np.float64))


def code_lengths(model: Model, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text under every language."""
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    s = int(model.symbol.max()) + 1
    table = model.bits.reshape(-1, len(model.languages))
    edges = offsets[:-1]
    for lo in range(int(offsets[0]), int(offsets[-1]), WINDOW):
        hi = min(lo + WINDOW, int(offsets[-1]))
        head = max(lo - 3, int(offsets[0]))
        sym = model.symbol[buf[head:hi]]
        pad = int(model.symbol[0])
        first = np.searchsorted(edges, lo, side="right") - 1
        last = np.searchsorted(edges, hi, side="left")
        begin = edges[first:last]
        ctx = np.zeros(hi - lo, np.int64)
        for k in (3, 2, 1):
            prev = np.full(hi - lo, pad, np.int64)
            shift = lo - k - head
            if shift >= 0:
                prev[:] = sym[shift:shift + hi - lo]
            else:
                prev[-shift:] = sym[:hi - lo + shift]
            for j in range(k):  # the first bytes of a text see nothing of the one before
                at = begin + j - lo
                prev[at[(at >= 0) & (at < hi - lo)]] = pad
            ctx = ctx * s + prev
        cost = table[model.state[ctx].astype(np.int64) * s + sym[lo - head:]]
        size = np.diff(np.append(np.maximum(begin, lo), hi))
        full = size > 0
        starts = (np.maximum(begin, lo) - lo)[full]
        out[np.arange(first, last)[full]] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
    return out


def _predict(shared) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        model = shared.value
        names = np.array(model.languages, object)
        for b in batches:
            buf, offsets = arrow_text(b)
            letters = b.column(2).to_numpy(zero_copy_only=False)
            size = np.maximum(np.diff(offsets), 1)[:, None]
            bits = code_lengths(model, buf, offsets) / size
            best = bits.argmin(axis=1) if len(bits) else np.zeros(0, int)
            p = 2.0 ** -(bits - bits.min(axis=1, keepdims=True)) if len(bits) else bits
            sure = 1 / p.sum(axis=1) if len(bits) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.where(letters, names[best], _UNKNOWN), pa.string()),
                 pa.array(np.where(letters, sure, 0.0))], schema=schema)
    return run


def identify(docs: DataFrame, model: Model | None, held_out_mod: int = 3, held_out_rest: int = 1) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``
    (share of the best language when each is weighted by 2 to the minus bits a
    byte).  A text that is null or holds no letter is ``und`` with score 0, and
    so is every text without a model.  Of equal code lengths the language first
    in order wins.  A null id is not held out; other columns are not read."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out_mod == held_out_rest, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if model is None:
        return rows.select("doc_id", out.alias("held_out"), F.lit(_UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_nodes and max_contexts
    rows = spread(rows).withColumn("letters", F.col("text").rlike(r"\p{L}"))
    found = rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
