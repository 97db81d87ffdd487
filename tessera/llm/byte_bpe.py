"""Byte-level BPE encoding and decoding with segment trees.

A pre-token's bytes are the leaves of a segment tree.  Leaf ``i`` holds the
rank of the pair that starts at the live symbol ``i`` (nothing where there is
none), joined with ``i``, so the root is the leftmost pair of the smallest
rank.  A merge changes three leaves: the pair is replaced by the merged
symbol's pair with its live right neighbour, its right half goes, and the live
left neighbour pairs with the new symbol; each is a point update up the tree.
Short pre-tokens of similar length go through this in step, one tree per row of
an array; a long one has a tree of its own, so a pre-token of ``n`` bytes costs
``n log n``.

Ids equal those of the tiktoken library without special tokens: a pre-token
that is itself in the vocabulary is its own id.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_text, released, spread, text_slices

_NONE = np.int64(1) << np.int64(62)
#: Pre-tokens up to this many bytes are merged in step with others.
SHORT = 64
#: Pre-tokens remembered per task process, and characters handled at once.
REMEMBERED, TEXT_BLOCK = 60_000, 1 << 20
#: Byte positions of the pieces that are merged side by side.
STEP_CELLS = 1 << 18


class Ranks:
    """A vocabulary (token bytes and their ids) and its pair table."""

    def __init__(self, raw: bytes):
        self.id_of = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines()) if t}
        self.bytes_of = {r: t for t, r in self.id_of.items()}
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        keys, ids = [], []
        for token, rank in self.id_of.items():
            for cut in range(1, len(token)):
                a, b = self.id_of.get(token[:cut]), self.id_of.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ids.append(rank)
        self.pair = dict(zip(keys, ids, strict=True))
        # open addressing: a table of keys and ranks for whole arrays of pairs
        self.mask = (1 << max(4, (4 * len(keys)).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, _NONE, np.int64)
        left, lid = np.array(keys, np.int64), np.array(ids, np.int64)
        at = self._hash(left)
        while len(left):
            free = self.slots[at] < 0
            _, first = np.unique(np.where(free, at, -1), return_index=True)
            put = np.zeros(len(left), bool)
            put[first] = True
            put &= free
            self.slots[at[put]], self.values[at[put]] = left[put], lid[put]
            left, lid, at = left[~put], lid[~put], (at[~put] + 1) & self.mask

    def _hash(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(32)).astype(np.int64) & self.mask

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge."""
        key = (a << 32) | b
        at = self._hash(key)
        out = np.full(len(key), _NONE, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            slot = self.slots[at[todo]]
            hit = slot == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (slot >= 0)]
            at[todo] = (at[todo] + 1) & self.mask
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each pre-token."""
        out: list = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.id_of.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > SHORT:
                out[i] = self._long(p)
            else:
                by_width.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, at in by_width.items():
            rows = max(64, STEP_CELLS // width)
            for lo in range(0, len(at), rows):
                some = at[lo:lo + rows]
                for i, ids in zip(some, self._in_step([pieces[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def _in_step(self, pieces: list[bytes], width: int) -> Iterator[bytes]:
        n = len(pieces)
        size = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        symbol = self.byte_id[text]
        place = np.arange(width)
        live = place[None, :] < size[:, None]
        after = np.where(place[None, :] + 1 < size[:, None], place[None, :] + 1, -1)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), _NONE, np.int64)
        r, i = np.nonzero(after >= 0)
        rank = self.lookup(symbol[r, i], symbol[r, i + 1])
        tree[r, width + i] = np.where(rank < _NONE, rank * width + i, _NONE)
        for level in range(width - 1, 0, -1):
            tree[:, level] = np.minimum(tree[:, 2 * level], tree[:, 2 * level + 1])
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            best = tree[rows, 1]
            i, merged = best % width, best // width
            j = after[rows, i]
            symbol[rows, i] = merged
            live[rows, j] = False
            k = after[rows, j]
            after[rows, i] = k
            has = k >= 0
            before[rows[has], k[has]] = i[has]
            leaf = np.full(len(rows), _NONE, np.int64)
            leaf[has] = self._leaf(symbol[rows[has], i[has]], symbol[rows[has], k[has]], i[has], width)
            self._update(tree, rows, i, leaf, width)
            self._update(tree, rows, j, np.full(len(rows), _NONE, np.int64), width)
            h = before[rows, i]
            has = h >= 0
            self._update(tree, rows[has], h[has],
                         self._leaf(symbol[rows[has], h[has]], merged[has], h[has], width), width)
            rows = rows[tree[rows, 1] < _NONE]
        ids = symbol[live].astype("<u4").tobytes()
        at = 0
        for c in live.sum(axis=1).tolist():
            yield ids[at:at + 4 * c]
            at += 4 * c

    def _leaf(self, a, b, i, width):
        rank = self.lookup(a, b)
        return np.where(rank < _NONE, rank * width + i, _NONE)

    @staticmethod
    def _update(tree, rows, i, value, width):
        at = i + width
        tree[rows, at] = value
        at >>= 1
        while width > 1:
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            at = at >> 1
            width >>= 1

    def _long(self, piece: bytes) -> bytes:
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        none = int(_NONE)
        pair = self.pair
        symbol = array("q", self.byte_id[np.frombuffer(piece, np.uint8)].tobytes())
        after = array("q", range(1, n + 1))
        before = array("q", range(-1, n - 1))
        leaves = np.full(2 * width, _NONE, np.int64)
        s = np.frombuffer(symbol, np.int64)
        rank = self.lookup(s[:-1], s[1:])
        leaves[width:width + n - 1] = np.where(rank < _NONE, rank * width + np.arange(n - 1), _NONE)
        del s
        step = width
        while step > 1:
            leaves[step // 2:step] = np.minimum(leaves[step:2 * step:2], leaves[step + 1:2 * step:2])
            step //= 2
        tree = array("q", leaves.tobytes())

        def put(i: int, value: int) -> None:
            at = i + width
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                low = a if a < b else b
                if tree[at] == low:
                    return
                tree[at] = low
                at >>= 1

        dead = bytearray(n)
        while tree[1] < none:
            merged, i = divmod(tree[1], width)
            j = after[i]
            k = after[j]
            symbol[i], after[i] = merged, k
            dead[j] = 1
            r = none
            if k < n:
                before[k] = i
                r = pair.get(merged << 32 | symbol[k], -1)
                r = none if r < 0 else r * width + i
            put(j, none)
            put(i, r)
            h = before[i]
            if h >= 0:
                r = pair.get(symbol[h] << 32 | merged, -1)
                put(h, none if r < 0 else r * width + h)
        alive = np.frombuffer(dead, np.uint8) == 0
        return np.frombuffer(symbol, np.int64)[alive].astype("<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_LOADED: dict[bytes, Ranks] = {}


def load_ranks(raw: bytes) -> Ranks:
    """The vocabulary of a rank file's content, built once per process."""
    key = hashlib.sha256(raw).digest()
    if key not in _LOADED:
        _LOADED[key] = Ranks(raw)
    return _LOADED[key]


class TextEncoder:
    """Whole texts to ids; remembers a bounded number of pre-tokens."""

    def __init__(self, ranks: Ranks, pattern: str):
        import regex

        self.ranks, self.pattern, self.known = ranks, regex.compile(pattern), {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(texts) == 1 and len(texts[0]) > TEXT_BLOCK:  # a very long text goes through in stretches
            found = (m.group() for m in self.pattern.finditer(texts[0]))
            out = []
            while some := list(islice(found, 200_000)):
                out.append(self._ids([some])[0])
            return [b"".join(out)]
        return self._ids([self.pattern.findall(t) for t in texts])

    def _ids(self, split: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.ranks.encode_pieces([p.encode() for p in new]), strict=True))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]


def _encode(raw, pattern: str, check: bool = False) -> Callable:
    def run(batches):
        ranks = load_ranks(raw.value)
        encoder = TextEncoder(ranks, pattern)
        for b in batches:
            ids = b.column(0)
            for _, _, lo, hi in text_slices(b, size=TEXT_BLOCK):
                texts = b.column(1).slice(lo, hi - lo).to_pylist()
                parts = encoder(texts)
                at = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
                cols = [ids.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at), flat)]
                if check:
                    cols.append(pa.array([ranks.decode(np.frombuffer(p, "<u4")) == t.encode()
                                          for p, t in zip(parts, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "round_trip"][:len(cols)])
    return run


def _decode(raw) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("ids_sha256", pa.string()), ("data", pa.binary())])

    def run(batches):
        ranks = load_ranks(raw.value)
        for b in batches:
            docs, lists = b.column(0).to_pylist(), b.column(1)
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            rows, size = [], 0
            for i, doc in enumerate(docs):
                ids = flat[at[i]:at[i + 1]]
                data = ranks.decode(ids)
                rows.append((doc, hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), data))
                size += len(data)
                if size > 1 << 21:
                    yield _rows(rows, schema)
                    rows, size = [], 0
            if rows:
                yield _rows(rows, schema)
    return run


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                       zip(zip(*rows), schema, strict=True)], schema=schema)


def read_ranks(path: str) -> bytes:
    """Content of a rank file (``base64 rank`` lines).  It is read by the driver
    and broadcast: its size, not the data's, bounds the broadcast."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``ids`` (array of int).  Null text
    gives no ids; a null id stays null; repeated rows are encoded each; other
    columns are not read; an empty table gives an empty result."""
    raw = docs.sparkSession.sparkContext.broadcast(ranks)
    return spread(id_text(docs, id_col, text_col)).mapInArrow(_encode(raw, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """The way back: ``doc_id``, ``data`` (the bytes of the ids) and
    ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers).  A
    null list counts as empty; an unknown id fails the job."""
    raw = encoded.sparkSession.sparkContext.broadcast(ranks)
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(_decode(raw), "doc_id long, ids_sha256 string, data binary")


def encode_checked(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``encode`` with ``round_trip``: whether the decoded ids are the text's bytes."""
    raw = docs.sparkSession.sparkContext.broadcast(ranks)
    return spread(id_text(docs)).mapInArrow(released(_encode(raw, pattern, True)),
                                            "doc_id long, ids array<int>, round_trip boolean")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Encode and decode: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    raw = docs.sparkSession.sparkContext.broadcast(ranks)
    encoded = encode(docs, ranks, pattern)
    back = encoded.mapInArrow(_digest(raw), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return back


def _digest(raw) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches):
        ranks = load_ranks(raw.value)
        for b in batches:
            lists = b.column(1)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows = []
            for i, doc in enumerate(b.column(0).to_pylist()):
                ids = flat[at[i]:at[i + 1]]
                rows.append((doc, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                             hashlib.sha256(ranks.decode(ids)).hexdigest()))
            if rows:
                yield _rows(rows, schema)
    return run
