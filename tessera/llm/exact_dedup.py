"""Exact dedup with Patricia-trie owners.

Every text gets the key ``length | content hash | bytes``.  Each scan task
inserts its keys into a compressed radix trie whose terminal nodes hold the
surviving id and the number of rows, so any group of copies leaves a task as
one row (pre-aggregation before the shuffle).  Those rows go to the owner of
their (length, content hash); owners read them in key order and insert the full
byte strings into a trie again, so equality is decided byte by byte.  A trie
over its memory bound spills whole subtrees: a scan task emits its largest
subtrees early (their owner merges them), an owner emits the subtrees that its
sorted input has passed.  No group of copies is ever held as rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_by_key, batches_of, id_text, released, stored
from tessera.session import shuffle_partitions

#: Bytes that one trie may hold (labels and a charge per node) before it spills.
TRIE_BYTES = 48 << 20
_NODE = 220
_HEAD, _HEAD_BYTES = ">QQ", 16


class Node:
    __slots__ = ("label", "kids", "keep", "count")

    def __init__(self, label: bytes, keep=None, count: int = 0):
        self.label, self.kids, self.keep, self.count = label, None, keep, count


def _merge(a, b, larger: bool):
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if larger else min(a, b)


class PatriciaTrie:
    """Compressed radix trie of byte strings; a terminal keeps one id (the
    smallest, or the largest) and a row count (0: not a terminal)."""

    def __init__(self, larger: bool = False):
        self.larger, self.root, self.bytes = larger, Node(b""), 0

    def insert(self, key: bytes, keep, count: int = 1) -> None:
        node, i = self.root, 0
        while i < len(key):
            kids = node.kids
            child = kids.get(key[i]) if kids else None
            if child is None:
                if kids is None:
                    node.kids = kids = {}
                kids[key[i]] = Node(key[i:], keep, count)
                self.bytes += len(key) - i + _NODE
                return
            if not key.startswith(child.label, i):
                child = self._split(node, child, key, i)
            node, i = child, i + len(child.label)
        node.keep = _merge(node.keep, keep, self.larger)
        node.count += count

    def _split(self, parent: Node, child: Node, key: bytes, i: int) -> Node:
        label = child.label
        lo, hi = 1, min(len(label), len(key) - i)  # the first byte is equal
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if key.startswith(label[:mid], i):
                lo = mid
            else:
                hi = mid - 1
        middle = Node(label[:lo])
        child.label = label[lo:]
        middle.kids = {child.label[0]: child}
        parent.kids[label[0]] = middle
        self.bytes += _NODE
        return middle

    @staticmethod
    def terminals(node: Node, prefix: bytes) -> Iterator[tuple]:
        """(key, id, count) of a subtree, in key order, without recursion."""
        stack = [(node, prefix)]
        while stack:
            n, path = stack.pop()
            path = path + n.label
            if n.count:
                yield path, n.keep, n.count
            if n.kids:
                stack.extend((n.kids[b], path) for b in sorted(n.kids, reverse=True))

    def spill(self, below: bytes | None = None) -> Iterator[tuple]:
        """Emit and drop subtrees: all of those wholly before ``below`` in key
        order, or without it the largest ones until half of the bound is left."""
        if below is None:
            parts = sorted(((self._weight(k), b) for b, k in (self.root.kids or {}).items()), reverse=True)
            for size, b in parts:
                if self.bytes <= TRIE_BYTES // 2:
                    break
                yield from self.terminals(self.root.kids.pop(b), b"")
                self.bytes -= size
            return
        node, path = self.root, b""
        while node is not None:
            nxt = None
            for b in sorted(node.kids or {}):
                kid = node.kids[b]
                full = path + kid.label
                if below.startswith(full):
                    nxt = (kid, full)
                elif full < below:
                    self.bytes -= self._weight(kid)
                    yield from self.terminals(node.kids.pop(b), path)
            node, path = nxt or (None, b"")

    @staticmethod
    def _weight(node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            n = stack.pop()
            total += len(n.label) + _NODE
            if n.kids:
                stack.extend(n.kids.values())
        return total

    def drain(self) -> Iterator[tuple]:
        yield from self.terminals(self.root, b"")
        self.root, self.bytes = Node(b""), 0


_PARTIAL = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("body", pa.binary()),
                      ("keep_id", pa.int64()), ("n", pa.int64())])
_OWNED = pa.schema([("length", pa.int64()), ("digest", pa.binary()), ("keep_id", pa.int64()),
                    ("group_size", pa.int64())])


def _key(length: int, h: int, body: bytes) -> bytes:
    return struct.pack(_HEAD, length, h + (1 << 63)) + body  # unsigned order = signed order


def _scan_tries(larger: bool) -> Callable:
    def run(batches):
        def rows():
            trie = PatriciaTrie(larger)
            for b in batches:
                for length, h, body, i in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    trie.insert(_key(length, h, body), i)
                    if trie.bytes > TRIE_BYTES:
                        yield from map(_part, trie.spill())
            yield from map(_part, trie.drain())
        yield from batches_of(rows(), _PARTIAL)
    return run


def _part(terminal: tuple) -> tuple:
    key, keep, count = terminal
    length, h = struct.unpack_from(_HEAD, key)
    return length, h - (1 << 63), key[_HEAD_BYTES:], keep, count


def _owner_tries(larger: bool) -> Callable:
    def run(batches):
        def own(terminals):
            for key, keep, count in terminals:
                body = key[_HEAD_BYTES:]
                yield len(body), hashlib.sha256(body).digest(), keep, count

        def rows():
            trie, length = PatriciaTrie(larger), None
            for b in batches:
                for n, h, body, keep, count in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                    if n != length:
                        yield from own(trie.drain())
                        length = n
                    elif trie.bytes > TRIE_BYTES:
                        yield from own(trie.spill(_key(n, h, b"")))
                    trie.insert(_key(n, h, body), keep, count)
            yield from own(trie.drain())
        yield from batches_of(rows(), _OWNED)
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", larger: bool = False,
                normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (id of the row that stays
    in its group: the smallest, with ``larger`` the largest), ``group_size``,
    ``kept``, ``text_sha256``.

    Null text counts as the empty text, which is a text like any other.  Null
    ids lose to any id; a group of null ids has a null ``keep_id`` and all its
    rows are kept.  Rows repeated under one id are counted each and share
    ``kept``.  An empty table gives an empty result.  Other columns of ``docs``
    are not read.  ``normalise`` may map the text before it is compared."""
    rows = id_text(docs, id_col, text_col)
    if normalise is not None:
        rows = rows.withColumn("text", normalise(F.col("text")))
    raw = rows.select(F.octet_length("text").cast("long").alias("length"), F.xxhash64("text").alias("hash"),
                      F.col("text").cast("binary").alias("body"), F.col("doc_id").alias("keep_id"))
    parts = raw.mapInArrow(released(_scan_tries(larger)), "length long, hash long, body binary, keep_id long, n long")
    n = shuffle_partitions(docs.sparkSession)
    owned = (parts.repartition(n, "length", "hash").sortWithinPartitions("length", "hash")
             .mapInArrow(released(_owner_tries(larger)), "length long, digest binary, keep_id long, group_size long"))
    owned = stored(owned, "owners")
    keyed = rows.select("doc_id", F.octet_length("text").cast("long").alias("length"),
                        F.unhex(F.sha2("text", 256)).alias("digest"))
    found = attach_by_key(keyed, owned, ["length", "digest"], "group_size", F.col("doc_id"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))
