"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores the postings of every training word: one segment per
batch of whole documents holds its distinct terms (64-bit word hashes, sorted),
where each term's list starts, and the lists themselves (word positions in the
segment, ascending), as binary columns of a Parquet table in the shared folder.

A benchmark item is cut into windows of ``window`` consecutive words.  The
corpus counts of the test terms come from the stored list lengths.  Each window
is looked up from its rarest term: the term's list, shifted by the term's place
in the window, gives candidate starts, and the lists of the other terms,
rarest first, shifted alike, are intersected with it.  What is left is an exact
phrase occurrence.  With ``slop`` an occurrence of all of a window's words in
any order within ``window + slop`` words around the rarest one is a proximity
match.

The test side goes to the tasks in blocks of at most ``BLOCK_WORDS`` words (a
bound that does not grow with the data); a larger benchmark takes more passes
over the stored index, each of all segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_text, released, spread, stored, text_slices
from tessera.llm.textkernel import ALNUM, word_hashes

#: Words of benchmark text that one pass over the index looks up.
BLOCK_WORDS = 1_000_000
#: Words after which a segment is closed (a document is never cut).
SEGMENT_WORDS = 500_000
#: Candidate starts that are intersected at once.
CHUNK = 200_000

_INDEX = ("docs binary, starts binary, terms binary, list_starts binary, positions binary")
_INDEX_ARROW = pa.schema([(c, pa.binary()) for c in ("docs", "starts", "terms", "list_starts", "positions")])


def _segments(batches) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    hashes: list[np.ndarray] = []
    sizes: list[int] = []
    held = 0
    for b in batches:
        every = b.column(0).to_pylist()
        for buf, offsets, first, end in text_slices(b):
            docs = every[first:end]
            h, at = word_hashes(buf, offsets, ALNUM)
            lo = 0
            while lo < len(docs):
                hi = int(np.searchsorted(at, at[lo] + max(1, SEGMENT_WORDS - held), side="right")) - 1
                hi = min(max(lo + 1, hi), len(docs))
                ids += docs[lo:hi]
                sizes += np.diff(at[lo:hi + 1]).tolist()
                hashes.append(h[at[lo]:at[hi]])
                held += int(at[hi] - at[lo])
                lo = hi
                if held >= SEGMENT_WORDS or len(ids) >= 200_000:
                    yield _segment(ids, sizes, np.concatenate(hashes))
                    ids, sizes, hashes, held = [], [], [], 0
    if ids:
        yield _segment(ids, sizes, np.concatenate(hashes))


def _segment(ids: list[int], sizes: list[int], h: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(h) else np.zeros(0, np.int64)
    present = np.array([i is not None for i in ids])
    docs = np.array([0 if i is None else i for i in ids], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    cols = (np.where(present, docs, np.iinfo(np.int64).min), starts.astype(np.int64), ranked[first],
            np.append(first, len(h)).astype(np.int32), order.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], schema=_INDEX_ARROW)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored positional index of ``docs`` (null text: a document without words),
    each segment with its number."""
    rows = spread(id_text(docs, id_col, text_col))
    index = rows.mapInArrow(released(_segments), _INDEX)
    return stored(index.withColumn("segment", F.monotonically_increasing_id()), "postings")


class Windows:
    """The windows of a block of benchmark items; equal windows are kept once."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.items = [i for i, _ in items]
        rows, of = [], []
        for k, (_, h) in enumerate(items):
            w = min(window, len(h))
            for s in range(len(h) - w + 1 if w else 0):
                rows.append(h[s:s + w])
                of.append(k)
        distinct: dict[bytes, int] = {}
        number = [distinct.setdefault(r.tobytes(), len(distinct)) for r in rows]
        self.words = [np.frombuffer(r, np.uint64) for r in distinct]
        self.items_of: list[list[int]] = [[] for _ in distinct]
        for d, k in zip(number, of, strict=True):
            if k not in self.items_of[d]:
                self.items_of[d].append(k)
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))

    def plan(self, counts: dict[int, int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By window length: (window numbers, words, places), words rarest first.
        A window with a word the corpus lacks cannot occur and is left out."""
        n = np.array([counts.get(int(t), 0) for t in self.terms], np.int64)
        groups: dict[int, list[int]] = {}
        for d, w in enumerate(self.words):
            groups.setdefault(len(w), []).append(d)
        out = []
        for ds in groups.values():
            words = np.stack([self.words[d] for d in ds])
            df = n[np.searchsorted(self.terms, words)]
            keep = (df > 0).all(axis=1)
            order = np.argsort(df[keep], axis=1, kind="stable")
            out.append((np.array(ds)[keep], np.take_along_axis(words[keep], order, axis=1), order))
        return out


class Segment:
    def __init__(self, docs: bytes, starts: bytes, terms: bytes, list_starts: bytes, positions: bytes, number: int):
        self.number = number
        self.docs = np.frombuffer(docs, np.int64)
        self.starts = np.frombuffer(starts, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.list_starts = np.frombuffer(list_starts, np.int32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.int32)

    def find_terms(self, words: np.ndarray) -> np.ndarray:
        """Index of each word's list, -1 without one."""
        at = np.searchsorted(self.terms, words)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == words, at, -1) if len(self.terms) else np.full(words.shape, -1)

    def has(self, lists: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether ``position[i]`` is in list ``lists[i]``: binary search in all lists at once."""
        lo, hi = self.list_starts[lists], self.list_starts[lists + 1]
        end = hi
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) >> 1
            less = (self.positions[np.minimum(mid, len(self.positions) - 1)] < position) & open_
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return (lo < end) & (self.positions[np.minimum(lo, len(self.positions) - 1)] == position)

    def near(self, lists: np.ndarray, position: np.ndarray, reach: int) -> np.ndarray:
        """Whether list ``lists[i]`` has a position within ``reach`` of ``position[i]``."""
        lo, hi = self.list_starts[lists], self.list_starts[lists + 1]
        end, want = hi, position - reach
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) >> 1
            less = (self.positions[np.minimum(mid, len(self.positions) - 1)] < want) & open_
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return (lo < end) & (self.positions[np.minimum(lo, len(self.positions) - 1)] <= position + reach)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, side="right") - 1

    def matches(self, plan: list, slop: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(window numbers, positions, length) of all occurrences inside one document:
        starts of phrases, or with ``slop`` places of the rarest word."""
        for windows, words, places in plan:
            lists = self.find_terms(words)
            there = (lists >= 0).all(axis=1)
            windows, lists, places_here = windows[there], lists[there], places[there]
            width = words.shape[1]
            size = self.list_starts[lists[:, 0] + 1] - self.list_starts[lists[:, 0]] if len(lists) else np.zeros(0, int)
            a = 0
            while a < len(windows):  # as many windows at once as the chunk bound takes, one at least
                b = a + max(1, int(np.searchsorted(np.cumsum(size[a:]), CHUNK, side="right")))
                w = np.repeat(np.arange(a, b), size[a:b])
                inside = np.arange(len(w)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
                p = self.positions[self.list_starts[lists[w, 0]] + inside].astype(np.int64)
                if slop is None:
                    p = p - places_here[w, 0]
                    ok = p >= 0
                    w, p = w[ok], p[ok]
                    doc = self.doc_of(p)
                    ok = p + width <= self.starts[doc + 1]
                    w, p = w[ok], p[ok]
                    for j in range(1, width):
                        ok = self.has(lists[w, j], p + places_here[w, j])
                        w, p = w[ok], p[ok]
                else:
                    for j in range(1, width):
                        ok = self.near(lists[w, j], p, width - 1 + slop)
                        w, p = w[ok], p[ok]
                if len(w):
                    yield windows[w], p, width
                a = b


def _count_terms(terms: np.ndarray) -> Callable:
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own, starts = np.frombuffer(t, np.uint64), np.frombuffer(s, np.int32).astype(np.int64)
                if len(own):
                    at = np.searchsorted(own, terms)
                    at[at == len(own)] = 0
                    hit = own[at] == terms
                    total[hit] += (starts[at + 1] - starts[at])[hit]
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(terms[some].view(np.int64)), pa.array(total[some])], schema=schema)
    return run


_HITS = "segment long, place int, doc_id long, n_words long, item_ids array<string>, positions array<int>"


def _look_up(windows: Windows, plan: list, slop: int | None, all_docs: bool) -> Callable:
    schema = pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("item_ids", pa.list_(pa.string())), ("positions", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield from _segment_hits(Segment(*row))

    def _segment_hits(s: Segment):
        n = len(s.docs)
        hit = np.zeros(int(s.starts[-1]) + 1, np.int32)  # +1 where an occurrence starts, -1 after its end
        items: dict[int, set[int]] = {}
        for w, p, width in s.matches(plan, slop):
            if slop is None:
                np.add.at(hit, p, 1)
                np.add.at(hit, p + width, -1)
            else:
                np.add.at(hit, p, 1)
                np.add.at(hit, p + 1, -1)
            for d, k in np.unique(np.stack([s.doc_of(p), w]), axis=1).T.tolist():
                items.setdefault(d, set()).update(windows.items_of[k])
        covered = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
        cut = np.searchsorted(covered, s.starts)
        out = []
        for d in range(n) if all_docs else sorted(items):
            found = covered[cut[d]:cut[d + 1]] - s.starts[d]
            out.append((s.number, d, None if s.docs[d] == np.iinfo(np.int64).min else int(s.docs[d]),
                        int(s.starts[d + 1] - s.starts[d]),
                        sorted({windows.items[k] for k in items.get(d, ())}), found.tolist()))
            if len(out) >= 4096:
                yield _hits(out)
                out = []
        if out:
            yield _hits(out)

    def _hits(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                           zip(zip(*rows), schema, strict=True)], schema=schema)
    return run


def _test_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int):
    """Blocks of (item id, word hashes): streamed to the driver one partition at
    a time, so the driver holds one block, never the whole benchmark."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    block, held = [], 0
    for item, text in rows.toLocalIterator():
        if item is None:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        h = word_hashes(raw, np.array([0, len(raw)], np.int64), ALNUM)[0]
        block.append((item, h))
        held += len(h)
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_matches(index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int | None = None,
                 item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per indexed document: ``doc_id``, ``n_words``, ``item_ids``
    (items with a matching window, as strings, sorted, each once) and
    ``positions`` (its words, counted from 0, inside any match).

    ``slop=None``: exact phrases.  ``slop=k``: proximity, where the position is
    the rarest word's.  An item of fewer words than ``window``, but not none, is
    one window; items without words, text or id match nothing.  An empty
    benchmark gives empty lists; an empty index an empty result."""
    parts = []
    for block in _test_blocks(benchmark, item_col, text_col, block_words):
        if parts:  # the pass before is done with: its block leaves the driver
            parts[-1] = stored(parts[-1], "hits")
        windows = Windows(block, window)
        counts = {t & (1 << 64) - 1: n for t, n in
                  index.select("terms", "list_starts").mapInArrow(released(_count_terms(windows.terms)), "term long, n long")
                  .groupBy("term").agg(F.sum("n")).collect()}  # at most a block's words
        parts.append(index.mapInArrow(released(_look_up(windows, windows.plan(counts), slop, not parts)), _HITS))
    if not parts:
        parts = [index.mapInArrow(_look_up(Windows([], window), [], slop, True), _HITS)]
    if len(parts) == 1:
        return parts[0].drop("segment", "place")
    joined = parts[0]
    for p in parts[1:]:
        joined = joined.unionByName(p)
    return (joined.groupBy("segment", "place")  # one document row, whatever its id
            .agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("positions"))
            .drop("segment", "place"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Index ``docs`` and look up ``benchmark``: one row per input row with
    ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (of the
    sorted item ids, comma-joined) and ``contaminated``.  Null text has no
    words; ids repeated over rows give a row each."""
    found = find_matches(build_index(docs), benchmark, window)
    return found.select(
        "doc_id", "n_words", F.size("positions").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.size("positions") > 0).alias("contaminated"))
