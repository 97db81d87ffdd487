"""Ranked lexical search over posting lists in geometric blocks.

Documents are dealt into segments of a bounded size.  In a segment every term's
posting list is clustered by the similarity of its documents; a block of the
list stores the coordinatewise maximum of its documents' term impacts.  The
product of a query with that summary bounds the score of every document in the
block, so a block is skipped only where the bound stays below the score that
the query already has ``k`` times.  All arithmetic is in integers: bounds and
scores are exact, and so are the results, ties included.

* Lists that hold a quarter of a segment or more (and those whose summaries
  would be large against their documents) take the segment's own clusters as
  their blocks; the summaries of these are shared.  Other lists are clustered
  one by one and keep only the coordinates that stand beside the term in a query.
* Lists whose greatest possible shares together stay below the threshold need
  not be opened: a document found only there cannot reach it.
* Thresholds start from a first pass over the index that scores, per query, one
  block a segment; they rise while a task works through its segments.

Queries are taken in blocks (``BLOCK_WORDS``, ``BLOCK_TERMS``); what is sent to the tasks and
back to the driver for a block is bounded by the block, for the corpus by two
counts.  Only terms of the block's queries are indexed.  Memory of a task is
bounded by a segment (``CELLS``), not by the table.

Null texts have no terms; documents and queries without terms are never
returned; a repeated query row is answered again, repeated document rows are
documents of their own; a null doc_id ranks behind equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, id_text, released, spread, stored, text_slices
from tessera.llm.textkernel import ALNUM, word_hashes

#: A block of queries ends before it holds more words or distinct terms (one query is never cut).
BLOCK_WORDS, BLOCK_TERMS = 1_000_000, 8192
#: Pairs of terms within queries a block may hold (the coordinates of summaries).
BLOCK_PAIRS = 1 << 23
#: Cells (documents x terms) of a segment, and its documents at most and at least.
CELLS, MOST_DOCS, LEAST_DOCS = 1 << 22, 2048, 64
#: Documents of a geometric block.
BLOCK = 32
#: Dimensions of the sketch that clusters go by.
SKETCH = 16
#: A list's own summaries may hold so many cells per posting entry of its documents.
SUMMARY = 8

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_FORWARD = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("tfs", pa.binary())])
_PARTS = ("docs", "known", "ptr", "ids", "impacts", "order", "cluster_ptr", "cluster_max",
          "lists", "list_ptr", "block_ptr", "block_docs", "block_max")
_SEGMENT = pa.schema([(c, pa.binary()) for c in _PARTS])


class Queries:
    """A block of queries: number, and (term, times) of each."""

    def __init__(self, rows: list[tuple[int, list[tuple[bytes, int]]]]):
        self.numbers = [q for q, _ in rows]
        self.vocabulary = sorted({t for _, terms in rows for t, _ in terms})
        place = {t: i for i, t in enumerate(self.vocabulary)}
        self.terms = [np.array([place[t] for t, _ in terms], np.int64) for _, terms in rows]
        self.times = [np.array([c for _, c in terms], np.int64) for _, terms in rows]
        self.size = len(self.vocabulary)
        raw = np.frombuffer(b"".join(self.vocabulary), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.vocabulary])
        self.raw = raw
        self.lengths = np.diff(self.ends, prepend=0)
        h, _ = word_hashes(raw, np.concatenate([[0], self.ends]).astype(np.int64), ALNUM)
        self.by_hash = np.argsort(h, kind="stable")
        self.hashes = h[self.by_hash]
        if len(np.unique(h)) < len(h):
            raise ValueError("two query terms share a hash")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "beside"}

    def companions(self) -> list[np.ndarray]:
        """By term: the terms of all queries that hold it, ascending."""
        holders: list[list[int]] = [[] for _ in range(self.size)]
        for q, terms in enumerate(self.terms):
            for t in terms.tolist():
                holders[t].append(q)
        one = [np.unique(t) for t in self.terms]  # queries' own arrays are shared, not copied
        return [one[qs[0]] if len(qs) == 1 else np.unique(np.concatenate([self.terms[q] for q in qs])) for qs in holders]

    def known(self, buf: np.ndarray, h: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Term number of every word, -1 for words that no query holds: found
        by hash, then compared byte by byte."""
        out = np.full(len(h), -1, np.int64)
        if not self.size or not len(h):
            return out
        place = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
        term = self.by_hash[place]
        hit = np.flatnonzero((self.hashes[place] == h) & (self.lengths[term] == lengths))
        if not len(hit):
            return out
        size, t = lengths[hit], term[hit]
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        same = _FOLD[buf[np.repeat(starts[hit], size) + step]] == self.raw[np.repeat(self.ends[t] - size, size) + step]
        ok = np.logical_and.reduceat(same, first)
        out[hit[ok]] = t[ok]
        return out


def query_terms(text: str | None) -> list[tuple[bytes, int]]:
    return list(Counter(_TERM.findall((text or "").encode().lower())).items())


def query_blocks(queries: DataFrame) -> Iterator[Queries]:
    """Blocks of (number, text) rows, streamed to the driver one block at a time."""
    rows: list = []
    held, words, pairs = set(), 0, 0
    for number, text in queries.toLocalIterator():
        terms = query_terms(text)
        if not terms:
            continue
        more = sum(c for _, c in terms)
        new = held | {t for t, _ in terms}
        if rows and (words + more > BLOCK_WORDS or len(new) > BLOCK_TERMS or pairs + len(terms) ** 2 > BLOCK_PAIRS):
            yield Queries(rows)
            rows, words, pairs, new = [], 0, 0, {t for t, _ in terms}
        rows.append((number, terms))
        held, words, pairs = new, words + more, pairs + len(terms) ** 2
    if rows:
        yield Queries(rows)


# ---------------------------------------------------------------- documents to term vectors
def term_vectors(docs: DataFrame, block: Queries) -> DataFrame:
    """(doc_id, n, ids, tfs): all words counted, the block's terms kept."""
    @released
    def run(batches):
        def rows():
            for b in batches:
                every = b.column(0).to_pylist()
                for buf, offsets, first, end in text_slices(b):
                    h, at, starts, lengths = word_hashes(buf, offsets, ALNUM, spans=True)
                    term = block.known(buf, h, starts, lengths)
                    for i in range(end - first):
                        t = term[at[i]:at[i + 1]]
                        ids, tfs = np.unique(t[t >= 0], return_counts=True)
                        yield (every[first + i], int(at[i + 1] - at[i]),
                               ids.astype(np.int32).tobytes(), tfs.astype(np.int64).tobytes())
        return batches_of(rows(), _FORWARD)

    return docs.mapInArrow(run, "doc_id long, n long, ids binary, tfs binary")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents per term of the block (``size`` numbers come to the driver)."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            held = b"".join(b.column(0).to_pylist())
            total += np.bincount(np.frombuffer(held, np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in vectors.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


# ---------------------------------------------------------------- segments
def _clusters(at: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents in cluster order, where clusters begin): nearest of evenly
    picked representatives, large clusters in pieces."""
    if len(at) <= BLOCK:
        return at, np.array([0, len(at)], np.int64)
    picks = at[::BLOCK]
    near = np.argmax(sketch[at] @ sketch[picks].T, axis=1)
    order = np.argsort(near, kind="stable")
    near = near[order]
    begin = np.flatnonzero(np.append(True, near[1:] != near[:-1]))
    cuts = [c for a, b in zip(begin, np.append(begin[1:], len(at)), strict=True) for c in range(a, b, BLOCK)]
    return at[order], np.append(cuts, len(at)).astype(np.int64)


def _segment(rows: list[tuple], block: Queries, beside: list[np.ndarray], w: np.ndarray, project: np.ndarray,
             n_docs: int, n_words: int) -> pa.RecordBatch:
    n = len(rows)
    ids = np.frombuffer(b"".join(r[2] for r in rows), np.int32)
    tfs = np.frombuffer(b"".join(r[3] for r in rows), np.int64)
    sizes = np.array([len(r[2]) // 4 for r in rows])
    m = np.array([25 + 75 * r[1] * n_docs // n_words for r in rows], np.int64)  # Python integers: no overflow
    of = np.repeat(np.arange(n), sizes)
    value = impacts(tfs, m[of])
    cells = np.zeros((n, block.size), np.int32)
    cells[of, ids] = value
    sketch = np.zeros((n, SKETCH), np.float32)
    for a in range(0, n, 256):
        sketch[a:a + 256] = (cells[a:a + 256] * w.astype(np.float32)) @ project
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
    order, cluster_ptr = _clusters(np.arange(n), sketch)
    cluster_max = np.maximum.reduceat(cells[order], cluster_ptr[:-1], axis=0)

    by_term = np.argsort(ids, kind="stable")
    present, begin = np.unique(ids[by_term], return_index=True)
    lists, list_ptr, block_ptr, block_docs, block_max = [], [0], [0], [], []
    for t, a, b in zip(present.tolist(), begin, np.append(begin[1:], len(ids)), strict=True):
        at = of[by_term[a:b]]
        cols = beside[t]
        if 4 * len(at) > n or len(cols) * (len(at) // BLOCK + 1) > SUMMARY * sizes[at].sum():
            continue  # the segment's clusters are its blocks
        held, ptr = _clusters(at, sketch)
        lists.append(t)
        list_ptr.append(list_ptr[-1] + len(ptr) - 1)
        block_ptr += (block_ptr[-1] + ptr[1:]).tolist()
        block_docs.append(held)
        block_max.append(np.maximum.reduceat(cells[np.ix_(held, cols)], ptr[:-1], axis=0).ravel())
    none = np.zeros(0, np.int64)
    parts = (np.array([0 if r[0] is None else r[0] for r in rows], np.int64),
             np.array([r[0] is not None for r in rows], np.uint8),
             np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), ids, value.astype(np.int32),
             order.astype(np.int32), cluster_ptr.astype(np.int32), cluster_max,
             np.array(lists, np.int32), np.array(list_ptr, np.int64), np.array(block_ptr, np.int64),
             np.concatenate([none, *block_docs]).astype(np.int32), np.concatenate([none, *block_max]).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], schema=_SEGMENT)


def build_index(vectors: DataFrame, block: Queries, w: np.ndarray, n_docs: int, n_words: int) -> DataFrame:
    """The stored index: one row a segment."""
    most = max(LEAST_DOCS, min(MOST_DOCS, CELLS // max(block.size, 1)))

    @released
    def run(batches):
        beside = block.companions()
        project = np.random.default_rng(11).standard_normal((block.size, SKETCH)).astype(np.float32)
        held: list[tuple] = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[2]:
                    held.append(r)
                if len(held) == most:
                    yield _segment(held, block, beside, w, project, n_docs, n_words)
                    held = []
        if held:
            yield _segment(held, block, beside, w, project, n_docs, n_words)

    return stored(vectors.mapInArrow(run, ", ".join(f"{c} binary" for c in _PARTS)), "blocks",
                  **{"parquet.block.size": str(16 << 20)})


class Segment:
    def __init__(self, row: dict[str, bytes], size: int):
        kinds = {"docs": np.int64, "known": np.uint8, "ptr": np.int64, "list_ptr": np.int64, "block_ptr": np.int64}
        p = {k: np.frombuffer(v, kinds.get(k, np.int32)) for k, v in row.items()}
        self.docs, self.known = p["docs"], p["known"]
        self.cells = np.zeros((len(self.docs), size), np.int32)
        self.cells[np.repeat(np.arange(len(self.docs)), np.diff(p["ptr"])), p["ids"]] = p["impacts"]
        self.order, self.cluster_ptr = p["order"], p["cluster_ptr"]
        self.cluster_max = p["cluster_max"].reshape(-1, size)
        self.most = self.cluster_max.max(axis=0).astype(np.int64)
        self.own = {t: i for i, t in enumerate(p["lists"].tolist())}
        self.list_ptr, self.block_ptr, self.block_docs = p["list_ptr"], p["block_ptr"], p["block_docs"]
        self.block_max, self.sums = p["block_max"], None

    def summary(self, t: int, cols: int, starts: np.ndarray) -> np.ndarray:
        i = self.own[t]
        return self.block_max[starts[i]:starts[i + 1]].reshape(-1, cols)

    def score(self, at: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return self.cells[np.ix_(at, terms)].astype(np.int64) @ weight

    def cluster(self, c: int) -> np.ndarray:
        return self.order[self.cluster_ptr[c]:self.cluster_ptr[c + 1]]


class Best:
    """The ``k`` best documents of a query so far, and the score a further one must reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(1, floor)
        self.score = self.doc = self.known = np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        keep = score >= self.floor
        if not keep.any():
            return
        s, d, n = (np.concatenate([a, b[keep]]) for a, b in ((self.score, score), (self.doc, doc), (self.known, known)))
        top = np.lexsort((d, -n.astype(np.int64), -s))[:self.k]
        self.score, self.doc, self.known = s[top], d[top], n[top]
        if len(top) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


def _probe(seg: Segment, terms: np.ndarray, weight: np.ndarray, best: Best) -> None:
    """Scores the documents of the most promising cluster."""
    bounds = seg.cluster_max[:, terms].astype(np.int64) @ weight
    c = int(np.argmax(bounds))
    if bounds[c] >= best.floor:
        at = seg.cluster(c)
        best.add(seg.score(at, terms, weight), seg.docs[at], seg.known[at])


def _search(seg: Segment, terms: np.ndarray, weight: np.ndarray, best: Best, beside: list[np.ndarray],
            starts: np.ndarray) -> None:
    share = weight * seg.most[terms]
    by = np.argsort(-share, kind="stable")
    rest = np.append(np.cumsum(share[by][::-1])[::-1], 0)  # what the lists from here on can give together
    open_ = by[rest[:-1] >= best.floor]
    if not len(open_):
        return
    found = np.zeros(len(seg.docs), bool)
    shared = []
    for i in open_.tolist():
        t = int(terms[i])
        if t not in seg.own:
            if share[i]:
                shared.append(t)
            continue
        cols = beside[t]
        bounds = seg.summary(t, len(cols), starts)[:, np.searchsorted(cols, terms)].astype(np.int64) @ weight
        first = seg.list_ptr[seg.own[t]]
        for b in np.flatnonzero(bounds >= best.floor).tolist():
            found[seg.block_docs[seg.block_ptr[first + b]:seg.block_ptr[first + b + 1]]] = True
    if shared:
        bounds = seg.cluster_max[:, terms].astype(np.int64) @ weight
        for c in np.flatnonzero(bounds >= best.floor).tolist():
            at = seg.cluster(c)
            found[at[seg.cells[np.ix_(at, shared)].any(axis=1)]] = True
    at = np.flatnonzero(found)
    if len(at):
        best.add(seg.score(at, terms, weight), seg.docs[at], seg.known[at])


_HITS = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _run(index: DataFrame, block: Queries, w: np.ndarray, k: int, floors: dict[int, int], probe: bool) -> DataFrame:
    weight = [c * w[t] for c, t in zip(block.times, block.terms, strict=True)]

    @released
    def run(batches):
        beside = block.companions()
        widths = np.array([len(c) for c in beside], np.int64)
        best = [Best(k, floors.get(q, 0)) for q in block.numbers]
        for b in batches:
            for i in range(b.num_rows):
                seg = Segment({c: b.column(j)[i].as_py() for j, c in enumerate(_PARTS)}, block.size)
                lists = np.fromiter(seg.own, np.int64, len(seg.own))
                starts = np.concatenate([[0], np.cumsum(np.diff(seg.list_ptr) * widths[lists])])
                for q, terms in enumerate(block.terms):
                    if probe:
                        _probe(seg, terms, weight[q], best[q])
                    else:
                        _search(seg, terms, weight[q], best[q], beside, starts)
        yield from batches_of(((number, int(d) if known else None, int(s)) for number, x in zip(block.numbers, best, strict=True)
                               for s, d, known in zip(x.score, x.doc, x.known, strict=True)), _HITS)

    return index.mapInArrow(run, "query long, doc_id long, score long")


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "item_id", query_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the ``k`` best documents of every query row."""
    rows = queries.select(F.col(query_id).alias("item"), F.col(query_text).cast("string").alias("body"))
    rows = stored(rows.withColumn("query", F.monotonically_increasing_id()), "queries")
    texts = spread(id_text(docs, id_col, text_col))
    found = None
    for block in query_blocks(rows.select("query", "body")):
        vectors = stored(term_vectors(texts, block), "vectors")
        n_docs, n_words = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        w = weights(n_docs, document_frequencies(vectors, block.size))
        index = build_index(vectors, block, w, n_docs, n_words)
        kth = _top(_run(index, block, w, k, {}, probe=True), k).where(F.col("rank") == k)
        floors = {q: s for q, s in kth.select("query", "score").collect()}  # at most one a query of the block
        hits = _top(_run(index, block, w, k, floors, probe=False), k)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query long, doc_id long, score long, rank int")
    return (found.join(rows.select("query", "item"), "query")
            .select(F.col("item").alias(query_id), "rank", "doc_id", "score"))
