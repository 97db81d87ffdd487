"""Ranked search against brute force: Spark path, small blocks, skipping, hashes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import clashing, docs_of  # noqa: F401  (fixtures)
from tessera.llm import lexical_search as LX
from tessera.llm import textkernel as TK

PATTERN = "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLD = {i: i + 32 for i in range(65, 91)}


def terms_of(text):
    return [w.translate(FOLD) for w in re.findall(PATTERN, text or "")]


def brute(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 25 + (75 * n * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms_of(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n_docs=120, n_items=9):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ß7", "THE", "the", "of", "日本"]
    weights = [1 / (1 + i) for i in range(len(words))]

    def text(n):
        return r.choice(" -_\n").join(r.choices(words, weights, k=n))

    docs = [(i, text(r.randrange(0, 60))) for i in range(n_docs)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # equal scores
    docs += [(2000, None), (2001, ""), (2002, "--"), (None, text(20)), (None, text(5)), (5, docs[5][1]), (2003, "the " * 30_000)]
    items = [(f"q{i}", text(r.randrange(1, 14))) for i in range(n_items)]
    items += [("null", None), ("none", "..."), ("unknown", "zzz"), ("q0", items[0][1]), ("copy", docs[3][1])]
    return docs, items


@pytest.mark.parametrize("words", [10**6, 12])
def test_search_equals_brute_force(spark, docs_of, clashing, monkeypatch, words):  # noqa: F811
    monkeypatch.setattr(LX, "BLOCK_WORDS", words)
    monkeypatch.setattr(LX, "CELLS", 1)  # segments of LEAST_DOCS documents
    docs, items = corpus(3)
    bench = clashing(spark.createDataFrame(items, "item_id STRING, text STRING"))
    found = LX.search(clashing(docs_of(docs)).repartition(3), bench, k=7)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items, 7)


def test_empty_tables(spark, docs_of):  # noqa: F811
    bench = spark.createDataFrame([("a", "w1")], "item_id STRING, text STRING")
    assert LX.search(docs_of([]), bench).count() == 0
    assert LX.search(docs_of([(1, "w1")]), bench.limit(0)).count() == 0
    assert LX.search(docs_of([(1, None)]), bench).count() == 0
    assert [tuple(r) for r in LX.search(docs_of([(1, "w1 x")]), bench).collect()] == brute([(1, "w1 x")], [("a", "w1")], 10)


@pytest.mark.parametrize("block, summary", [(2, 100), (3, 0), (4, 8)])
def test_blocks_are_skipped_and_bounds_hold(monkeypatch, block, summary):
    """In one process: own and shared summaries, every block's bound, skipped blocks."""
    monkeypatch.setattr(LX, "BLOCK", block)
    monkeypatch.setattr(LX, "SUMMARY", summary)
    docs, items = corpus(8)
    docs = [d for d in docs if terms_of(d[1])]
    queries = LX.Queries([(q, LX.query_terms(t)) for q, (_, t) in enumerate(items) if terms_of(t)])
    place = {t.decode(): i for i, t in enumerate(queries.vocabulary)}
    rows, df = [], np.zeros(queries.size, np.int64)
    for i, text in docs:
        c = Counter(place[t] for t in terms_of(text) if t in place)
        at = sorted(c)
        df[at] += 1
        if at:
            rows.append((i, len(terms_of(text)), np.array(at, np.int32).tobytes(), np.array([c[t] for t in at], np.int64).tobytes()))
    n_words = sum(len(terms_of(t)) for _, t in docs)
    w = LX.weights(len(docs), df)
    beside = queries.companions()
    project = np.random.default_rng(1).standard_normal((queries.size, LX.SKETCH)).astype(np.float32)
    batch = LX._segment(rows, queries, beside, w, project, len(docs), n_words)
    seg = LX.Segment({c: batch.column(j)[0].as_py() for j, c in enumerate(LX._PARTS)}, queries.size)
    assert bool(seg.own) == (summary > 0) and sorted(seg.order.tolist()) == list(range(len(rows)))
    widths = np.array([len(c) for c in beside])
    starts = np.concatenate([[0], np.cumsum(np.diff(seg.list_ptr) * widths[np.fromiter(seg.own, np.int64, len(seg.own))])])
    for t, i in seg.own.items():  # a block's summary is the maximum of its documents
        top = seg.summary(t, widths[t], starts)
        for b, k in enumerate(range(seg.list_ptr[i], seg.list_ptr[i + 1])):
            at = seg.block_docs[seg.block_ptr[k]:seg.block_ptr[k + 1]]
            assert (top[b] == seg.cells[np.ix_(at, beside[t])].max(axis=0)).all() and len(at) <= block
    scored, whole = [], LX.Segment.score
    monkeypatch.setattr(LX.Segment, "score", lambda self, at, *a: (scored.append(len(at)), whole(self, at, *a))[1])
    for q, (number, terms) in enumerate(zip(queries.numbers, queries.terms, strict=True)):
        weight = queries.times[q] * w[terms]
        every = sorted((-int(s), r[0] is None, r[0] or 0) for s, r in zip(whole(seg, np.arange(len(rows)), terms, weight), rows, strict=True) if s > 0)
        floor = -every[min(len(every), 4) - 1][0] if every else 1
        best = LX.Best(4, floor)
        LX._search(seg, terms, weight, best, beside, starts)
        got = [(-int(s), not k, int(d) if k else 0) for s, d, k in zip(best.score, best.doc, best.known, strict=True)]
        assert got == every[:4], items[number]
    assert sum(scored) < len(rows) * len(queries.numbers) / 2  # most documents are never scored


def test_words_that_cancel_in_a_polynomial_hash_stay_apart():
    for size in (1024, 4096):
        a = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
        b = a.translate(str.maketrans("ab", "ba"))
        h = TK.hash_words([a, b, a + "a", a[:8], a[:16], a[8:16] + a[:8]], TK.ALNUM)
        assert len(set(h.tolist())) == len(set([a, b, a + "a", a[:8], a[:16], a[8:16] + a[:8]]))


def test_prefix_hash_is_of_the_first_bytes():
    raw = "abcdefghij abcdxx abc".encode()
    buf, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    _, _, (four,) = TK.word_hashes(buf, off, TK.ALNUM, (4,))
    assert four[0] == four[1] != 0 and four[2] == 0
    _, _, at, size = TK.word_hashes(buf, off, TK.ALNUM, spans=True)
    assert [(int(a), int(s)) for a, s in zip(at, size, strict=True)] == [(0, 10), (11, 6), (18, 3)]
