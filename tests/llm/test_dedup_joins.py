"""Exact dedup, n-gram Jaccard join and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing, docs_of  # noqa: F401  (fixtures)
from tessera.llm import exact_dedup as ED
from tessera.llm import jaccard_join as JJ
from tessera.llm import line_dedup as LD
from tessera.llm.common import attach_by_key, connected_components

FOLD = {i: i + 32 for i in range(65, 91)}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- exact dedup
def test_trie_equals_a_dict_and_spills_subtrees():
    r = random.Random(1)
    keys = [bytes(r.choice(b"ab") for _ in range(r.randrange(0, 9))) for _ in range(3000)] + [b"x" * 500, b"x" * 499]
    for larger in (False, True):
        trie, want = ED.PatriciaTrie(larger), {}
        for i, k in enumerate(keys):
            trie.insert(k, i)
            old = want.get(k, (i, 0))
            want[k] = ((max if larger else min)(old[0], i), old[1] + 1)
        got = list(trie.drain())
        assert [g[0] for g in got] == sorted(want)
        assert {k: (i, n) for k, i, n in got} == want
    trie = ED.PatriciaTrie()
    for i, k in enumerate(sorted(set(keys))):
        trie.insert(k, i)
    passed = list(trie.spill(b"b"))
    rest = list(trie.drain())
    assert all(k < b"b" for k, _, _ in passed) and {k for k, _, _ in passed + rest} == set(keys)
    assert any(k.startswith(b"a") for k, _, _ in passed)


def brute_exact(rows, larger):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        keep = (max(known) if larger else min(known)) if known else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [ED.TRIE_BYTES, 2000])
def test_exact_dedup(docs_of, clashing, monkeypatch, bound):
    monkeypatch.setattr(ED, "TRIE_BYTES", bound)
    rows = [(i, f"text {i % 7}" * (i % 3 + 1)) for i in range(200)] + [
        (300, None), (301, ""), (302, "é" * 5000), (303, "é" * 5000), (304, "é"), (305, "é"),
        (None, "text 0"), (None, "only null ids"), (306, "same"), (306, "same"), (-5, "same")]
    for larger in (False, True):
        out = ED.exact_dedup(clashing(docs_of(rows)), larger=larger)
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()), key=repr)
        assert got == brute_exact(rows, larger)


def test_exact_dedup_empty_and_hot(docs_of):
    assert ED.exact_dedup(docs_of([])).count() == 0
    hot = ED.exact_dedup(docs_of([(i, "hot" if i % 3 else str(i)) for i in range(900)]), larger=True)
    assert hot.where("kept").count() == 301
    assert hot.where("group_size = 600").select("keep_id").distinct().count() == 1


def test_attach_by_key_spreads_a_hot_key(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    lookup = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("value", F.col("k") * 2)
    out = attach_by_key(rows, lookup, ["k"], "n", F.col("id"))
    assert out.where("value = 2 * k").count() == 3000


# ---------------------------------------------------------------- components
def test_components(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    links += [(500, i) for i in range(501, 560)] + [(7, 3), (3, 7)]
    df = spark.createDataFrame(links, "u LONG, v LONG")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == components({x for e in links for x in e}, links)
    assert connected_components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- n-gram Jaccard join
def shingle_sets(rows, k):
    out = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        out[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def brute_jaccard(rows, k, percent):
    sets = shingle_sets(rows, k)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and
             100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(sets, links)
    degree = dict.fromkeys(sets, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return {i: (len(sets[i]), comp[i], degree[i]) for i in sets}


def near_rows(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(r.choice(words) for _ in range(12))  # a passage that many documents share
    rows, i = [], 0
    for size in (5, 12, 20, 35, 60, 120, 300):
        for _ in range(6):
            base = [r.choice(words) for _ in range(size)]
            for _ in range(r.choice((1, 2, 5))):
                w = list(base)
                for _ in range(r.choice((0, 1, 1, 2, size // 20))):
                    w[r.randrange(len(w))] = r.choice(words)
                text = " ".join(w) if r.random() < .5 else " ".join(w) + " " + line
                rows.append((i, text if r.random() < .5 else text.upper().replace(" ", "\t\n")))
                i += 1
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "ONE  two"), (9005, "one"),
                   (9006, rows[0][1]), (9007, "İ ß one two three"), (9008, "long " * 30000)]


@pytest.mark.parametrize("k, percent, bound, cast", [(3, 90, 3_000_000, 10**6), (5, 80, 3_000_000, 0), (5, 80, 800, 10**6)])
def test_jaccard_join(docs_of, clashing, monkeypatch, k, percent, bound, cast):
    monkeypatch.setattr(JJ, "GROUP_SHINGLES", bound)
    monkeypatch.setattr(JJ, "BROADCAST_ROWS", cast)
    rows = near_rows()
    out = JJ.jaccard_join(clashing(docs_of(rows)), k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in out.collect()}
    assert got == brute_jaccard(rows, k, percent)


def test_jaccard_join_ties_tasks_through_heads_that_link_with_nothing(spark, monkeypatch):
    """Two linked sets in two tasks; in each task the smallest id of every list
    they share is a set that shares this one list and no more."""
    monkeypatch.setattr(JJ, "spread", lambda df: df)
    r = random.Random(8)

    def block(word, m=9):  # of sets of 17 to 25 shingles
        s, = JJ.doc_sets(pa.RecordBatch.from_pydict({"text": [word]}), 1)
        return (int(s[0]) >> 32) * m >> 32
    pool = {f"w{i}": block(f"w{i}") for i in range(2000)}
    pair = r.sample(sorted(pool), 20)
    other = [*pair[1:], "other"]

    def hubs(first):  # one a block of the pair: the block's words and words of other blocks
        for b in sorted({pool[w] for w in pair}):
            own = [w for w in pair if pool[w] == b]
            yield first + b, " ".join(own + r.sample([w for w in pool if pool[w] != b and w not in pair], 20 - len(own)))
    one, two = [*hubs(1), (500, " ".join(pair))], [*hubs(100), (501, " ".join(other))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(one + two, 2), "doc_id LONG, text STRING")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in JJ.jaccard_join(docs, 1, 80).collect()}
    assert got == brute_jaccard(one + two, 1, 80) and got[501] == (20, 500, 1)


@pytest.mark.parametrize("keys", [1, 300])
def test_jaccard_join_small_bundles(docs_of, monkeypatch, keys):
    monkeypatch.setattr(JJ, "TASK_KEYS", keys)
    rows = near_rows(11)
    out = JJ.jaccard_join(docs_of(rows).repartition(9), 3, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in out.collect()}
    assert got == brute_jaccard(rows, 3, 80)


def test_jaccard_join_empty_null_ids_and_repeats(docs_of):
    assert JJ.jaccard_join(docs_of([])).count() == 0
    got = sorted(JJ.jaccard_join(docs_of([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")])).collect(), key=str)
    assert [(r.component_id, r.n_shingles, r.n_links) for r in got] == [(4, 2, 2)] * 3


def test_signatures_meet_for_every_linked_pair():
    """Of two linked sets at least one list is shared, whatever the sizes."""
    r = np.random.default_rng(5)
    for _ in range(3000):
        n = int(r.integers(1, 90))
        percent = int(r.choice((80, 90)))
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = int(r.integers(0, n + 1))
        b = np.concatenate([a[cut:], r.integers(0, 1 << 63, int(r.integers(0, 12)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        same = len(np.intersect1d(a, b))
        if same and 100 * same >= percent * (len(a) + len(b) - same):
            ka = {c: (set(k.tolist()), need) for c, k, need in JJ.signatures(a, percent)}
            kb = {c: (set(k.tolist()), need) for c, k, need in JJ.signatures(b, percent)}
            assert any(len(ka[c][0] & kb[c][0]) >= max(ka[c][1], kb[c][1]) for c in ka.keys() & kb.keys())


def test_local_join_derives_overlaps_from_similar_sets():
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = []
    for _ in range(60):
        s = base.copy()
        s[r.integers(0, 200, 6)] = r.integers(0, 1 << 63, 6, dtype=np.uint64)
        sets.append(np.unique(s))
    sets += [np.unique(r.integers(0, 1 << 63, 150, dtype=np.uint64)) for _ in range(20)]
    sets.sort(key=len)
    join = JJ.LocalJoin(sets, 90)
    got = {(x, y) for x, found in join.links() for y in found.tolist()}
    want = {(x, y) for x in range(80) for y in range(80) if x != y and 100 * len(np.intersect1d(sets[x], sets[y]))
            >= 90 * len(np.union1d(sets[x], sets[y]))}
    assert got == want and join.derived > join.counted and join.skipped >= 20


# ---------------------------------------------------------------- line dedup
def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def brute_lines(rows):
    allowed = lambda n: next((e for least, e in LD.THRESHOLDS if n >= least), 0)
    first, every = {}, []
    for i, t in sorted(rows):
        for j, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                every.append((i, j, line))
                first.setdefault(line, (i, j))
    lines = sorted(first, key=first.get)
    links = []
    for x, a in enumerate(lines):
        for y in range(x):
            e = allowed(min(len(a), len(lines[y])))
            if e and abs(len(a) - len(lines[y])) <= e and edit_distance(a, lines[y]) <= e:
                links.append((x, y))
    comp = components(range(len(lines)), links)
    number = {line: x for x, line in enumerate(lines)}
    out = {i: [(t or "").count("\n") + 1 if t else 0, 0, 0, []] for i, t in rows}
    for i, j, line in every:
        if (i, j) != first[lines[comp[number[line]]]]:
            out[i][3].append(j)
            out[i][2 if first[line] == (i, j) else 1] += 1
    return out


def line_rows():
    r = random.Random(9)
    lines = []
    for n in (10, 19, 20, 21, 39, 40, 41, 70):
        for _ in range(5):
            base = "".join(r.choice("abcdefghé ") for _ in range(n))
            lines.append(base)
            for _ in range(5):
                a = list(base)
                for _ in range(r.randrange(0, 4)):
                    p = r.randrange(len(a))
                    a[p:p + r.randrange(2)] = r.choice(("", "x", "yz"[:r.randrange(1, 3)]))
                lines.append("".join(a))
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[7 * i:7 * i + 7] + (["", "   "] if i % 3 == 0 else []))) for i in range(len(lines) // 7)]
    return rows + [(1000, None), (1001, ""), (1002, "\n".join(lines[:3])), (1003, "the very long line " * 3000)]


def test_line_dedup(docs_of, clashing):
    rows = line_rows()
    docs = docs_of(rows)
    out = LD.line_dedup(clashing(docs))
    got = {r.doc_id: [r.n_lines, r.n_copies, r.n_near, r.dropped] for r in out.collect()}
    want = brute_lines(rows)
    assert got == want and sum(w[2] for w in want.values()) > 20
    kept = {r.doc_id: r.text for r in LD.without_dropped(docs, out).collect()}
    for i, t in rows:
        assert kept[i] == (t if not t else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in want[i][3]))


def test_line_dedup_keeps_lines_of_any_white_space(docs_of):
    text = "one\r\n\r\n\t\n \t \n\x0b\n\x0c\n\r\ntwo"
    got = {r.doc_id: (r.n_lines, r.n_copies, r.n_near, r.dropped) for r in LD.line_dedup(docs_of([(1, text), (2, text)])).collect()}
    assert got == {1: (8, 0, 0, []), 2: (8, 2, 0, [0, 7])}


@pytest.mark.parametrize("n", [50, 100])
def test_line_dedup_compares_a_group_with_its_heads(docs_of, monkeypatch, n):
    """Lines that all differ in one place: rows compared grow with the group, not with its square."""
    base, seen = "a line of text that is long enough to be cut into three", []
    whole = LD._verified
    monkeypatch.setattr(LD, "_verified", lambda pairs, texts: (seen.append(pairs.count()), whole(pairs, texts))[1])
    docs = docs_of([(i, base[:20] + chr(0x4E00 + i) + base[21:]) for i in range(n)])
    out = {r.doc_id: r.n_near for r in LD.line_dedup(docs).collect()}
    assert out == {i: int(i > 0) for i in range(n)}
    assert sum(seen) <= 3 * n


def test_line_dedup_members_that_their_head_does_not_link(docs_of):
    """Lists of lines that share a segment but are linked in other ways than through their head."""
    r = random.Random(3)
    rows = []
    for i in range(40):
        tail = [r.choice("uvw") for _ in range(28)]
        for j in range(3):
            tail[r.randrange(28)] = r.choice("xyz")
            rows.append((3 * i + j, "a common third " + "".join(tail)))
    got = {x.doc_id: [x.n_lines, x.n_copies, x.n_near, x.dropped] for x in LD.line_dedup(docs_of(rows)).collect()}
    want = brute_lines(rows)
    assert got == want and 20 < sum(w[2] for w in want.values()) < 110


def test_line_dedup_empty(docs_of):
    assert LD.line_dedup(docs_of([])).count() == 0


def test_banded_bit_parallel_distance(spark):
    r = random.Random(5)
    rows = []
    for _ in range(400):
        b = [r.choice("abé ") for _ in range(r.randrange(1, 30))]
        a = list(b)
        for _ in range(r.randrange(0, 4)):
            p = r.randrange(len(a) + 1)
            a[p:p + r.randrange(2)] = r.choice(("", "a", "b"))
        a, b = sorted(("".join(a) or "a", "".join(b)), key=len, reverse=True)
        rows.append((a, b, edit_distance(a, b)))
    df = spark.createDataFrame(rows, "a STRING, b STRING, d INT")
    for e in (1, 2, 3):
        near = df.where(F.length("a") - F.length("b") <= e).select(
            LD.within_edits(F.split("a", ""), F.split("b", ""), e).alias("got"), (F.col("d") <= e).alias("want"))
        assert near.where("got != want").count() == 0 and near.where("want").count() > 50


def test_line_keys_cut_by_bytes_or_by_characters(spark):
    """An accent makes a line longer in bytes: it is cut by characters, the others by bytes, and
    what both hold is the same key."""
    plain = "the quick brown fox jumps over the lazy dog again"
    lines = spark.createDataFrame([(1, plain), (2, plain[:-1] + "é")], "h1 long, line string").withColumn(
        "length", F.char_length("line"))
    own = LD.line_keys(lines, True)
    assert "as binary" in own._jdf.queryExecution().optimizedPlan().toString()
    keys = {h: {r.key for r in own.where(F.col("h1") == h).collect()} for h in (1, 2)}
    assert len(keys[1]) == len(keys[2]) == 3 and len(keys[1] & keys[2]) == 2
    segments = [(49, 2, 1, plain[:16]), (49, 2, 2, plain[16:32]), (49, 2, 3, plain[32:])]
    expected = spark.createDataFrame(segments, "o int, e int, i int, s string").select(F.xxhash64("o", "e", "i", "s").alias("k"))
    assert keys[1] == {r.k for r in expected.collect()}
