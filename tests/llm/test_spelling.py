"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from llm_fixtures import clashing, docs_of  # noqa: F401  (fixtures)
from tessera.llm import spelling as SV


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if distance_one(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top and n[top] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), n


def edited(r, w, alphabet):
    p, kind = r.randrange(len(w) + 1), r.randrange(3)
    c = r.choice(alphabet)
    return w[:p] + c + w[p:] if kind == 0 else w[:p] + w[p + 1:] if kind == 1 else w[:p] + c + w[p + 1:]


def corpus(seed, alphabet, roots=25, size=1500):
    r = random.Random(seed)
    words = ["".join(r.choice(alphabet) for _ in range(r.randrange(5, 10))) for _ in range(roots)]
    for _ in range(roots * 6):
        words.append(edited(r, r.choice(words), alphabet) or "aaaaa")
    weight = [1 / (1 + i) for i in range(len(words))]
    return [(i, " ".join(r.choices(words, weight, k=60))) for i in range(size // 60)] + [(900 + i, " ".join(words)) for i in range(3)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdeÀéÿ×", "xyzXYZ"])
def test_variants_equal_brute_force(spark, docs_of, clashing, alphabet):  # noqa: F811
    rows = corpus(4, alphabet)
    rows += [(None, rows[0][1]), (None, rows[0][1]), (7, None), (8, ""), (9, "1 22 _"), rows[1], (10, "q" * 50_000 + " aaaaa-aaaaa'aaaab")]
    want, counts = brute(rows)
    assert sum(1 for x in want if x[1]) > 5
    got = SV.variants(clashing(docs_of(rows)).repartition(5))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda x: x[0]) == want
    assert {r.word: r.n for r in SV.word_counts(docs_of(rows)).collect() if r.n >= 3 and len(r.word) >= 5} == counts


def test_empty(spark, docs_of):  # noqa: F811
    assert SV.variants(docs_of([])).count() == 0
    assert SV.variants(docs_of([(1, None), (2, "ab cd")])).count() == 0


def test_pivots_meet_prefixes_for_every_edit():
    """The lemma: of two words one edit apart, a pivot of one stands in the
    other's prefix with the same letters before or behind it."""
    r = random.Random(9)
    for alphabet in ("ab", "abcdefgh"):
        words = {"".join(r.choice(alphabet) for _ in range(r.randrange(5, 12))) for _ in range(300)}
        words |= {x for w in list(words) for x in (edited(r, w, alphabet) for _ in range(3)) if len(x) >= 5}
        df = Counter(g for w in words for g in {w[i:i + 2] for i in range(len(w) - 1)})
        ranks = {g: (i, n) for i, (n, g) in enumerate(sorted((n, g) for g, n in df.items()))}

        def keys(w, grams):
            return {k for g in grams for k in ("<" + w[:g[1] + 2], ">" + w[g[1]:])}
        for a, b in combinations(sorted(words), 2):
            if not distance_one(a, b):
                continue
            pa, pb = SV.prefix_of(a, ranks), SV.prefix_of(b, ranks)
            met = (pa[-1][0] <= pb[-1][0] and keys(a, SV.pivots_of(pa)) & keys(b, pb)) or \
                  (pb[-1][0] <= pa[-1][0] and keys(b, SV.pivots_of(pb)) & keys(a, pa))
            assert met, (a, b)


def test_pivots_are_the_cheapest_disjoint_pair():
    r = random.Random(2)
    for _ in range(500):
        prefix = [(r.randrange(50), p, r.randrange(1, 9)) for p in r.sample(range(8), 3)]
        a, b = SV.pivots_of(prefix)
        cost = min(x[2] + y[2] for x, y in combinations(prefix, 2) if abs(x[1] - y[1]) >= 2)
        assert abs(a[1] - b[1]) >= 2 and a[2] + b[2] == cost


def test_slip_deletes_a_code_point():
    assert SV.slip("été".encode(), 4) == "ét".encode()[:0] + "éé".encode()  # 4 % 3 = 1
    assert SV.slip(b"a", 97) == b""


def test_roots_follow_long_ways(spark):
    rows = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(62)] + [("x", "w61")]
    got = {r.word: r.root for r in SV.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: "w62" for w, _ in rows}


def test_one_edit_changes_two_parities_at_most():
    r = random.Random(3)
    letters = "abcxyz" + "Àéÿß"
    for _ in range(2000):
        a = "".join(r.choices(letters, k=r.randrange(1, 9)))
        i = r.randrange(len(a) + 1)
        for b in (a[:i] + r.choice(letters) + a[i:], a[:i] + a[i + 1:], a[:i] + r.choice(letters) + a[i + 1:]):
            assert (SV.parities(a) ^ SV.parities(b)).bit_count() <= 2 * SV.EDITS
    assert SV.parities("ÿ" * 3) < 1 << 63


def test_letters_are_looked_at_before_the_edit_distance(spark):
    words = spark.createDataFrame([("hello", 9), ("hallo", 4), ("helloé", 3), ("helmet", 5)], "word string, n long")
    pairs = SV.near_pairs(words, SV.bigram_ranks(words))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("bit_count") < plan.index("levenshtein")
    got = {(r.word, r.near) for r in pairs.collect()}
    assert got == {("hello", "hallo"), ("hallo", "hello"), ("hello", "helloé"), ("helloé", "hello")}
