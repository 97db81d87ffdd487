"""Kneser-Ney of order n against a direct computation; probabilities sum to 1."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import kneser_ney as KN
from tessera.operators import ngram as NG


def corpus(spark, seed=4, n=40):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(9)] + ["é", ","]
    docs = [(i, [r.choice(words[:3 + i % 8]) for _ in range(r.randrange(0, 14))]) for i in range(n)] + [(n, ["hot"] * 80)]
    return docs, spark.createDataFrame(docs, "doc_id bigint, tokens array<string>")


def brute(docs, order, d=KN.DISCOUNT):
    counts = {order: Counter((tuple(([""] * (order - 1) + t)[i:i + order - 1]), t[i]) for _, t in docs for i in range(1, len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter((c[1:], w) for c, w in counts[k + 1])
    v = len({w for _, t in docs for w in t}) + 1

    def p(c, w):
        k = len(c) + 1
        lower = p(c[1:], w) if c else 1 / v
        total = sum(n for (x, _), n in counts[k].items() if x == c)
        if not total:
            return lower
        kinds = sum(x == c for x, _ in counts[k])
        return max(counts[k][c, w] - d, 0) / total + d * kinds / total * lower
    return p, v


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_equals_a_direct_computation(spark, order):
    docs, df = corpus(spark)
    p, v = brute(docs, order)
    model, size = KN.fit(df, "doc_id", order)
    assert size == v
    held = [(0, ["w0", "w1", "new", "w2", "w1"]), (1, ["hot"] * 6), (2, ["one"]), (3, []), (4, None)]
    targets = KN.grams(spark.createDataFrame(held, "doc_id bigint, tokens array<string>"), "doc_id", order)
    got = {(r.doc_id, r.pos): r.nll for r in KN.nll_per_target(targets, model, size, "doc_id", order).collect()}
    want = {(i, k): -math.log(p(tuple(([""] * (order - 1) + t)[k:k + order - 1]), t[k])) for i, t in held if t for k in range(1, len(t))}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def test_probabilities_of_a_context_sum_to_one(spark):
    docs, _ = corpus(spark)
    p, v = brute(docs, 3)
    known = {w for _, t in docs for w in t}
    for c in (("w0", "w1"), ("", "w0"), ("new", "new")):
        assert sum(p(c, w) for w in known) + p(c, "<|unk|>") == pytest.approx(1)


def test_longer_contexts_help(spark):
    """A corpus with structure: the perplexity falls from the bigram model's."""
    r = random.Random(1)
    chains = [" ".join(f"{a}{b}" for b in range(6)).split() for a in "abcdef"]
    docs = [(i, sum((r.choice(chains) for _ in range(5)), [])) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, tokens array<string>")
    train, held = df.where("doc_id < 45"), df.where("doc_id >= 45")
    counts = NG.bigram_counts(NG.bigrams(train, "doc_id"))
    size = train.select(F.explode("tokens")).distinct().count() + 1
    two = NG.corpus_loss(NG.per_document_loss(NG.nll_per_target(
        NG.bigrams(held, "doc_id"), counts, size, "doc_id"), "doc_id")).first()
    model, size = KN.fit(train, "doc_id", 3)
    three = NG.corpus_loss(NG.per_document_loss(KN.nll_per_target(
        KN.grams(held, "doc_id", 3), model, size, "doc_id", 3), "doc_id")).first()
    assert three.n_targets == two.n_targets and three.perplexity < two.perplexity


@pytest.mark.parametrize("order, bits", [(1, None), (2, None), (3, 40), (5, None)])
def test_parts_of_few_grams_give_the_same(spark, monkeypatch, order, bits):
    """Many parts, heavy prefixes of every length, a word of one token each too."""
    monkeypatch.setattr(KN, "GRAMS", 40)
    if bits:
        monkeypatch.setattr(KN.Layout, "__post_init__", _wide(KN.Layout.__post_init__, bits))
    docs, df = corpus(spark)
    p, v = brute(docs, order)
    model, size = KN.fit(df, "doc_id", order)
    assert size == v and model.layout.parts > 5 and all(len(h) for h in model.layout.heavy)
    held = [(0, ["w0", "w1", "new", "w2", "w1"]), (1, ["hot"] * 6), (2, ["one"]), (3, []), (4, None)] + docs[5:]
    targets = KN.grams(spark.createDataFrame(held, "doc_id bigint, tokens array<string>"), "doc_id", order)
    got = {(r.doc_id, r.pos): r.nll for r in KN.nll_per_target(targets, model, size, "doc_id", order).collect()}
    want = {(i, k): -math.log(p(tuple(([""] * (order - 1) + t)[k:k + order - 1]), t[k])) for i, t in held if t for k in range(1, len(t))}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def _wide(made, bits):
    def post(self):
        made(self)
        self.bits, self.per_word = bits, 63 // bits
        self.words = -(-self.order // self.per_word)
    return post


def test_a_frequent_context_is_dealt_over_parts(spark, monkeypatch):
    """A third of all grams stand behind one pair: no part holds them all, and
    each distinct gram is in one part."""
    monkeypatch.setattr(KN, "GRAMS", 500)
    r = random.Random(2)
    docs = [(i, sum((["of", "the", f"n{r.randrange(900)}"] for _ in range(40)), [])) for i in range(40)]
    model, _ = KN.fit(spark.createDataFrame(docs, "doc_id bigint, tokens array<string>"), "doc_id", 3)
    assert [len(h) > 0 for h in model.layout.heavy] == [True, True]
    sizes = [r.n for r in model.parts.groupBy("part").agg((F.sum(F.length("grams")) / 8 / (model.layout.words + 1)).alias("n")).collect()]
    distinct = {tuple((["", ""] + t)[i:i + 3]) for _, t in docs for i in range(1, len(t))}
    behind = sum(g[:2] == ("of", "the") for g in distinct)
    assert sum(sizes) == len(distinct) and max(sizes) < behind / 2
