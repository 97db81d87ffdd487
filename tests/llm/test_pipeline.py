"""The corpus pipeline and the registered queries."""

import random
import re

import public_tokenizers
import tiktoken

import corpus_pipeline as CP
from tessera.llm import byte_bpe as BP
from tessera.llm.queries import QUERIES, SQL
from tessera.session import scratch_path

SF_SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(r):
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, labels = [], []
    passage = text(25)
    for i in range(240):
        t = text(r.randrange(20, 90))
        if i % 4 == 0:
            t = t + " vileinsult " + text(5)
        labels.append((i, int(i % 4 == 0)))
        rows.append((i, t))
    rows += [(500 + i, rows[i][1]) for i in (1, 2, 3, 5, 5)]  # copies, one row twice
    for i in (6, 7, 9):  # near copies: one word of many changed
        w = rows[i][1].split()
        w[0] = "changed"
        rows.append((600 + i, " ".join(w)))
    rows += [(700 + i, text(10) + " " + passage.upper() + " " + text(10)) for i in range(3)]
    rows += [(800, None), (801, ""), (802, "clean words of a short text"), (803, None)]
    return rows, labels, [("b1", passage), ("b2", "unseen " * 12)]


def brute(rows, items):
    rows = list(dict.fromkeys(r for r in rows if "vileinsult" not in (r[1] or "")))
    last = {}
    for i, t in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = [(i, t) for i, t in rows if last[t or ""] == i]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [(i, t) for i, t in rows if find(i) == i]
    word = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    windows = {tuple(word(x)[j:j + 10]) for _, x in items for j in range(len(word(x)) - 9)}
    return [(i, t) for i, t in rows if not any(tuple(word(t)[j:j + 10]) in windows for j in range(len(word(t)) - 9))]


def test_pipeline_equals_brute_force(spark):
    rows, labels, items = corpus(random.Random(11))
    d = scratch_path(spark, "pipeline-tables")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id STRING, text STRING").write.parquet(f"{d}/benchmark.parquet")
    assert [name for name, _ in CP.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "decontaminate", "byte_bpe"]
    got = {r.doc_id: r for r in CP.run(spark, d).collect()}
    want = dict(brute(rows, items))
    assert set(got) == set(want)
    ranks = BP.load_ranks(BP.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.id_of, special_tokens={})
    for i, t in want.items():
        assert got[i].ids == lib.encode_ordinary(t or "") and got[i].n_tokens == len(got[i].ids) and got[i].round_trip


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(CP.STAGES):
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        if k < len(CP.STAGES) - 1:
            assert out.columns == COLUMNS


def test_queries_cover_every_operator():
    import __spark_entry__ as E
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(n) for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
