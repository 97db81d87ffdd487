"""Blocks of documents with their own dictionaries: the same rows as token by token."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks as BL
from tessera.operators import tokens as TK

ROWS = [(1, ["b", "a", None, "b"]), (2, []), (3, None), (None, ["c"]), (4, ["a", "zz"]), (4, ["b", "a"]), (5, ["x"] * 7)]
VOCAB = [("a", 0, 3), ("b", 1, 3), ("b", 9, 0), ("c", 2, 1), ("x", 3, 7)]


def _tables(spark):
    return (spark.createDataFrame(ROWS, "doc_id BIGINT, tokens ARRAY<STRING>"),
            spark.createDataFrame(VOCAB, "token STRING, token_id BIGINT, freq BIGINT"))


@pytest.mark.parametrize("limit", [1, 3, 1 << 19])
def test_encode_by_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(BL, "BLOCK_TOKENS", limit)
    docs, vocab = _tables(spark)
    got = {r.doc_id: r.ids for r in TK.encode(docs.coalesce(1), vocab, unknown="keep", tokens_col="tokens").collect()}
    assert got == {1: [1, 9, 0, None, 1, 9], 2: [], 3: [], None: [2], 4: [0, 1, 9, None, 0], 5: [3] * 7}


def test_words_of_a_block_are_distinct_and_meet_the_vocabulary_once(spark):
    docs = spark.range(400, numPartitions=2).select(F.col("id").alias("doc_id"), F.lit("the cat the dog , the").alias("text"))
    blocks = TK.token_blocks(docs)
    words = blocks.words().collect()
    assert len(words) <= 4 * blocks.table.count() and blocks.table.count() == 2  # not 2,400 rows of tokens
    assert {r.token: r.freq for r in TK.vocabulary(blocks).collect()} == {",": 400, "cat": 400, "dog": 400, "the": 1200}


def test_counted_rows_are_the_known_tokens_of_each_document(spark):
    docs, _ = _tables(spark)
    blocks = BL.pack(docs, counted=True)
    known = spark.createDataFrame([("b", 7.0), ("x", 8.0)], "token STRING, g DOUBLE")
    got = sorted((r.doc_id, r.g, r._c) for r in BL.counted_rows(blocks, known, F.col("g"), "g").collect())
    assert got == [(1, 7.0, 2), (4, 7.0, 1), (5, 8.0, 7)]


def test_pooled_embeddings_by_chunks_and_slices(spark, monkeypatch):
    from tessera.operators import vectors as V
    monkeypatch.setattr(V, "VECTOR_CHUNK", 3)
    monkeypatch.setattr(V, "CHUNK_PAIRS", 10)
    monkeypatch.setattr(V, "HELD_VECTORS", 4)
    vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(8)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    rows = [(d, t, 1 + (d + t) % 3) for d in range(9) for t in range(0, 20, 1 + d)]
    got = {r.doc_id: r.vec for r in V.pooled_token_embeddings(
        spark.createDataFrame(rows, "doc_id BIGINT, token_id BIGINT, c BIGINT"), vecs).collect()}
    assert len(got) == 9
    for d, vec in got.items():
        n = sum(c for x, _, c in rows if x == d)
        total = sum(c * (t % 8) for x, t, c in rows if x == d) + sum(p % 8 for p in range(n))
        assert vec == pytest.approx([total / n, 2.0])


def test_classes_are_summed_inside_a_block(spark):
    docs, _ = _tables(spark)
    blocks = BL.pack(docs.where("doc_id is not null").coalesce(1), counted=True)
    seen = spark.createDataFrame([("b", [(1, 0.5), (0, 2.0)]), ("a", [(1, 0.25)])],
                                 "token STRING, seen ARRAY<STRUCT<class: BIGINT, gain: DOUBLE>>")
    rows = [(r.doc_id, r["class"], r._x) for r in BL.class_sums(blocks, seen, F.col("seen")).collect()]
    assert sorted(rows, key=repr) == sorted([
        (1, None, 3.0), (1, 0, 4.0), (1, 1, 1.25),  # b twice, a once; a document of known tokens only
        (4, None, 1.0), (4, 1, 0.25), (4, None, 2.0), (4, 0, 2.0), (4, 1, 0.75)], key=repr)


def test_naive_bayes_by_blocks_equals_token_rows(spark):
    from tessera.operators import classify as CL
    rows = [(i, f"w{i % 5} w{i % 3} the" + " the" * (i % 4), i % 3) for i in range(60)] + [(90, "zzz", 0), (91, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, class BIGINT")
    model = CL.train_naive_bayes(TK.word_tokens(docs).join(docs.select("doc_id", "class"), "doc_id"), docs, "class")
    found = [dict(CL.classify_naive_bayes(model, tokens, docs).collect())
             for tokens in (TK.word_tokens(docs), TK.token_blocks(docs, counted=True))]
    assert found[0] == found[1] and len(found[0]) == 62


def test_sampling_ranks_only_the_contexts_it_draws_from(spark, monkeypatch):
    from tessera.operators import ngram as NG
    counts = spark.createDataFrame([(f"c{i}", f"c{i + 1}", 2) for i in range(50)], "context STRING, next STRING, n BIGINT")
    prompts = spark.createDataFrame([(0, ["c3"]), (1, ["c7"]), (2, []), (3, ["none"])], "item_id BIGINT, tokens ARRAY<STRING>")
    seen, plain = [], NG.ranked_continuations
    monkeypatch.setattr(NG, "ranked_continuations", lambda c: (seen.append(c.count()), plain(c))[1])
    got = dict(NG.generate_sampled(prompts, counts, "c0", 2, 25, 1.4, 1).collect())
    assert got == {0: ["c4", "c5"], 1: ["c8", "c9"], 2: ["c0", "c1"], 3: ["c0", "c1"]}
    assert seen == [2, 3]


def test_hot_keys_of_a_unique_table_need_no_shuffle(spark):
    from tessera.operators.lookup import hot_key_hashes
    table = spark.createDataFrame([(f"k{i}", i % 7) for i in range(40)], "key STRING, freq BIGINT")
    assert hot_key_hashes(table, ["key"], "freq", 9, unique=True) == hot_key_hashes(table, ["key"], "freq", 9)
