"""Exit-word sessions (batch and stream), naive Bayes, BPE round trip, sources."""

import re

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import bpe as B
from tessera.operators import classify as CL
from tessera.operators import tokens as TK
from tessera.operators.conversations import until_exit
from tessera.session import scratch_path
from tessera.sources import files as FS
from tessera.streaming import scoring as SS

CONV = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "EXIT"),
        (1, 3, "user", "more"), (2, 0, "user", " exit"), (2, 1, "user", "Quit"), (2, 2, "user", "x"),
        (3, 0, "assistant", "exit"), (3, 1, "user", "ok")]


def test_exit_words_batch(spark):
    df = spark.createDataFrame(CONV, SS.CONVERSATION_SCHEMA)
    kept = sorted((r.conv_id, r.turn) for r in until_exit(df, ("exit", "quit")).collect())
    # EXIT stops, ' exit' does not (no strip), Quit stops, assistant text never stops
    assert kept == [(1, 0), (1, 1), (2, 0), (3, 0), (3, 1)]


def test_naive_bayes_matches_brute_force(spark):
    docs = [(0, "buy cheap pills now", 1), (1, "cheap cheap offer", 1), (2, "see you at lunch", 0),
            (3, "lunch at noon", 0), (4, "are you free", 0)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, class INT")
    toks = TK.word_tokens(df.select("doc_id", "text")).join(df.select("doc_id", "class"), "doc_id")
    model = CL.train_naive_bayes(toks, df.select("doc_id", "class"), "class")
    test = spark.createDataFrame([(10, "cheap lunch pills"), (11, "you at noon"), (12, "zzz")],
                                 "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.predicted for r in CL.classify_naive_bayes(model, TK.word_tokens(test), test).collect()}
    # brute force
    import math
    from collections import Counter
    words = {c: Counter() for c in (0, 1)}
    for _, t, c in docs:
        words[c].update(t.split())
    V = set(words[0]) | set(words[1])
    prior = {c: math.log(sum(1 for d in docs if d[2] == c) / len(docs)) for c in (0, 1)}

    def score(t, c):
        n = sum(words[c].values())
        return prior[c] + sum(math.log((words[c][w] + 1) / (n + len(V))) for w in t.split() if w in V)
    for i, t in [(10, "cheap lunch pills"), (11, "you at noon"), (12, "zzz")]:
        s = [score(t, c) for c in (0, 1)]
        assert got[i] == (1 if s[1] > s[0] else 0)


def test_bpe_roundtrip_and_tiktoken_parity(spark):
    texts = ["Rain again, so we stay in. <|endoftext|> Nobody at theNewHarbour minds.",
             "héllo wörld 123  spaces\n\nnew lines", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    model = B.build_ranks(spark, df, pieces=64)
    enc = B.encode(df, model, special="allow")
    back = {r.doc_id: r.text for r in B.decode(enc, model).collect()}
    assert [back[i] for i in range(len(texts))] == texts
    # same ids as the library applied to the whole text
    import tiktoken
    lib = tiktoken.Encoding(name="t", pat_str=B.TIKTOKEN_PATTERN, mergeable_ranks=dict(model.broadcast.value),
                            special_tokens={"<|endoftext|>": model.special_id})
    got = {r.doc_id: list(r.ids) for r in enc.collect()}
    for i, t in enumerate(texts):
        assert got[i] == lib.encode(t, allowed_special={"<|endoftext|>"})
    counts = {r.token_id: r.n for r in B.token_counts(df, model).collect()}
    assert sum(counts.values()) == sum(len(v) for v in got.values())


def test_bpe_special_error_mode(spark):
    import pytest
    df = spark.createDataFrame([(0, "a <|endoftext|> b")], "doc_id BIGINT, text STRING")
    model = B.build_ranks(spark, df, pieces=8)
    with pytest.raises(Exception, match="special token"):
        B.encode(df, model, special="error").collect()


def test_csv_doubled_quotes_roundtrip(spark):
    rows = [(1, 'He said ""hi"", then left'), (0, "comma, inside"), (1, 'quote "x"\nnext line'), (0, "plain")]
    df = spark.createDataFrame([(a, b.replace('""', '"')) for a, b in rows], "Label INT, Text STRING")
    path = scratch_path(spark, "csv")
    FS.write_labelled_csv(df, path)
    local = path.split(":", 1)[1] if path.startswith("file:") else path
    raw = "".join(open(p).read() for p in sorted(__import__("glob").glob(local + "/*.csv")))
    assert '""hi""' in raw  # RFC 4180 doubling on write
    back = sorted((r.Label, r.Text) for r in FS.read_labelled_csv(spark, path).collect())
    assert back == sorted((r.Label, r.Text) for r in df.collect())


def test_label_tsv_reader(spark, tmp_path):
    p = tmp_path / "SMSSpamCollection.tsv"
    p.write_text('ham\tGo until "jurong" point\nspam\tWINNER!! claim, now\n')
    out = FS.read_label_tsv(spark, str(p)).select("Label", "Text", FS.raw_label_ids().alias("y")).collect()
    assert [(r.Label, r.Text, r.y) for r in out] == [("ham", 'Go until "jurong" point', 0),
                                                   ("spam", "WINNER!! claim, now", 1)]


def test_class_name_rule(spark):
    df = spark.createDataFrame([(1,), (0,), (2,)], "predicted INT")
    assert [r[0] for r in df.select(CL.class_name()).collect()] == ["spam", "not spam", "not spam"]


def _lr_fixture(spark):
    rows = [(i, f"cheap pills offer {i}" if i % 2 else f"see you at lunch {i}", i % 2) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, label INT")


def test_model_roundtrip_and_trace(spark):
    data = _lr_fixture(spark)
    model = CL.fit_linear_head(data, max_iter=15, num_features=1 << 10)
    path = scratch_path(spark, "lr")
    CL.save_model(model, path)
    a = {r.doc_id: r.predicted for r in CL.score_linear_head(model, data).collect()}
    b = {r.doc_id: r.predicted for r in CL.score_linear_head(CL.load_model(path), data).collect()}
    assert a == b and set(a.values()) == {0, 1}
    assert sum(a[i] == i % 2 for i in a) >= 38  # separable fixture
    trace = CL.objective_trace(model)
    assert 1 <= len(trace) <= 16 and trace[-1] <= trace[0]


def test_stream_score_equals_batch(spark):
    data = _lr_fixture(spark)
    model = CL.fit_linear_head(data, max_iter=15, num_features=1 << 10)
    path = scratch_path(spark, "lr-stream")
    CL.save_model(model, path)
    msgs = spark.createDataFrame([(1, t, "user", x) for t, x in enumerate(
        ["cheap pills", "lunch at noon?", "exit", "offer offer", "Quit", "see you"])], SS.CONVERSATION_SCHEMA)
    src = scratch_path(spark, "msgs")
    msgs.write.parquet(src)
    stream = SS.read_message_stream(spark, src, SS.CONVERSATION_SCHEMA)
    scored = SS.score_messages(stream, CL.load_model(path), ("exit", "quit"), ["conv_id", "turn"])
    sink = scratch_path(spark, "scored")
    SS.run_to_parquet(scored, sink, scratch_path(spark, "scored-ck"))
    got = {r.turn: (r.predicted, r.verdict) for r in spark.read.parquet(sink).collect()}
    batch = CL.score_linear_head(model, msgs.where(~F.lower("text").isin("exit", "quit"))
                                 .withColumnRenamed("turn", "doc_id"))
    want = {r.doc_id: (r.predicted, "spam" if r.predicted == 1 else "not spam") for r in batch.collect()}
    assert got == want and 2 not in got and 4 not in got  # exit words are not scored


def test_bpe_counts_equal_brute_force(spark):
    import tiktoken
    texts = ["the cat and the hat", "the end. <|endoftext|> the start", "ünïcödé the"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    model = B.build_ranks(spark, df, pieces=16)
    lib = tiktoken.Encoding(name="t2", pat_str=B.TIKTOKEN_PATTERN, mergeable_ranks=dict(model.broadcast.value),
                            special_tokens={"<|endoftext|>": model.special_id})
    from collections import Counter
    want = Counter(i for t in texts for i in lib.encode(t, allowed_special={"<|endoftext|>"}))
    got = {r.token_id: r.n for r in B.token_counts(df, model).collect()}
    assert got == dict(want)


def test_bpe_by_blocks_keeps_every_text(spark):
    texts = ["a b a b", "", None, f"x{B.T.END_OF_TEXT}{B.T.END_OF_TEXT} y z", "café \U0001f600\n\tend ", "a b"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no id")], "doc_id long, text string").repartition(3)
    blocks = B.piece_blocks(docs)
    assert ({tuple(r) for r in B.piece_counts(blocks).collect()}
            == {tuple(r) for r in B.piece_counts(docs).collect()})
    model = B.build_ranks(spark, docs, pieces=8)
    enc = B.encode(docs, model, blocks=blocks)
    back = B.decode(enc, model)
    assert "Generate" not in B.decode(docs.select("doc_id", F.array(F.lit(97)).alias("ids")), model
                                      )._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.text for r in back.collect()} == {**{i: t or "" for i, t in enumerate(texts)}, None: "no id"}


def test_bpe_rows_that_share_an_id_and_unknown_ids(spark):
    docs = spark.createDataFrame([(1, "é b"), (1, "é b"), (1, "c"), (2, "a")], "doc_id long, text string")
    model = B.build_ranks(spark, docs, pieces=0)
    enc = B.encode(docs, model)
    assert sorted((r.doc_id, r.ids) for r in enc.collect()) == [
        (1, [99]), (1, [195, 169, 32, 98]), (1, [195, 169, 32, 98]), (2, [97])]
    assert sorted(tuple(r) for r in B.decode(enc, model).collect()) == sorted(tuple(r) for r in docs.collect())
    ids = spark.createDataFrame([(1, [97, None, 10_000, -1, 98]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in B.decode(ids, model).collect()) == [(1, "ab"), (2, ""), (3, "")]
