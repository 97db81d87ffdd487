"""Windows, targets, padding, packing."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import sequences as SQ


def py_windows(ids, L, S):
    return [(ids[i:i + L], ids[i + 1:i + L + 1]) for i in range(0, len(ids) - L, S)]


def windows(spark, seqs, L, S):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "doc_id BIGINT, ids ARRAY<BIGINT>")
    rows = SQ.token_windows(df, L, S).collect()
    out = {i: [] for i in range(len(seqs))}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.win)):
        out[r.doc_id].append((list(r.input_ids), list(r.target_ids)))
    return [out[i] for i in range(len(seqs))]


def test_window_counts_on_edges(spark):
    got = windows(spark, [list(range(4)), list(range(5)), []], 4, 4)
    assert [len(g) for g in got] == [0, 1, 0]


def test_window_counts_golden(spark):
    ids = list(range(4690))  # the prose file's word-token count
    got = windows(spark, [ids, ids, ids, ids], 256, 128)
    assert len(got[0]) == 35
    assert [len(w) for w in windows(spark, [ids], 256, 256)] == [18]
    assert [len(w) for w in windows(spark, [ids], 4, 4)] == [1172]
    assert [len(w) for w in windows(spark, [ids], 4, 1)] == [4686]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), max_size=30), min_size=1, max_size=5),
       st.integers(1, 6), st.integers(1, 5))
def test_windows_match_python(spark, seqs, L, S):
    assert windows(spark, seqs, L, S) == [py_windows(s, L, S) for s in seqs]


def test_next_token_targets(spark):
    df = spark.createDataFrame([(0, [16833, 3626, 6100, 345]), (1, [40, 1107, 588, 11311])],
                               "doc_id BIGINT, ids ARRAY<BIGINT>")
    rows = SQ.next_token(df).where(F.col("next_id").isNotNull()).orderBy("doc_id", "pos").collect()
    assert [r.next_id for r in rows if r.doc_id == 0] == [3626, 6100, 345]
    assert [r.next_id for r in rows if r.doc_id == 1] == [1107, 588, 11311]


def test_pad_truncate_golden(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "ids ARRAY<BIGINT>")
    assert df.select(T.pad_truncate(F.col("ids"), 5)).first()[0] == [1, 2, 3, 50256, 50256]
    assert df.select(T.pad_truncate(F.col("ids"), 2)).first()[0] == [1, 2]
    assert df.select(T.left_crop(F.col("ids"), 2)).first()[0] == [2, 3]


def test_scoring_length_guard(spark):
    import pytest
    df = spark.createDataFrame([([1, 2, 3],)], "ids ARRAY<BIGINT>")
    with pytest.raises(ValueError):
        SQ.prepare_for_scoring(df, 2000, 1024)
    assert SQ.prepare_for_scoring(df, 4, 1024).first().ids == [1, 2, 3, 50256]


def test_pack_documents_concatenates_in_order(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4]), (2, [5, 6])], "doc_id BIGINT, ids ARRAY<BIGINT>")
    out = SQ.pack_documents(df, 3, 99, 1, shard_expr=F.lit(0)).orderBy("block").collect()
    flat = [x for r in out for x in r.ids]
    assert flat == [1, 2, 3, 99, 4, 99, 5, 6, 99]
    assert [len(r.ids) for r in out] == [3, 3, 3]


def test_growing_contexts(spark):
    df = spark.createDataFrame([(0, list(range(60)))], "doc_id BIGINT, ids ARRAY<BIGINT>")
    rows = SQ.context_pairs(df, 50, 4).orderBy("i").collect()
    assert [(list(r.context_ids), r.target) for r in rows] == [
        (list(range(50, 50 + i)), 50 + i) for i in range(1, 5)]
