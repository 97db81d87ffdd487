"""Word tokenizer, vocabulary, encode/decode: golden literals and properties."""


from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import tokens as TK


def py_tokens(s):
    """A scanner by hand: a mark or a double dash is a token, white space ends one."""
    out, word, i = [], "", 0
    while i < len(s):
        width = 2 if s.startswith(T.DOUBLE_DASH, i) else 1
        cut = width == 2 or s[i] in T.PUNCT_CHARS or s[i].isspace()
        if cut:
            out += [word] if word else []
            out += [] if s[i].isspace() else [s[i:i + width]]
            word = ""
        else:
            word += s[i]
        i += width
    return out + ([word] if word else [])


def spark_tokens(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: list(r.tokens) for r in TK.tokenize(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_double_hyphen_and_edges(spark):
    got = spark_tokens(spark, ["a---b", "---", "", "  \t\n ", "x--y -z- a-,b"])
    assert got[0] == ["a", "--", "-b"]
    assert got[1] == ["--", "-"]
    assert got[2] == [] and got[3] == []
    assert got[4] == ["x", "--", "y", "-z-", "a-", ",", "b"]


def test_unicode_space_is_a_delimiter(spark):
    text = "a b c\x1cd　e"
    assert spark_tokens(spark, [text])[0] == py_tokens(text) == ["a", "b", "c", "d", "e"]


ALPHABET = st.sampled_from(list("ab é-,.:;?_!\"()'\t\n  xyz0"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=8))
def test_tokenizer_matches_python_split(spark, texts):
    assert spark_tokens(spark, texts) == [py_tokens(t) for t in texts]


def _vocab(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    return TK.vocabulary(TK.word_tokens(df)), df


def test_vocabulary_sorted_dense_with_specials(spark):
    texts = ["the cat, the hat.", "A dog! (b) 'c'"]
    vocab, _ = _vocab(spark, texts)
    full = TK.with_specials(vocab)
    rows = {r.token: r.token_id for r in full.collect()}
    expected = sorted({t for x in texts for t in py_tokens(x)})
    assert [t for t, _ in sorted(rows.items(), key=lambda kv: kv[1])][:len(expected)] == expected
    assert rows[T.END_OF_TEXT] == len(expected) and rows[T.UNKNOWN] == len(expected) + 1
    assert sorted(rows.values()) == list(range(len(expected) + 2))


def test_encode_unknown_and_decode_roundtrip(spark):
    vocab, _ = _vocab(spark, ["Hello, do you like tea? In the sunlit terraces of the palace."])
    full = TK.with_specials(vocab)
    ids = {r.token: r.token_id for r in full.collect()}
    q = spark.createDataFrame([(1, "Hello, do you like coffee? <|endoftext|> In the palace.")],
                              "item_id BIGINT, text STRING")
    enc = TK.encode(q, full, id_col="item_id", unknown="unk").first().ids
    expect = [ids.get(t, ids[T.UNKNOWN]) for t in py_tokens(q.first().text)]
    assert enc == expect
    assert ids[T.UNKNOWN] in enc and ids[T.END_OF_TEXT] in enc  # the special is a known token
    back = TK.decode(spark.createDataFrame([(1, enc)], "item_id BIGINT, ids ARRAY<BIGINT>"), full,
                     id_col="item_id").first().text
    assert back == "Hello, do you like <|unk|>? <|endoftext|> In the palace."


def test_strict_encode_fails_on_unknown(spark):
    vocab, _ = _vocab(spark, ["known words only"])
    q = spark.createDataFrame([(1, "Hello")], "doc_id BIGINT, text STRING")
    import pytest
    with pytest.raises(Exception, match="unknown token"):
        TK.encode(q, vocab, unknown="strict").collect()
    report = TK.unknown_tokens(TK.word_tokens(q), vocab).collect()
    assert [(r.token, r.n) for r in report] == [("Hello", 1)]


def test_decode_rule_is_lossy_like_the_studied_one(spark):
    df = spark.createDataFrame([(["a", ",", "b", ":", "(", "c", ")", "--", "d"],)], "t ARRAY<STRING>")
    out = df.select(T.decode_tokens(F.col("t")).alias("s")).first().s
    want = ""
    for token in ["a", ",", "b", ":", "(", "c", ")", "--", "d"]:
        want += token if not want or token in T.DECODE_GLUE_CHARS else " " + token
    assert out == want


def test_java_space_class_equals_python_isspace(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "cp INT, ch STRING")
    got = {r.cp for r in df.where(F.col("ch").rlike(T.JAVA_SPACE)).select("cp").collect()}
    assert got == {c for c in points if chr(c).isspace()}


def test_null_and_empty_texts(spark):
    from tessera.operators import sequences as SQ
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b, c"), (4, "   ")], "doc_id BIGINT, text STRING")
    stats = TK.corpus_stats(df).first()
    assert (stats.n_docs, stats.n_chars, stats.n_tokens, stats.vocab_size) == (4, 9, 4, 4)
    vocab = TK.vocabulary(TK.word_tokens(df))
    enc = {r.doc_id: list(r.ids) for r in TK.encode(df, vocab, unknown="keep").collect()}
    assert enc[1] == [] and enc[2] == [] and enc[4] == [] and len(enc[3]) == 4
    wins = SQ.token_windows(TK.encode(df, vocab, unknown="keep"), 2, 1).collect()
    assert sorted((r.doc_id, r.win) for r in wins) == [(3, 0), (3, 1)]
