"""Registered queries: tokens, vocabulary, encode/decode, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.tokenizers import CHARACTERS, SPACED, register_sql
from tessera.operators import sequences as SQ
from tessera.operators import sketches as SK
from tessera.operators import tokens as TK
from tessera.operators.sampling import three_way_split
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import load_table, materialize, scratch_path


@query("word_tokens")
def word_tokens(spark, d):
    return C.doc_tokens(spark, d)


@query("corpus_stats")
def corpus_stats(spark, d):
    return TK.corpus_stats(C.docs(spark, d))


@query("vocab")
def vocab(spark, d):
    return C.doc_vocab(spark, d).select("token", "token_id")


@query("vocab_special")
def vocab_special(spark, d):
    return TK.with_specials(C.doc_vocab(spark, d)).select("token", "token_id")


@query("vocab_head")
def vocab_head(spark, d):
    # the preview is the feature: ids 0..50 (51 rows)
    return (TK.with_specials(C.doc_vocab(spark, d)).select("token", "token_id")
            .orderBy("token_id").limit(51))


@query("encode_strict")
def encode_strict(spark, d):
    tokens = C.doc_token_arrays(spark, d)
    enc = TK.encode(tokens, C.vocab_of(tokens), unknown="strict")
    return enc.select("doc_id", C.ids_str())


@query("encode_unk")
def encode_unk(spark, d):
    enc = TK.encode(C.benchmark(spark, d), C.vocab_special(spark, d), id_col="item_id", unknown="unk")
    return enc.select("item_id", C.ids_str())


@query("unknown_tokens")
def unknown_tokens(spark, d):
    toks = TK.word_tokens(C.benchmark(spark, d), "item_id")
    return TK.unknown_tokens(toks, C.vocab_special(spark, d))


@query("decode_words")
def decode_words(spark, d):
    vocab = C.vocab_special(spark, d)
    enc = TK.encode(C.benchmark(spark, d), vocab, id_col="item_id", unknown="unk")
    return TK.decode(enc, vocab, id_col="item_id", one_line=True)


@query("encode_spaced")
def encode_spaced(spark, d):
    """The encode job with another tokenizer: runs of anything but white space."""
    vocab = TK.with_specials(TK.vocabulary(TK.word_tokens(C.docs(spark, d), tokenizer=SPACED)))
    enc = TK.encode(C.benchmark(spark, d), vocab, id_col="item_id", unknown="unk", tokenizer=SPACED)
    return enc.select("item_id", C.ids_str())


@query("decode_characters")
def decode_characters(spark, d):
    """Encode and decode by code points: what the documents never hold comes back as <|unk|>."""
    vocab = TK.with_specials(TK.vocabulary(TK.word_tokens(C.docs(spark, d), tokenizer=CHARACTERS)))
    enc = TK.encode(C.benchmark(spark, d), vocab, id_col="item_id", unknown="unk", tokenizer=CHARACTERS)
    return TK.decode(enc, vocab, id_col="item_id", tokenizer=CHARACTERS)


@query("sql_tokens")
def sql_tokens(spark, d):
    """Word, run and character counts of each document by the tokenizers' SQL functions."""
    register_sql(spark)
    return spark.sql("""
        SELECT doc_id, size(tokens_words(text)) :: BIGINT AS n_words, size(tokens_spaced(text)) :: BIGINT AS n_spaced,
               size(tokens_characters(text)) :: BIGINT AS n_characters
        FROM {docs}""", docs=C.docs(spark, d))


@query("corpus_sketch")
def corpus_sketch(spark, d):
    """Sketches of a corpus that grows by files: those of the second refresh are added to the
    first's.  The estimates are reported as within three standard errors of the exact values."""
    corpus, docs = scratch_path(spark, "corpus"), C.docs(spark, d)
    store = SK.SketchStore(spark, scratch_path(spark, "sketches"))
    for part in (0, 1):
        docs.where(F.pmod(F.hash("doc_id"), F.lit(2)) == part).write.mode("append").parquet(corpus)
        store.refresh(corpus)
    exact = TK.corpus_stats(docs).select(F.col("vocab_size").alias("_v"))
    rank = docs.crossJoin(F.broadcast(store.statistics())).agg(  # one row
        F.avg((F.length("text") < F.col("length_quantiles")[0]).cast("int")).alias("_below"),
        F.avg((F.length("text") <= F.col("length_quantiles")[0]).cast("int")).alias("_upto"))
    return store.statistics().crossJoin(exact).crossJoin(rank).select(
        "n_docs", "n_chars", "n_tokens",
        (F.abs(F.col("vocab_size") / F.col("_v") - 1) <= 3 * SK.VOCAB_ERROR).alias("vocab_size_holds"),
        ((F.col("_below") <= 0.5 + SK.RANK_ERROR) & (F.col("_upto") >= 0.5 - SK.RANK_ERROR)).alias("median_holds"))


@query("token_windows")
def token_windows(spark, d):
    w = SQ.token_windows(C.encoded_docs(spark, d), C.WINDOW_LENGTH, C.WINDOW_STRIDE)
    return w.select("doc_id", "win", "start", C.ids_str("input_ids"), C.ids_str("target_ids"))


@query("next_token")
def next_token(spark, d):
    return SQ.next_token(C.encoded_docs(spark, d))


@query("context_pairs")
def context_pairs(spark, d):
    p = SQ.context_pairs(C.encoded_docs(spark, d), C.SKIP, C.CONTEXT)
    return p.select("doc_id", "i", C.ids_str("context_ids"), "target")


@query("pack_documents")
def pack_documents(spark, d):
    tokens = C.doc_token_arrays(spark, d)
    vocab = C.vocab_of(tokens)
    eot = vocab.count()  # id of end-of-text = |V| (a scalar)
    packed = SQ.pack_documents(materialize(C.encoded_docs(spark, d, tokens, vocab)), C.PACK_LENGTH, eot, C.PACK_SHARDS,
                               shard_expr=F.pmod(F.col("doc_id"), F.lit(C.PACK_SHARDS)))
    return packed.select("shard", "block", C.ids_str())


@query("left_crop")
def left_crop(spark, d):
    return SQ.left_crop(C.encoded_docs(spark, d), C.CROP).select("doc_id", C.ids_str())


def labelled_split(spark, d):
    """documents ⋈ labels, split 70/10/20 by seeded shuffle of doc_id, encoded."""
    lab = load_table(spark, d, "labels").join(C.docs(spark, d), "doc_id")
    split = three_way_split(lab.select("doc_id"), "doc_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC)  # keys only
    enc = TK.encode(lab.select("doc_id", "text"), C.doc_vocab(spark, d), unknown="keep")
    return materialize(enc.join(split.select("doc_id", "split"), "doc_id"))  # read for the length, then for the rows


@query("max_encoded_length")
def max_encoded_length(spark, d):
    return SQ.max_encoded_length(labelled_split(spark, d).where(F.col("split") == "train"))


@query("pad_truncate")
def pad_truncate(spark, d):
    enc = labelled_split(spark, d)
    # the training split fixes the length; the other splits reuse it (a scalar)
    length = SQ.max_encoded_length(enc.where(F.col("split") == "train")).first()[0]
    return SQ.pad_truncate(enc, int(length)).select("split", "doc_id", C.ids_str())


@query("prepare_for_scoring")
def prepare_for_scoring(spark, d):
    enc = C.encoded_docs(spark, d)
    return SQ.prepare_for_scoring(enc, C.SCORE_LENGTH, C.SCORE_CONTEXT).select("doc_id", C.ids_str())



@query("corpus_preview")
def corpus_preview(spark, d):
    """First-N preview per document: 99 characters and the first 30 word tokens."""
    docs = C.docs(spark, d)
    return docs.select("doc_id", F.substring("text", 1, 99).alias("head_text"),
                       F.array_join(F.slice(T.word_tokens("text"), 1, 30), " ").alias("head_tokens"))
