"""Registered queries: naive Bayes, logistic head, bigram LM, generation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as T
from tessera.operators import classify as CL
from tessera.operators import kneser_ney as KN
from tessera.operators import ngram as NG
from tessera.operators import text_classifier as TC
from tessera.operators import tokens as TK
from tessera.operators import training as TR
from tessera.operators.sampling import char_split, three_way_split
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import load_table, materialize, scratch_path, store

GEN_STEPS, GEN_TOP_K, GEN_TEMPERATURE = 5, 25, 1.4


def _r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- naive Bayes
def labelled_docs(spark, d):
    lab = load_table(spark, d, "labels").select("doc_id", F.col("toxic").alias("class"))
    return C.docs(spark, d).join(lab, "doc_id")


def nb_model(spark, d):
    ld = labelled_docs(spark, d)
    toks = A.rows_of(ld, ["doc_id", "class"], T.word_tokens("text"), value="token")
    return CL.train_naive_bayes(toks, ld.select("doc_id", "class"), "class")


@query("nb_train")
def nb_train(spark, d):
    return nb_model(spark, d).pairs.select("class", "token", _r6(F.col("log_p")).alias("log_p"))


@query("nb_classify")
def nb_classify(spark, d):
    model = nb_model(spark, d)
    docs = C.docs(spark, d)
    return CL.classify_naive_bayes(model, TK.token_blocks(docs, counted=True), docs)


# ---------------------------------------------------------------- logistic head (rows-only)
def _lr_data(spark, d):
    ld = labelled_docs(spark, d).withColumnRenamed("class", "label")
    split = three_way_split(ld.select("doc_id"), "doc_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC)
    return ld.join(split.select("doc_id", "split"), "doc_id")


@query("train_linear_head")
def train_linear_head(spark, d):
    data = _lr_data(spark, d)
    model = CL.fit_linear_head(data.where(F.col("split") == "train"), max_iter=20)
    scored = CL.score_linear_head(model, data)
    return scored.join(data.select("doc_id", "split", "label"), "doc_id").withColumn(
        "name", CL.class_name())


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """Save the classifier, load it, score the documents with what was loaded."""
    path = scratch_path(spark, "naive-bayes")
    nb_model(spark, d).save(path)
    docs = C.docs(spark, d)
    return CL.classify_naive_bayes(CL.NaiveBayes.load(spark, path), TK.token_blocks(docs, counted=True), docs)


@query("nb_pipeline_spaced")
def nb_pipeline_spaced(spark, d):
    """Naive Bayes over runs of non-space as a stage of a Pipeline, saved and loaded."""
    path = scratch_path(spark, "pipeline")
    stage = TC.TextClassifier(labelCol="class", predictionCol="p", tokenizer="spaced")
    Pipeline(stages=[stage]).fit(labelled_docs(spark, d)).write().overwrite().save(path)
    return PipelineModel.load(path).transform(C.docs(spark, d)).select(
        "doc_id", F.col("p").cast("bigint").alias("predicted"))


def _trained(spark, d, eval_freq=C.EVAL_FREQ):
    """The head on the embedding vectors: training table split 70/10/20, batches
    of a ``STEPS_PER_EPOCH``-th of the training rows."""
    emb = load_table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    split = three_way_split(emb.select("vec_id"), "vec_id", C.SEED, C.TRAIN_FRAC, C.VALIDATION_FRAC)
    rows = materialize(emb.join(split.select("vec_id", "split"), "vec_id"))
    train = rows.where(F.col("split") == "train")
    return TR.train_head(train, rows.where(F.col("split") == "validation"), "vec_id", "embedding", "label",
                         epochs=C.EPOCHS, batch_size=max(1, train.count() // C.STEPS_PER_EPOCH), seed=C.SEED,
                         eval_freq=eval_freq, eval_batches=C.EVAL_BATCHES)


@query("training_trace")
def training_trace(spark, d):
    """Losses at every EVAL_FREQ-th step and accuracies per epoch of the trained head."""
    trace, _ = _trained(spark, d)
    return trace.select("event", "epoch", "step", "examples_seen", *[
        _r6(F.col(c)).alias(c) for c in ("train_loss", "validation_loss", "train_accuracy", "validation_accuracy")])


@query("train_head_weights")
def train_head_weights(spark, d):
    """Weights of the trained head after the last step (the bias is the last dim)."""
    _, state = _trained(spark, d, eval_freq=None)
    return A.rows_of(state, ["class"], "w", "dim").select(
        "class", F.col("dim").cast("bigint").alias("dim"), _r6(F.col("value")).alias("value"))


# ---------------------------------------------------------------- bigram LM
def _lm_tokens(spark, d):
    """Training (``train``) and held-out (``held``) token arrays from the 90/10 character split."""
    sp = char_split(C.docs(spark, d), "text", 0.9)
    return sp.select("doc_id", T.word_tokens("train_text").alias("train"), T.word_tokens("val_text").alias("held"))


def lm_parts(spark, d):
    """Both, tokenized in one pass and materialised (several jobs read them)."""
    both = store(_lm_tokens(spark, d))
    return (both.select("doc_id", F.col("train").alias("tokens")),
            both.select("doc_id", F.col("held").alias("tokens")))


def lm_counts(spark, d, parts=None):
    train, held = parts or lm_parts(spark, d)
    # read by several lookups and aggregates: materialise once
    return store(NG.bigram_counts(NG.bigrams(train, "doc_id"))), train


@query("ngram_counts")
def ngram_counts(spark, d):
    counts, _ = lm_counts(spark, d)
    return counts


def _doc_losses(spark, d):
    parts = lm_parts(spark, d)
    counts, train = lm_counts(spark, d, parts)
    vocab_size = train.select(F.explode("tokens").alias("t")).distinct().count() + 1  # + <|unk|>
    held = parts[1]
    nll = NG.nll_per_target(NG.bigrams(held, "doc_id"), counts, vocab_size, "doc_id")
    return NG.per_document_loss(nll, "doc_id")


@query("doc_perplexity")
def doc_perplexity(spark, d):
    return _doc_losses(spark, d).select("doc_id", "n_targets", _r6(F.col("loss")).alias("loss"),
                                         _r6(F.col("perplexity")).alias("perplexity"))


@query("lm_loss")
def lm_loss(spark, d):
    return NG.corpus_loss(_doc_losses(spark, d)).select(
        "n_docs", "n_targets", _r6(F.col("loss")).alias("loss"), _r6(F.col("perplexity")).alias("perplexity"))


def _kneser_ney(spark, d, order: int):
    both = _lm_tokens(spark, d)  # not stored: each is read once, into blocks
    train, held = (both.select("doc_id", F.col(x).alias("tokens")) for x in ("train", "held"))
    model, vocab_size = KN.fit(train, "doc_id", order)
    nll = KN.nll_per_target(KN.grams(held, "doc_id", order), model, vocab_size, "doc_id", order)
    return NG.corpus_loss(NG.per_document_loss(nll, "doc_id")).select(
        "n_docs", "n_targets", _r6(F.col("loss")).alias("loss"), _r6(F.col("perplexity")).alias("perplexity"))


@query("lm_loss_order3")
def lm_loss_order3(spark, d):
    """Held-out loss of the interpolated Kneser-Ney model of order 3."""
    return _kneser_ney(spark, d, 3)


@query("lm_loss_order5")
def lm_loss_order5(spark, d):
    """Held-out loss of the interpolated Kneser-Ney model of order 5."""
    return _kneser_ney(spark, d, 5)


def _generation_inputs(spark, d):
    counts, train = lm_counts(spark, d)
    fallback = train.agg(F.min(F.array_min("tokens"))).first()[0]  # id 0
    prompts = TK.tokenize(C.benchmark(spark, d), "item_id")
    return counts, prompts, fallback


@query("generate_greedy")
def generate_greedy(spark, d):
    counts, prompts, fallback = _generation_inputs(spark, d)
    out = NG.generate_greedy(prompts, counts, fallback, GEN_STEPS)
    return out.select("item_id", NG.decode_words("new_tokens").alias("text"))


@query("generate_t0")
def generate_t0(spark, d):
    """The sampler at temperature 0, its default: greedy."""
    counts, prompts, fallback = _generation_inputs(spark, d)
    out = NG.generate_sampled(prompts, counts, fallback, GEN_STEPS, GEN_TOP_K, 0.0, C.SEED,
                              stop_token=T.END_OF_TEXT)
    return out.select("item_id", NG.decode_words("new_tokens").alias("text"))


@query("sample_next")
def sample_next(spark, d):
    counts, prompts, fallback = _generation_inputs(spark, d)
    out = NG.generate_sampled(prompts, counts, fallback, 1, GEN_TOP_K, GEN_TEMPERATURE, C.SEED)
    return out.select("item_id", F.element_at("new_tokens", 1).alias("next_token"))


@query("generate_sampled")
def generate_sampled(spark, d):
    counts, prompts, fallback = _generation_inputs(spark, d)
    out = NG.generate_sampled(prompts, counts, fallback, GEN_STEPS, GEN_TOP_K, GEN_TEMPERATURE, C.SEED,
                              stop_token=T.END_OF_TEXT)
    return out.select("item_id", NG.decode_words("new_tokens").alias("text"))
