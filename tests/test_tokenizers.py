"""Tokenizers as parameters, the classifier as an Estimator, sketches kept per file."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tessera.functions.tokenizers import CHARACTERS, SPACED, WORDS, Tokenizer, register_sql
from tessera.operators import classify as CL
from tessera.operators import sequences as SQ
from tessera.operators import sketches as SK
from tessera.operators import tokens as TK
from tessera.operators.text_classifier import TextClassifier, TextClassifierModel
from tessera.session import scratch_path

TEXTS = ["a--b, c", "", None, "  \t", "x\ny\U0001f600", "it's"]


def test_tokenizers_golden(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id LONG, text STRING")
    df.createOrReplaceTempView("golden_texts")
    register_sql(spark)
    want = {WORDS: [["a", "--", "b", ",", "c"], [], None, [], ["x", "y\U0001f600"], ["it", "'", "s"]],
            SPACED: [["a--b,", "c"], [], None, [], ["x", "y\U0001f600"], ["it's"]],
            CHARACTERS: [list(t) if t is not None else None for t in TEXTS]}
    for t, lists in want.items():
        got = [r.tokens for r in TK.tokenize(df, tokenizer=t).orderBy("doc_id").collect()]
        by_sql = [r.x for r in spark.sql(f"SELECT tokens_{t.name}(text) x FROM golden_texts ORDER BY doc_id").collect()]
        assert got == by_sql == lists


def test_tokenizer_runs_through_the_jobs(spark):
    docs = spark.createDataFrame([(1, "ab ba"), (2, "b\n")], "doc_id LONG, text STRING")
    vocab = TK.with_specials(TK.vocabulary(TK.word_tokens(docs, tokenizer=CHARACTERS)))
    ids = TK.encode(docs, vocab, tokenizer=CHARACTERS)
    assert {r.doc_id: r.ids for r in ids.collect()} == {1: [2, 3, 1, 3, 2], 2: [3, 0]}
    back = TK.decode(ids, vocab, "doc_id", tokenizer=CHARACTERS)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "ab ba", 2: "b\n"}
    assert SQ.token_windows(ids, 2, 2).count() == 2
    stats = TK.corpus_stats(docs, tokenizer=SPACED).first()
    assert (stats.n_docs, stats.n_tokens, stats.vocab_size) == (2, 3, 3)


def test_own_tokenizer_and_its_name(spark):
    digits = Tokenizer("digits", "[0-9]+", lambda t: F.array_join(t, "-"))
    register_sql(spark, digits)
    assert spark.sql("SELECT tokens_digits('a1b22') AS x").first().x == ["1", "22"]
    with pytest.raises(ValueError):
        Tokenizer("no name", ".", digits.joined)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, "good fine day" if i % 2 else "bad awful-day", i % 2) for i in range(24)]
    rows += [(100, None, 1), (101, "", 0), (102, "good", None), (1, "good fine day", 1)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, label INT").withColumn("token", F.lit("clash"))


def test_estimator_equals_the_tables(spark, labelled):
    model = TextClassifier().fit(labelled)
    known = labelled.where("label is not null").fillna("", ["text"]).drop("token")
    tokens = TK.word_tokens(known.drop("label"), "doc_id").join(known.select("doc_id", "label").distinct(), "doc_id")
    plain = CL.train_naive_bayes(tokens, known, "label")
    assert {(r["class"], r.token, r.n) for r in model.fitted.pairs.collect()} \
        == {(r["class"], r.token, r.n) for r in plain.pairs.collect()}
    out = model.transform(labelled)
    assert out.columns == [*labelled.columns, "prediction"]
    got = out.collect()
    assert len(got) == 28  # repeated rows and null texts stay
    assert all(r.prediction == r.label for r in got if r.text and r.label is not None)
    assert model.transform(labelled.limit(0)).count() == 0


def test_estimator_pipeline_save_load_cross_validation(spark, labelled):
    stage = TextClassifier(predictionCol="p")
    grid = ParamGridBuilder().addGrid(stage.smoothing, [0.5, 2.0]).addGrid(stage.tokenizer, ["words", "spaced"]).build()
    judge = MulticlassClassificationEvaluator(predictionCol="p", metricName="accuracy")
    data = labelled.where("doc_id < 24").withColumn("label", F.col("label").cast("double"))
    best = CrossValidator(estimator=Pipeline(stages=[stage]), estimatorParamMaps=grid, evaluator=judge, numFolds=2,
                          seed=3).fit(data)
    assert max(best.avgMetrics) == 1.0
    model = best.bestModel.stages[0]
    path = scratch_path(spark, "text-model")
    model.write().overwrite().save(path)
    loaded = TextClassifierModel.load(path)
    assert loaded.uid == model.uid
    assert loaded.extractParamMap().keys() == model.extractParamMap().keys()
    key = [F.col("doc_id"), F.col("p")]
    assert sorted(loaded.transform(data).select(*key).collect()) == sorted(model.transform(data).select(*key).collect())


def test_model_without_rows_predicts_null(spark, labelled):
    model = TextClassifier().fit(labelled.where("label = 7"))
    assert {r.prediction for r in model.transform(labelled).collect()} == {None}


def _write(spark, rows, path):
    spark.createDataFrame(rows, "text STRING, file STRING").coalesce(1).write.mode("append").parquet(path)


def test_sketches_of_new_files_only(spark):
    corpus, store = scratch_path(spark, "a corpus"), SK.SketchStore(spark, scratch_path(spark, "sketches"))
    _write(spark, [(f"w{i} common", "clash") for i in range(3000)] + [(None, None), ("", None)], corpus)
    assert store.refresh(corpus) == 1 and store.refresh(corpus) == 0
    _write(spark, [(f"w{i} common", "clash") for i in range(2000, 6000)], corpus)
    again = SK.SketchStore(spark, store.path)  # another session goes on from the stored rows
    assert again.refresh(corpus) == 1
    got = again.statistics((0.0, 0.5, 1.0)).first()
    assert (got.n_docs, got.n_tokens) == (7002, 14000)
    assert abs(got.vocab_size / 6001 - 1) <= 3 * SK.VOCAB_ERROR
    assert got.length_quantiles[0] == 0 and got.length_quantiles[2] == 12
    docs = spark.read.parquet(corpus).withColumn("all", F.lit("one"))
    whole = SK.merged(SK.sketch_files(docs, file_col="all")).first()
    assert (whole.n_chars, whole.n_tokens) == (got.n_chars, got.n_tokens)
    assert abs(whole.vocab_size / got.vocab_size - 1) <= SK.VOCAB_ERROR
    assert store.sketches().count() == 2


def test_sketches_by_group_and_of_nothing(spark):
    docs = spark.createDataFrame([("a b", "x"), ("b", "x"), ("c", "y")], "text STRING, file STRING")
    got = {r.file: (r.n_docs, r.vocab_size) for r in SK.merged(SK.sketch_files(docs), "file").collect()}
    assert got == {"x": (2, 2), "y": (1, 1)}
    none = SK.merged(SK.sketch_files(docs.limit(0))).first()
    assert (none.n_docs, none.vocab_size, none.length_quantiles) == (0, 0, None)
