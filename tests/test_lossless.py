"""Nothing is lost: edge cases of sources, vectors and streams."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import metrics as M
from tessera.operators import ngram as NG
from tessera.operators import vectors as V
from tessera.operators.ranking import rank_within_groups
from tessera.session import scratch_path
from tessera.sources import files as FS
from tessera.streaming import scoring as SS

TEXTS = [" lead", "trail ", "", None, "  ", 'say "hi", ok', "a\r\nb", "line\nbreak", "plain", ",", '"', "\ttab"]


def _key(rows):
    return sorted(rows, key=repr)


def test_labelled_csv_keeps_every_text(spark):
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(TEXTS)], "Label INT, Text STRING")
    path = scratch_path(spark, "lossless-csv")
    FS.write_labelled_csv(df, path)
    back = FS.read_labelled_csv(spark, path).collect()
    assert _key((r.Label, r.Text) for r in back) == _key((i % 2, t) for i, t in enumerate(TEXTS))


def test_csv_split_sink_keeps_every_text(spark):
    rows = [(i % 2, t, FS.SPLIT_NAMES[i % 3]) for i, t in enumerate(TEXTS)]
    path = scratch_path(spark, "lossless-splits")
    FS.write_csv_splits(spark.createDataFrame(rows, "Label INT, Text STRING, split STRING"), path)
    back = FS.read_csv_splits(spark, path).collect()
    assert _key((r.Label, r.Text, r.split) for r in back) == _key(rows)


def test_label_tsv_keeps_edges(spark):
    df = spark.createDataFrame([("ham", t) for t in TEXTS], "Label STRING, Text STRING")
    path = scratch_path(spark, "lossless-tsv")
    FS.write_label_tsv(df, path)
    back = sorted(r.Text for r in FS.read_label_tsv(spark, path).collect())
    want = [(t or "") for t in TEXTS]
    for c in "\t\n\r":  # the format holds none of these
        want = [t.replace(c, " ") for t in want]
    assert back == sorted(want)


def _text_files(spark, rows, path):
    FS.write_text_per_key(spark.createDataFrame(rows, "k STRING, text STRING"), "k", "text", path)
    back = FS.read_text_files(spark, path).select(FS.key_of_path("path", "k").alias("k"),
                                                  FS.strip_written_newline("text").alias("text"))
    return _key((r.k, r.text) for r in back.collect())


def test_text_files_keep_every_key_and_text(spark):
    texts = TEXTS + ["\r\n", "\n\n", "é\u2028"]
    keys = ["1", "007", "a b/c", "%41", "+%2B", ".x", "_y", "é=ü", "8.txt", "x:y", "?", "#"]
    rows = [(k, texts[i % len(texts)]) for i, k in enumerate(keys)] + [(f"t{i}", t) for i, t in enumerate(texts)]
    # rows of one key share its file; an empty key is a null one
    rows += [("dup", "p")] * 2 + [(None, "n"), ("", "n")]
    want = _key([(k, t or "") for k, t in rows[:-4]] + [("dup", "p\np"), (None, "n\nn")])
    path = scratch_path(spark, "lossless + 100% é")
    assert path.startswith("file:")
    assert _text_files(spark, rows, path) == want
    assert _text_files(spark, rows[:3], path) == _key((k, t or "") for k, t in rows[:3])  # replaces what was there
    # Spark's own writer, for stores of another kind
    assert _text_files(spark, rows, scratch_path(spark, "lossless-text").removeprefix("file:")) == want


def test_text_files_cost_no_folder_and_no_side_file_each(spark):
    path = scratch_path(spark, "many-texts")
    n = 4 * FS.FOLDERS
    df = spark.range(n).select(F.col("id").alias("k"), F.col("id").cast("string").alias("text"))
    FS.write_text_per_key(df, "k", "text", path)
    found = list(os.walk(path.removeprefix("file:")))
    assert len(found) - 1 <= FS.FOLDERS
    assert sorted(name for _, _, names in found for name in names) == sorted(f"k={i}.txt" for i in range(n))
    back = FS.read_text_files(spark, path).select(FS.key_of_path("path", "k"), FS.strip_written_newline("text"))
    assert sorted(map(tuple, back.collect())) == sorted((str(i), str(i)) for i in range(n))


def test_text_files_are_listed_by_the_tasks(spark, monkeypatch):
    """The driver holds no name of a file; rows, paths and folders are those of Spark's reader."""
    path = scratch_path(spark, "listed + 100% é\u2003")
    keys = ["x", "a b/c", "%41", "é=ü", "#", None, *map(str, range(300))]
    FS.write_text_per_key(spark.createDataFrame([(k, f"{k}\u00e9") for k in keys], "`k é` STRING, text STRING"), "k é", "text", path)
    root = path.removeprefix("file:")
    folder = next(os.scandir(root)).path
    for name in (".hidden", "_side", "k é=empty.txt"):  # none of them is read
        open(f"{folder}/{name}", "w").write("" if name.startswith("k") else "x")
    monkeypatch.setattr(FS, "PIECE_FILES", 1)  # a folder in several pieces
    back = FS.read_text_files(spark, path)
    assert back.inputFiles() == [] and back.columns == ["path", "text", "folder"]
    own = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path"), "value", "folder")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, own.collect())) and back.count() == len(keys)
    # a folder that holds anything else is left to Spark's reader
    os.makedirs(f"{root}/folder=0", exist_ok=True)
    open(f"{root}/folder=0/other", "w").write("x")
    back = FS.read_text_files(spark, path)
    assert back.inputFiles() and back.count() == len(keys) + 1


def test_a_text_file_of_a_stopped_attempt_is_replaced(spark):
    path = scratch_path(spark, "stopped-texts")
    root = path.removeprefix("file:")
    df = spark.createDataFrame([(0, "1", b"one"), (0, "2", b"two")], "folder INT, key STRING, text BINARY").coalesce(1)

    def stopped(rows):
        def broken():
            yield next(rows)
            raise ValueError("lost")
        try:
            FS._file_writer(root, "k")(broken())
        except ValueError:
            pass
    df.foreachPartition(stopped)
    assert FS.read_text_files(spark, path).count() == 0  # half a file is never read
    df.foreachPartition(FS._file_writer(root, "k"))
    back = FS.read_text_files(spark, path).select(FS.key_of_path("path", "k"), "text").collect()
    assert sorted(map(tuple, back)) == [("1", "one\n"), ("2", "two\n")]


def test_heads_must_divide_the_vector(spark):
    df = spark.createDataFrame([([1.0] * 7,)], "v ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="do not divide"):
        df.select(A.heads(F.col("v"), 3)).collect()
    assert len(df.select(A.heads(F.col("v"), 7).alias("h")).first().h) == 7


def test_embedding_ids_need_not_be_dense(spark):
    vecs = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.0, 1.0]), (2, [4.0, 4.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    counts = spark.createDataFrame([(1, 0, 2), (1, 1, 1), (2, 5, 1)], "doc_id BIGINT, token_id BIGINT, c BIGINT")
    got = {r.doc_id: r.vec for r in V.pooled_token_embeddings(counts, vecs).collect()}
    table = [[4.0, 4.0], [1.0, 0.0], [0.0, 1.0]]  # rows in id order

    def want(tokens):
        total = [0.0, 0.0]
        for p, t in enumerate(tokens):
            total = [x + a + b for x, a, b in zip(total, table[t % 3], table[p % 3])]
        return [x / len(tokens) for x in total]
    assert got[1] == pytest.approx(want([0, 0, 1])) and got[2] == pytest.approx(want([5]))


def test_report_of_an_empty_split(spark):
    rows = spark.createDataFrame([("train", 0, 1, 1, 0.5), ("train", 0, 1, 0, 1.5), ("train", 1, 1, 1, 4.0)],
                                 "split STRING, batch_id BIGINT, predicted BIGINT, label BIGINT, nll DOUBLE")
    got = {r.split: r for r in M.report(M.batch_table(rows)).collect()}
    assert (got["train"].n, got["train"].n_batches, got["train"].loss) == (3, 2, 2.5)
    assert got["train"].accuracy == pytest.approx(2 / 3)
    assert got["test"].n == 0 and got["test"].accuracy is None and got["test"].loss != got["test"].loss


def test_unknown_label_has_infinite_loss(spark):
    head = spark.createDataFrame([(3, [1.0], 0.0), (5, [2.0], 0.0)], "class bigint, w array<double>, b double")
    df = spark.createDataFrame([(1, [1.0], 5), (2, [1.0], 9)], "vec_id BIGINT, v ARRAY<DOUBLE>, label BIGINT")
    got = {r.vec_id: r for r in M.predictions(M.with_logits(df, head, "v")).collect()}
    assert got[1].predicted == 5 and got[2].nll == float("inf") and got[1].nll < 1


def test_temperature_zero_is_greedy_and_stops(spark):
    counts = spark.createDataFrame([("a", "b", 3), ("a", "c", 3), ("b", "<|end|>", 2), ("<|end|>", "a", 1)],
                                   "context STRING, next STRING, n BIGINT")
    prompts = spark.createDataFrame([(0, ["x", "a"])], "item_id BIGINT, tokens ARRAY<STRING>")
    out = NG.generate_sampled(prompts, counts, "z", 4, 25, 0.0, 1, stop_token="<|end|>").first().new_tokens
    assert out == ["b"]
    assert NG.generate_sampled(prompts, counts, "z", 2, 25, 0.0, 1).first().new_tokens == ["b", "<|end|>"]
    with pytest.raises(ValueError):
        NG.generate_sampled(prompts, counts, "z", 1, 25, -1.0, 1)


def test_rank_within_a_hot_and_a_null_group(spark):
    rows = [("hot", i) for i in range(900)] + [(None, i) for i in range(50)] + [(f"g{i % 40}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "g STRING, i BIGINT")
    got = rank_within_groups(df, ["g"], ["i"], "r").collect()
    assert len(got) == len(rows)
    seen = {}
    for r in sorted(got, key=lambda r: r.i):
        assert r.r == seen.get(r.g, 0)
        seen[r.g] = r.r + 1


def test_naive_bayes_with_many_classes(spark):
    import math
    from collections import Counter

    from tessera.functions import text as T
    from tessera.operators import classify as CL
    n = 1500  # more than one block of classes
    rows = [(i, f"w{i % 40} w{i % 7} common" + (" w3 w3" if i % 5 == 0 else ""), i % n) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, class BIGINT")
    toks = A.rows_of(df, ["doc_id", "class"], T.word_tokens("text"), value="token")
    model = CL.train_naive_bayes(toks, df, "class")
    probes = [(0, "w3 w3 w3"), (1, "common w5 w39"), (2, "zzz"), (3, ""), (4, "w1 " * 30)]
    test = spark.createDataFrame(probes, "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.predicted for r in CL.classify_naive_bayes(
        model, A.rows_of(test, ["doc_id"], T.word_tokens("text"), value="token"), test).collect()}
    words = {c: Counter() for c in range(n)}
    for _, t, c in rows:
        words[c].update(t.split())
    vocab = set().union(*words.values())
    for i, t in probes:
        known = [w for w in t.split() if w in vocab]
        scores = [math.log(1 / n) + sum(math.log((words[c][w] + 1) / (sum(words[c].values()) + len(vocab))) for w in known)
                  for c in range(n)]
        assert scores[got[i]] == pytest.approx(max(scores)), i
