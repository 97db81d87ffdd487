"""Shuffles, splits, balancing, batches, metrics (golden literals + properties)."""

import math

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import metrics as M
from tessera.operators import sampling as SA
from tessera.operators.ranking import global_rank, rank_within_groups


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "row_id")


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i, f"k{(i * 7919) % 1000:04d}") for i in range(1000)], "row_id BIGINT, k STRING")
    got = {r.row_id: r.rank for r in global_rank(df, ["k", "row_id"], num_partitions=7).collect()}
    expect = {rid: i for i, (k, rid) in enumerate(sorted(((f"k{(i * 7919) % 1000:04d}", i) for i in range(1000))))}
    assert got == expect


def test_rank_within_hot_group(spark):
    # one group holds most rows: positions inside each group still dense
    rows = [(i, 0 if i % 10 else 1) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id BIGINT, g INT")
    out = rank_within_groups(df, ["g"], ["row_id"], "r").collect()
    for g in (0, 1):
        rs = sorted((r.row_id, r.r) for r in out if r.g == g)
        assert [r for _, r in rs] == list(range(len(rs)))


def test_three_way_split_sizes(spark):
    out = SA.three_way_split(ids(spark, 1494), "row_id", 123, 0.7, 0.1)
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 1045, "validation": 149, "test": 300}
    assert out.select("row_id").distinct().count() == 1494


def test_float_truncation_in_double(spark):
    out = SA.three_way_split(ids(spark, 100), "row_id", 123, 0.29, 0.0)
    assert out.where(F.col("split") == "train").count() == 28


def test_shuffle_is_a_permutation_and_seeded(spark):
    a = {r.row_id: r.rank for r in SA.shuffled_rank(ids(spark, 300), "row_id", 123).collect()}
    b = {r.row_id: r.rank for r in SA.shuffled_rank(ids(spark, 300), "row_id", 123).collect()}
    c = {r.row_id: r.rank for r in SA.shuffled_rank(ids(spark, 300), "row_id", 7).collect()}
    assert sorted(a.values()) == list(range(300)) and a == b and a != c


def test_balanced_sample_equal_classes(spark):
    rows = [(i, "spam" if i % 5 == 0 else "ham") for i in range(200)]
    df = spark.createDataFrame(rows, "row_id BIGINT, label STRING")
    out = SA.balanced_sample(df, "label", "row_id", 123)
    sizes = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert sizes == {"spam": 40, "ham": 40}


def test_drop_last(spark):
    ranked = ids(spark, 10).withColumnRenamed("row_id", "rank")
    keep = SA.batches(ranked, 4, drop_last=True).groupBy("batch_id").count().orderBy("batch_id").collect()
    full = SA.batches(ranked, 4, drop_last=False).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in keep] == [4, 4]
    assert [r["count"] for r in full] == [4, 4, 2]


def test_loss_weighting_is_per_batch(spark):
    rows = [(0, 1.0)] * 4 + [(1, 3.0)] * 2
    df = spark.createDataFrame(rows, "batch_id BIGINT, nll DOUBLE").withColumn("g", F.lit(1))
    assert M.loss_by(df, ["g"]).first().loss == 2.0


def test_empty_loader_accuracy_null(spark):
    df = spark.createDataFrame([], "batch_id BIGINT, predicted BIGINT, label BIGINT")
    assert M.accuracy_by(df, []).first().accuracy is None


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([([3.0, 2.0, 2.0, 1.0],)], "l ARRAY<DOUBLE>")
    assert df.select(A.top_k_mask(F.col("l"), 2)).first()[0] == [3.0, 2.0, 2.0, float("-inf")]


def test_softmax_and_nll(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "l ARRAY<DOUBLE>")
    p = df.select(A.softmax(F.col("l"))).first()[0]
    assert abs(sum(p) - 1) < 1e-12
    nll = df.select(A.nll(F.col("l"), F.lit(2))).first()[0]
    assert abs(nll - (-math.log(p[2]))) < 1e-12
    assert df.select(A.argmax(F.array(F.lit(1.0), F.lit(5.0), F.lit(5.0)))).first()[0] == 1


def test_uniform_draw_matches_md5_rule(spark):
    import hashlib
    u = spark.range(1).select(A.uniform_from_key(F.lit(123), F.lit(5), F.lit(0))).first()[0]
    h = hashlib.md5(b"123:5:0").hexdigest()
    assert u == int(h[:13], 16) / 2 ** 52


def test_standardize(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v ARRAY<DOUBLE>")
    out = df.select(A.standardize(F.col("v"))).first()[0]
    mean, var = 2.5, 1.25
    assert all(abs(o - (x - mean) / math.sqrt(var + 1e-5)) < 1e-12 for o, x in zip(out, [1, 2, 3, 4]))


def test_running_total_across_partitions(spark):
    from tessera.operators.ranking import running_total
    rows = [(i, 0 if i % 7 else 1, (i * 13) % 5) for i in range(400)]  # group 0 is hot
    df = spark.createDataFrame(rows, "row_id BIGINT, g INT, v BIGINT")
    got = {r.row_id: r.off for r in running_total(df, ["g"], ["row_id"], "v", "off", num_partitions=5).collect()}
    acc, expect = {0: 0, 1: 0}, {}
    for rid, g, v in rows:
        expect[rid] = acc[g]
        acc[g] += v
    assert got == expect
