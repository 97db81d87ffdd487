"""Exact splits and samples by bounds on the shuffled key."""

import hashlib

import pytest

from tessera.operators import sampling as SA


def key(i, seed=123):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.mark.parametrize("few, digits", [(10_000, 3), (0, 3), (0, 1), (3, 2)])
def test_key_bounds(spark, monkeypatch, few, digits):
    monkeypatch.setattr(SA, "FEW", few)
    monkeypatch.setattr(SA, "DIGITS", digits)
    keys = sorted(key(i) for i in range(300))
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    want = [0, 1, 17, 150, 299, 300]
    for p, bound in zip(want, SA.key_bounds(df, "k", lambda n: want if n == 300 else []), strict=True):
        assert sum(k < bound for k in keys) == p
    assert SA.key_bounds(df.limit(0), "k", lambda n: [n, n]) == ["g", "g"]


def test_split_sorts_and_exchanges_no_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    out = SA.three_way_split(df, "row_id", 123, 0.7, 0.1)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    order = sorted(range(1000), key=key)
    got = {r.row_id: r.split for r in out.collect()}
    assert got == {i: "train" if k < 700 else "validation" if k < 800 else "test" for k, i in enumerate(order)}
    twice = SA.three_way_split(df.union(df), "row_id", 123, 0.5, 0.0)  # repeated ids stay together
    assert twice.select("row_id", "split").distinct().count() == 1000
    assert SA.three_way_split(df.limit(0), "row_id", 1, 0.7, 0.1).count() == 0


@pytest.mark.parametrize("digits", [1, 3])
def test_balanced_sample_takes_the_first_of_each_class(spark, monkeypatch, digits):
    monkeypatch.setattr(SA, "DIGITS", digits)
    classes = {i: None if i % 50 == 0 else "hot" if i % 3 else "c" + str(i % 4) for i in range(900)}
    df = spark.createDataFrame(list(classes.items()), "row_id bigint, label string")
    out = SA.balanced_sample(df, "label", "row_id", 123)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
    members = {}
    for i, c in classes.items():
        members.setdefault(c, []).append(i)
    size = min(map(len, members.values()))
    want = sorted(i for m in members.values() for i in sorted(m, key=key)[:size])
    assert sorted(r.row_id for r in out.collect()) == want and out.columns == ["row_id", "label"]
    assert SA.balanced_sample(df.limit(0), "label", "row_id", 1).count() == 0
