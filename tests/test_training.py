"""Step-by-step training, the head as a table, epoch permutations, file positions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import epochs as EP
from tessera.operators import metrics as M
from tessera.operators import positions as PO
from tessera.operators import training as TR
from tessera.session import scratch_path


def vectors(spark, n, seed=1, dims=3, classes=(0, 1, 2)):
    r = random.Random(seed)
    rows = [(i, [r.gauss(c, 0.5) for _ in range(dims)], c) for i in range(n) for c in [r.choice(classes)]]
    return rows, spark.createDataFrame(rows, "vec_id bigint, v array<double>, label bigint")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 100, 1025])
def test_epochs_are_permutations(spark, n):
    rows = spark.range(n).select(F.col("id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("e"))
    got = rows.select("e", EP.place_in_epoch(F.col("id"), n, 5, F.col("e")).alias("p")).collect()
    first, second = ([r.p for r in got if r.e == e] for e in (0, 1))
    assert sorted(first) == sorted(second) == list(range(n))
    assert n < 16 or (first != second and first != sorted(first))


def test_epoch_batches_resume_without_a_shuffle(spark):
    rows = spark.range(50).withColumnRenamed("id", "r")
    whole = EP.epoch_batches(rows, "r", 50, 8, 3, 4)
    rest = EP.epoch_batches(rows, "r", 50, 8, 3, 4, from_step=15)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    assert {r.step for r in whole.collect()} == set(range(24))  # 6 full batches an epoch
    assert sorted(map(tuple, rest.collect())) == sorted(tuple(r) for r in whole.collect() if r.step >= 15)
    assert {r.batch_id for r in EP.epoch_batches(rows, "r", 50, 8, 3, 1, drop_last=False).collect()} == set(range(7))
    assert EP.epoch_batches(rows, "r", 50, 8, 3, 4, from_step=24).count() == 0


def test_fetch_reads_one_file_of_many(spark):
    path = scratch_path(spark, "positions")
    spark.range(100).repartitionByRange(5, "id").write.parquet(path)
    table = spark.read.parquet(path)
    index = PO.file_index(table)
    assert PO.size(index) == 100 and index.count() == 5
    numbered = PO.with_row_id(table, index)
    assert sorted(r.row_id for r in numbered.collect()) == list(range(100))
    assert "hashpartitioning" not in numbered._jdf.queryExecution().executedPlan().toString()
    by_row = {r.row_id: r.id for r in numbered.collect()}
    for k in (0, 19, 20, 57, 99):
        row = PO.fetch(spark, index, k)
        assert [(r.row_id, r.id) for r in row.collect()] == [(k, by_row[k])]
        assert len(row.inputFiles()) == 1
    assert PO.fetch(spark, index, 100).count() == 0 and PO.fetch(spark, index, -1).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_head_of_many_classes(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(M, "BROADCAST_VALUES", 0)
    r = random.Random(3)
    heads = [(c, [r.gauss(0, 1), r.gauss(0, 1)], r.gauss(0, 1)) for c in range(10_000)]
    head = spark.createDataFrame(heads, "class bigint, w array<double>, b double").repartition(4)
    rows = [(i, [r.gauss(0, 1), r.gauss(0, 1)], r.randrange(10_000)) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<double>, label bigint")
    scored = M.predictions(M.with_logits(df, head, "v"))
    assert "10000" not in scored._jdf.queryExecution().analyzed().toString()  # no literal model
    for got in scored.collect():
        _, v, label = rows[got.vec_id]
        logits = np.array([w[0] * v[0] + w[1] * v[1] + b for _, w, b in heads])
        assert got.classes == list(range(10_000)) and got.predicted == int(np.argmax(logits))
        assert got.nll == pytest.approx(math.log(np.exp(logits - logits.max()).sum()) + logits.max() - logits[label])


def test_training_equals_a_direct_computation(spark):
    rows, df = vectors(spark, 61)
    held, hdf = vectors(spark, 17, seed=2)
    trace, state = TR.train_head(df, hdf, "vec_id", "v", "label", epochs=2, batch_size=8, seed=9, eval_freq=3, eval_batches=2)
    n = len(rows)
    place = {r.row: (r.a, r.b) for r in spark.range(n).select(
        F.col("id").alias("row"), EP.place_in_epoch(F.col("id"), n, 9, 0).alias("a"),
        EP.place_in_epoch(F.col("id"), n, 9, 1).alias("b")).collect()}
    x = np.array([v + [1.0] for _, v, _ in rows])
    y = np.array([c for _, _, c in rows])
    hx, hy = np.array([v + [1.0] for _, v, _ in held]), np.array([c for _, _, c in held])
    w, m, v = np.zeros((3, 4)), np.zeros((3, 4)), np.zeros((3, 4))
    opt, want, t = TR.AdamW(), [], 0

    def softmax(z):
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def measured(xs, ys):
        p = [softmax(a @ w.T) for a in xs]
        loss = np.mean([np.mean(-np.log(q[np.arange(len(b)), b])) for q, b in zip(p, ys, strict=True)])
        right = np.concatenate([q.argmax(axis=1) == b for q, b in zip(p, ys, strict=True)])
        return loss, right.mean()

    for epoch in range(2):
        order = [r for _, r in sorted((place[r][epoch], r) for r in range(n))]
        batches = [order[i * 8:i * 8 + 8] for i in range(n // 8)]
        for b in batches:
            p = softmax(x[b] @ w.T)
            p[np.arange(8), y[b]] -= 1
            g = p.T @ x[b] / 8
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w * (1 - opt.rate * opt.decay) - opt.rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + opt.eps)
            if (t - 1) % 3 == 0:
                losses = [measured([x[c] for c in batches[:2]], [y[c] for c in batches[:2]])[0],
                          measured([hx[:8], hx[8:16]], [hy[:8], hy[8:16]])[0]]
                want.append(("step", epoch, t - 1, t * 8, *losses, None, None))
        accs = [measured([x[c] for c in batches[:2]], [y[c] for c in batches[:2]])[1],
                measured([hx[:8], hx[8:16]], [hy[:8], hy[8:16]])[1]]
        want.append(("epoch", epoch, t - 1, t * 8, None, None, *accs))
    got = sorted(map(tuple, trace.collect()), key=lambda r: (r[2], r[0] == "epoch"))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=lambda r: (r[2], r[0] == "epoch")), strict=True):
        assert a[:4] == b[:4] and all((p is None) == (q is None) and (p is None or p == pytest.approx(q, abs=1e-9))
                                      for p, q in zip(a[4:], b[4:], strict=True))
    final = {r["class"]: r.w for r in state.collect()}
    assert np.allclose([final[c] for c in range(3)], w, atol=1e-9)


def test_training_of_empty_splits(spark):
    _, df = vectors(spark, 20)
    none = df.limit(0)
    trace, _ = TR.train_head(df, none, "vec_id", "v", "label", epochs=1, batch_size=10, seed=1, eval_freq=1, eval_batches=1)
    steps = [r for r in trace.collect() if r.event == "step"]
    assert len(steps) == 2 and all(math.isnan(r.validation_loss) and r.train_loss > 0 for r in steps)
    trace, state = TR.train_head(none, df, "vec_id", "v", "label", epochs=1, batch_size=10, seed=1, eval_freq=1, eval_batches=1)
    assert state.count() == 0 and [r.event for r in trace.collect()] == ["epoch"]
