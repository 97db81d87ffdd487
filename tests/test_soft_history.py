"""Soft history: mergeable accumulators over pairs of row blocks."""

import random

import numpy as np
import pytest

from tessera.operators import vectors as V


def brute(rows, window, heads):
    out = {}
    groups = {}
    for i, g, v in sorted(rows):
        if v is not None:
            groups.setdefault(g, []).append((i, np.array(v)))
    for members in groups.values():
        for at, (i, q) in enumerate(members):
            k = np.stack([v for _, v in members[max(0, at - window + 1):at + 1]])
            width = len(q) // heads
            parts = []
            for h in range(heads):
                s = slice(h * width, (h + 1) * width)
                e = k[:, s] @ q[s] / np.sqrt(width)
                w = np.exp(e - e.max())
                parts.append((w / w.sum()) @ k[:, s])
            out[i] = np.concatenate(parts)
    return out


@pytest.mark.parametrize("window, heads, block", [(1, 1, 4), (5, 2, 4), (16, 1, None), (40, 4, 8), (1024, 2, 16), (1024, 1, None)])
def test_soft_history_equals_brute_force(spark, window, heads, block):
    r = random.Random(window)
    # a hot group, a null group, a null vector, large scores
    rows = [(i, r.choice([1, 1, 1, 2, None]), [r.gauss(0, 6) for _ in range(8)]) for i in range(150)] + [(500, 1, None), (501, 7, [1.0] * 8)]
    df = spark.createDataFrame(rows, "id bigint, g int, v array<double>").repartition(3)
    got = {x.id: x.vec for x in V.soft_history(df, "g", "id", "v", window, heads, block).collect()}
    want = brute([(i, -1 if g is None else g, v) for i, g, v in rows], window, heads)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[i], want[i], atol=1e-9) for i in want)


def test_work_of_a_row_is_bounded(spark, monkeypatch):
    """A long window makes larger blocks, not more accumulators."""
    sizes = []
    parts = V._history_parts
    monkeypatch.setattr(V, "_history_parts", lambda window, heads: sizes.append(window) or parts(window, heads))
    rows = spark.range(3000).selectExpr("id", "1 AS g", "array(id % 7 + 0.0D, 1.0D) AS v")
    out = V.soft_history(rows, "g", "id", "v", 2048)
    assert out.count() == 3000 and sizes == [2048]
    assert max(V.HISTORY_BLOCK, -(-2048 // V.HISTORY_SPAN)) == 128  # 2048 / 128 + 1 pairs a block


def test_heads_must_divide_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 2.0, 3.0])], "id bigint, g int, v array<double>")
    with pytest.raises(Exception, match="do not divide"):
        V.soft_history(df, "g", "id", "v", 4, heads=2).collect()
    assert V.soft_history(df.limit(0), "g", "id", "v", 4).count() == 0
    text = df.selectExpr("'a' AS id", "g", "v")
    assert [x.id for x in V.soft_history(text, "g", "id", "v", 4).collect()] == ["a"]
