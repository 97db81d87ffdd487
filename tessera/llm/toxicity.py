"""Counterfactual-regularised toxicity classifier.

A logistic model on the presence of words and word beginnings.  Every labelled
training text that names an identity group is paired with a copy in which the
group terms are swapped for others; the squared difference of the two scores
(as logits) is added to the loss, so a neutral mention of a group cannot carry
the score.

The model is fitted on a bounded sample of labelled rows (``max_rows``, drawn
by a hash of the id); its features are chosen from counts that Spark gathers
over that sample, and the driver holds only the chosen feature numbers of the
sample rows (bounded by ``max_rows`` and ``max_features``).  Scoring covers
every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_text, released, spread, stored, text_slices
from tessera.llm.textkernel import ALNUM, word_hashes

#: Groups whose terms are swapped for one another (neutral mentions).
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "elderly", "young"),
)
#: Lengths in bytes of the word beginnings that count as features.
PREFIXES = (4, 5)
_BLOOM = 1 << 16


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def _features(buf: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all distinct features of each text; with
    ``wanted`` (sorted) only those, as their numbers."""
    h, at, pre = word_hashes(buf, offsets, ALNUM, PREFIXES)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    docs, feats = [], []
    if wanted is not None:
        low = np.zeros(_BLOOM, bool)
        low[wanted & np.uint64(_BLOOM - 1)] = True
    for f in (h, *pre):
        if wanted is None:
            on = f != 0
            docs.append(doc[on])
            feats.append(f[on])
        else:
            on = np.flatnonzero(low[f & np.uint64(_BLOOM - 1)])
            i = np.searchsorted(wanted, f[on])
            i[i == len(wanted)] = 0
            hit = wanted[i] == f[on] if len(wanted) else np.zeros(len(on), bool)
            docs.append(doc[on[hit]])
            feats.append(i[hit])
    d, f = np.concatenate(docs), np.concatenate(feats)
    if not len(d):
        return d, f
    order = np.lexsort((f, d))
    d, f = d[order], f[order]
    new = np.append(True, (d[1:] != d[:-1]) | (f[1:] != f[:-1]))
    return d[new], f[new]


def _support(toxic_only: bool, wanted: np.ndarray | None) -> Callable:
    """Per task: documents with each feature (of one class)."""
    schema = pa.schema([("feature", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            y = b.column(2).to_numpy()
            for buf, offsets, lo, hi in text_slices(b):
                d, f = _features(buf, offsets, wanted)
                keep = y[lo:hi][d] == (1 if toxic_only else 0)
                u, n = np.unique(f[keep], return_counts=True)
                u = u.view(np.int64) if wanted is None else u.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], schema=schema)
    return run


def swap_terms(text: str, groups: tuple[tuple[str, ...], ...]) -> str | None:
    """The text with every identity term replaced by the next of its group; None without any."""
    nxt = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if not nxt:
        return None
    found = re.compile(r"\b(?:" + "|".join(map(re.escape, nxt)) + r")\b", re.IGNORECASE)
    out, n = found.subn(lambda m: nxt[m.group().lower()], text)
    return out if n else None


def _examples(wanted: np.ndarray, groups) -> Callable:
    schema = pa.schema([("y", pa.int32()), ("on", pa.list_(pa.int32())), ("swapped", pa.list_(pa.int32()))])

    def numbers(text: str) -> list[int]:
        raw = np.frombuffer(text.encode(), np.uint8)
        return _features(raw, np.array([0, len(raw)], np.int64), wanted)[1].tolist()

    def run(batches):
        for b in batches:
            rows = []
            for text, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                other = swap_terms(text, groups)
                rows.append((y, numbers(text), None if other is None else numbers(other)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                                  zip(zip(*rows), schema, strict=True)], schema=schema)
    return run


def _g2(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> np.ndarray:
    """Log-likelihood ratio of a feature's counts in the two classes."""
    total = (a + b) / (na + nb)

    def part(k, e):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    return 2 * (part(a, na * total) + part(b, nb * total) + part(na - a, na * (1 - total))
                + part(nb - b, nb * (1 - total)))


def fit_logistic(x: np.ndarray, y: np.ndarray, gaps: np.ndarray, swap_penalty: float, ridge: float = 0.02,
                 rounds: int = 25) -> tuple[np.ndarray, float]:
    """Newton steps for: log loss + ridge |w|^2 / 2 + swap_penalty sum((gap . w)^2) / 2."""
    n, k = x.shape
    a = np.hstack([x, np.ones((n, 1), x.dtype)])
    fixed = np.zeros((k + 1, k + 1))
    fixed[:k, :k] = swap_penalty * (gaps.T @ gaps) + ridge * np.eye(k)
    fixed[k, k] = 1e-6
    w = np.zeros(k + 1)
    w[k] = np.log((y.sum() + 1) / (len(y) - y.sum() + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + fixed @ w
        hess = (a.T * np.maximum(p * (1 - p), 1e-6)) @ a + fixed
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-3:
            break
    return w[:k], float(w[k])


def fit(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5, max_rows: int = 20_000,
        max_features: int = 256, min_support: int = 3, swap_penalty: float = 1.0,
        groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """Fit on at most about ``max_rows`` labelled rows, drawn by a hash of the
    id, whose ``crc32(id as text) mod held_out_mod`` is not 0.  Only text and
    label are used.  Null labels, ids and texts are left out; of an id labelled
    twice the larger label counts.  Without labelled rows the model is a
    constant below one half."""
    given = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id is not null and toxic is not null")
             .where(F.crc32(F.col("doc_id").cast("string")) % held_out_mod != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = given.count()
    share = min(1.0, max_rows / max(total, 1))
    drawn = given.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
                    .join(F.broadcast(drawn), "doc_id"), "labelled")  # the sample's ids: bounded by max_rows
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    na, nb = sizes.get(1, 0), sizes.get(0, 0)
    constant = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((na + 1) / (nb + 2))))
    if not na or not nb:
        return constant
    counts = "feature long, n long"
    toxic = (sample.mapInArrow(released(_support(True, None)), counts).groupBy("feature").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= min_support).orderBy(F.desc("n"), "feature").limit(100 * max_features).collect())
    if not toxic:
        return constant
    seen = np.array([r["feature"] for r in toxic], np.int64).view(np.uint64)
    a = np.array([r["n"] for r in toxic], np.float64)
    order = np.argsort(seen)
    seen, a = seen[order], a[order]
    b = np.zeros(len(seen))
    for r in sample.mapInArrow(_support(False, seen), counts).groupBy("feature").agg(F.sum("n").alias("n")).collect():
        b[r["feature"]] = r["n"]
    g = np.where(a / na > b / nb, _g2(a, b, na, nb), 0)
    telling = (g > 10.8) & (a / (a + b) > 0.5)  # p < 0.001, and mostly in toxic texts
    best = np.sort(np.argsort(-np.where(telling, g, 0), kind="stable")[:min(max_features, int(telling.sum()))])
    if not len(best):
        return constant
    wanted = seen[best]
    rows = sample.mapInArrow(released(_examples(wanted, groups)), "y int, on array<int>, swapped array<int>").collect()
    x = np.zeros((len(rows), len(wanted)), np.float32)
    gaps = []
    for i, r in enumerate(rows):
        x[i, r["on"]] = 1
        if r["swapped"] is not None:
            gap = x[i].copy()
            gap[r["swapped"]] -= 1
            if gap.any():
                gaps.append(gap)
    y = np.array([1.0 if r["y"] == 1 else 0.0 for r in rows])
    w, bias = fit_logistic(x, y, np.array(gaps, np.float32).reshape(-1, len(wanted)), swap_penalty)
    return Model(wanted, w, bias)


def _score(model: Model) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for buf, offsets, lo, hi in text_slices(b):
                d, f = _features(buf, offsets, model.features)
                z = np.bincount(d, weights=model.weights[f], minlength=hi - lo) + model.bias
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], schema=schema)
    return run


def score(docs: DataFrame, model: Model, held_out_mod: int = 5) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1),
    ``predicted`` (score >= 0.5).  Null and empty texts score the model's
    base rate; a null id is not held out; repeated rows are scored each; other
    columns are not read."""
    rows = spread(id_text(docs)).mapInArrow(released(_score(model)), "doc_id long, score double")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out_mod == 0, F.lit(False))
    return rows.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
