"""Numeric array expressions (softmax, dot products, standardization...).

All are higher-order built-ins, so they stay inside whole-stage codegen and
never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(df: DataFrame, keep: list, values: Column | str, pos: str = "pos",
            value: str = "value") -> DataFrame:
    """One row per array element: ``keep`` columns, ``pos`` (from 0), ``value``.

    The outer generator with a filter on the generated position is on purpose:
    a plain ``posexplode`` makes the optimizer infer ``size(values) > 0`` and
    push a second copy of the whole expression below (into the scan or a join
    condition)."""
    out = df.select(*keep, F.posexplode_outer(values).alias(pos, value))
    return out.where(F.col(pos).isNotNull())


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` (a lambda
    binding): without it, a scalar used inside ``transform`` would be
    recomputed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_double(arr: Column) -> Column:
    return F.transform(arr, lambda x: x.cast("double"))


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x * y))


def scaled_dot(a: Column, b: Column) -> Column:
    """q.k / sqrt(d)."""
    return dot(a, b) / F.sqrt(F.size(a).cast("double"))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scale(a: Column, s: Column | float) -> Column:
    s = F.lit(s) if not isinstance(s, Column) else s
    return F.transform(a, lambda x: x * s)


def log_sum_exp(logits: Column) -> Column:
    return let(F.array_max(logits),
               lambda m: m + F.log(array_sum(F.transform(logits, lambda x: F.exp(x - m)))))


def softmax(logits: Column) -> Column:
    def with_max(m):
        ex = F.transform(logits, lambda x: F.exp(x - m))
        return let(array_sum(ex), lambda total: F.transform(ex, lambda x: x / total))
    return let(F.array_max(logits), with_max)


def nll(logits: Column, target: Column) -> Column:
    """-log softmax(logits)[target] (target is 0-based)."""
    return log_sum_exp(logits) - F.element_at(logits, target + F.lit(1))


def argmax(values: Column) -> Column:
    """0-based index of the largest value; ties go to the lowest index."""
    return (F.array_position(values, F.array_max(values)) - F.lit(1)).cast("int")


def top_k_mask(logits: Column, k: int) -> Column:
    """Keep values >= the k-th largest (ties kept), the rest become -inf."""
    kth = F.element_at(F.sort_array(logits, asc=False), F.least(F.lit(k), F.size(logits)))
    return let(kth, lambda t: F.transform(
        logits, lambda x: F.when(x >= t, x).otherwise(F.lit(float("-inf")))))


def standardize(vec: Column, eps: float = 1e-5, scale_: float = 1.0, shift: float = 0.0) -> Column:
    """(x - mean) / sqrt(var_pop + eps) * scale + shift."""
    n = F.size(vec).cast("double")

    def with_mean(mean):
        var = array_sum(F.transform(vec, lambda x: (x - mean) * (x - mean))) / n
        return let(F.sqrt(var + F.lit(eps)), lambda denom: F.transform(
            vec, lambda x: (x - mean) / denom * F.lit(scale_) + F.lit(shift)))
    return let(array_sum(vec) / n, with_mean)


def heads(vec: Column, h: int) -> Column:
    """Split a vector into ``h`` equal slices; a size that ``h`` does not divide
    fails the job (no dimension is ever dropped)."""
    d = F.size(vec)
    width = F.when(d % F.lit(h) == 0, (d / F.lit(h)).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{h} heads do not divide a vector of "), d.cast("string"))).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(h - 1)),
                       lambda k: F.slice(vec, k * width + 1, width))


def uniform_from_key(*parts: Column) -> Column:
    """Seeded uniform draw in [0, 1): the first 13 hex digits of md5 (52 bits)
    of the ':'-joined parts, divided by 2^52.  Same value in any engine."""
    key = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))
