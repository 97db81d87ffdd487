"""Epoch shuffles by arithmetic: a keyed permutation of 0..n-1.

A row's place in any epoch is a function of (seed, epoch, row number): no
order is built, nothing is shuffled, and a run that stops at step k goes on
from there by computing which rows the remaining steps hold.

The permutation is a four-round mixing of the two digits of the row number in
a mixed base a x b >= n, a = ceil(sqrt(n)), each round adding a keyed hash of
one digit to the other.  Places from n on are walked on until one below n
comes up, which keeps it a permutation of 0..n-1.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays as A

ROUNDS = 4
#: Walks after which a place still out of range fails the job; below 1,024 rows
#: a walk cannot be that long, above its chance is under 2^-80 a row.
WALKS = 33


def base(n: int) -> tuple[int, int]:
    """(a, b): the smallest a with a * a >= n, and b = ceil(n / a)."""
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _hash(key: Column, number: int, digit: Column) -> Column:
    raw = F.md5(F.concat_ws(":", key, F.lit(str(number)), digit.cast("string")))
    return F.conv(F.substring(raw, 1, 8), 16, 10).cast("bigint")


def _mixed(place: Column, key: Column, a: int, b: int) -> Column:
    def step(number, high, low):
        if number > ROUNDS:
            return high * F.lit(b) + low
        if number % 2:
            return A.let((high + _hash(key, number, low)) % F.lit(a), lambda x: step(number + 1, x, low))
        return A.let((low + _hash(key, number, high)) % F.lit(b), lambda x: step(number + 1, high, x))
    return A.let(F.floor(place / F.lit(b)).cast("bigint"), lambda h: step(1, h, place % F.lit(b)))


def place_in_epoch(row: Column, n: int, seed: int, epoch: Column | int) -> Column:
    """Place (0..n-1) in the epoch of the row with number ``row`` (0..n-1)."""
    a, b = base(n)
    key = F.concat_ws(":", F.lit(str(seed)), (epoch if isinstance(epoch, Column) else F.lit(epoch)).cast("string"))
    start = _mixed(row.cast("bigint"), key, a, b)
    if a * b == n:
        return start
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(min(WALKS, a * b - n))), start,
                         lambda at, _: F.when(at < n, at).otherwise(_mixed(at, key, a, b)))
    return A.let(walked, lambda at: F.when(at < n, at).otherwise(
        F.raise_error(F.lit("place out of range")).cast("bigint")))


def epoch_batches(rows: DataFrame, row_col: str, n: int, batch_size: int, seed: int, epochs: int,
                  drop_last: bool = True, from_step: int = 0) -> DataFrame:
    """``rows`` once per epoch with ``epoch``, ``place``, ``batch_id`` and ``step``
    (batches counted over all epochs), from step ``from_step`` on."""
    per_epoch = n // batch_size if drop_last else -(-n // batch_size)
    first = from_step // per_epoch if per_epoch else 0
    if first >= epochs:
        first, rows = 0, rows.limit(0)
    out = rows.withColumn("epoch", F.explode(F.sequence(F.lit(first), F.lit(epochs - 1))))
    out = out.withColumn("place", place_in_epoch(F.col(row_col), n, seed, F.col("epoch")))
    out = out.withColumn("batch_id", F.floor(F.col("place") / F.lit(batch_size)).cast("bigint"))
    out = out.withColumn("step", F.col("epoch").cast("bigint") * F.lit(per_epoch) + F.col("batch_id"))
    return out.where((F.col("batch_id") < per_epoch) & (F.col("step") >= from_step))
