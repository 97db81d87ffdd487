"""Seeded shuffles, exact splits, balanced samples and batches.

Randomness is a pure function of (seed, row id): the order key is
``md5('<seed>:<row id>')``, so every engine and every recomputation after an
executor loss sees the same order.  Positions come from the distributed rank
(no single-partition window).

Splits and samples rank nothing: which rows are the first p of a shuffled
order is decided by one bound on the key.  The bound is found exactly by
histograms of the key's leading digits, each round looking only into the one
bucket that the bound falls in, so no row is sorted or exchanged.  Rows of one
id have one key and stay on one side of a bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranking import global_rank
from tessera.session import materialize


def shuffle_key(seed: int, row_id: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def shuffled_rank(df: DataFrame, row_id: str, seed: int, rank_col: str = "rank") -> DataFrame:
    """Full seeded shuffle: 0-based position of each row."""
    keyed = df.withColumn("_key", shuffle_key(seed, row_id))
    return global_rank(keyed, ["_key", row_id], rank_col).drop("_key")


#: Hex digits of the key that a round of the search for a bound looks at.
DIGITS = 3
#: Rows of a bucket that are few enough to finish the search on their keys.
FEW = 10_000
#: Classes up to which the bounds of a sample are broadcast.
BROADCAST_CLASSES = 1_000_000


def key_bounds(keyed: DataFrame, key: str, positions: Callable[[int], list[int]]) -> list[str]:
    """For each of ``positions(n)``, n being the number of rows, a bound such
    that so many rows have a smaller key.  Keys are 32 hex digits.  At most
    16 ** DIGITS counts or ``FEW`` keys per position reach the driver in a round."""
    def counted(prefixes: list[str], digits: int) -> dict[str, int]:
        some = keyed.where(F.substring(key, 1, digits - DIGITS).isin(prefixes)) if prefixes else keyed
        rows = some.groupBy(F.substring(key, 1, digits).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r["b"]: r["n"] for r in rows}

    counts = counted([], DIGITS)
    want = positions(sum(counts.values()))
    bounds: dict[int, str] = {}
    open_ = {i: ("", p) for i, p in enumerate(want)}  # position -> (prefix, rows still to pass in it)
    digits = DIGITS
    while open_:
        few: dict[int, tuple[str, int]] = {}
        for i, (prefix, need) in list(open_.items()):
            del open_[i]
            bounds[i] = prefix + "g"  # behind every key that starts so
            for b in sorted(x for x in counts if x.startswith(prefix)):
                if need <= 0 or (need < counts[b] and digits >= 32):
                    bounds[i] = b
                    break
                if need < counts[b]:
                    (few if counts[b] <= FEW else open_)[i] = (b, need)
                    break
                need -= counts[b]
        if few:
            rows = keyed.where(F.substring(key, 1, digits).isin(sorted({b for b, _ in few.values()}))).select(key).collect()
            keys = sorted(r[0] for r in rows)
            for i, (b, need) in few.items():
                bounds[i] = [k for k in keys if k.startswith(b)][need]
        if open_:
            digits += DIGITS
            counts = counted(sorted({b for b, _ in open_.values()}), digits)
    return [bounds[i] for i in range(len(want))]


def three_way_split(df: DataFrame, row_id: str, seed: int, train_frac: float,
                    validation_frac: float, split_col: str = "split") -> DataFrame:
    """Exact sizes: train_end = int(n*train_frac), validation_end = train_end +
    int(n*validation_frac) (DOUBLE arithmetic), the rest is test."""
    def ends(n: int) -> list[int]:
        train = int(n * float(train_frac))
        return [train, train + int(n * float(validation_frac))]

    key = shuffle_key(seed, row_id)
    train, validation = key_bounds(df.select(key.alias("_key")), "_key", ends)
    return df.withColumn(split_col, F.when(key < train, "train").when(key < validation, "validation").otherwise("test"))


def balanced_sample(df: DataFrame, label_col: str, row_id: str, seed: int) -> DataFrame:
    """Undersample every class to the size of the smallest one, taking each
    class's rows in seeded shuffled order (k classes; two-class = the studied
    ham/spam rule).  The bounds of all classes are a table, refined together;
    a null class is a class."""
    keyed = df.withColumn("_key", shuffle_key(seed, row_id)).withColumn("_class", F.struct(label_col))

    def by_class(bounds: DataFrame) -> DataFrame:
        return F.broadcast(bounds) if bounds.count() <= BROADCAST_CLASSES else bounds

    rows = keyed.select("_class", "_key")
    smallest = rows.groupBy("_class").count().agg(F.min("count")).first()[0] or 0
    found = None
    for digits in range(DIGITS, 33, DIGITS):
        size = min(digits, 32)
        here = rows if found is None else rows.join(by_class(found), "_class").where(
            F.col("_open") & F.col("_key").startswith(F.col("_bound")))
        need = F.lit(smallest) if found is None else F.col("_need")
        counts = here.groupBy("_class", need.alias("_need"), F.substring("_key", 1, size).alias("_bound")).agg(
            F.count(F.lit(1)).alias("_n"))
        order = Window.partitionBy("_class").orderBy("_bound")  # at most 16 ** DIGITS rows a class
        cum = counts.withColumn("_to", F.sum("_n").over(order))
        cut = cum.where((F.col("_to") >= F.col("_need")) & (F.col("_to") - F.col("_n") < F.col("_need"))).select(
            "_class", "_bound", (F.col("_need") - F.col("_to") + F.col("_n")).alias("_need"),
            (F.col("_to") > F.col("_need")).alias("_open"))
        found = materialize(cut if found is None else cut.unionByName(found.where(~F.col("_open"))))
        if found.where("_open").isEmpty():
            break
    return (keyed.join(by_class(found), "_class")
            .where(F.substring("_key", 1, F.length("_bound")) <= F.col("_bound"))
            .select(*[F.col(c) for c in df.columns]))


def char_split(df: DataFrame, text_col: str, fraction: float) -> DataFrame:
    """First int(fraction*len) characters -> train_text, the rest -> val_text
    (code points, DOUBLE arithmetic)."""
    k = F.floor(F.length(text_col).cast("double") * F.lit(float(fraction))).cast("int")
    return df.select(*df.columns,
                     F.substring(F.col(text_col), F.lit(1), k).alias("train_text"),
                     F.substring(F.col(text_col), k + 1, F.length(text_col)).alias("val_text"))


def batches(ranked: DataFrame, batch_size: int, drop_last: bool, rank_col: str = "rank",
            n_rows: int | None = None) -> DataFrame:
    """batch_id = floor(rank / B); drop_last removes a short final block."""
    out = ranked.withColumn("batch_id", F.floor(F.col(rank_col) / F.lit(batch_size)).cast("bigint"))
    if drop_last:
        n = ranked.count() if n_rows is None else n_rows
        out = out.where(F.col("batch_id") < F.lit(n // batch_size))
    return out


def row_ids(df: DataFrame, order_cols: list, row_col: str = "row_id") -> DataFrame:
    """Stable 0-based row ids in the order of ``order_cols`` (dataset index)."""
    return global_rank(df, order_cols, row_col)
