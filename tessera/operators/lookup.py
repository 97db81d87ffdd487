"""Dictionary lookups (token -> id, id -> token, id -> vector) that survive hot keys.

A token stream is heavily skewed: punctuation and stop words can be a third of
all rows.  A plain sort-merge join sends every row of such a key to one task.
Here the dictionary carries a frequency column; its ``heavy`` most frequent keys
(at most ``heavy`` key hashes: a proven bound, read once to the driver) are
salted: stream rows of a hot key spread over ``buckets`` salts, and the
dictionary rows of hot keys are replicated once per salt (at most
heavy * buckets extra rows).  Any key outside the top ``heavy`` holds at most
1/(heavy+1) of the stream by the pigeonhole rule, so plain hashing is fine for
it.  When the whole dictionary is small, AQE turns the join into a broadcast
hash join at run time (measured size vs. ``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import shuffle_partitions


def hot_key_hashes(table: DataFrame, keys: list[str], weight: str, heavy: int, unique: bool = False) -> list[int]:
    """64-bit hashes of the ``heavy`` most frequent distinct keys: at most
    ``heavy`` numbers (a proven bound), read once on the driver.  ``unique``:
    the table has one row a key, so it is not grouped (shuffled whole) for them."""
    kinds = table if unique else table.groupBy(*keys).agg(F.max(weight).alias(weight))
    top = (kinds.orderBy(F.desc(weight), *[F.asc(k) for k in keys]).limit(heavy)
                .select(F.xxhash64(*keys).alias("h")))
    return [r["h"] for r in top.collect()]


def salted_lookup(stream: DataFrame, table: DataFrame, key: str | list[str], salt_cols: list[str],
                  weight: str = "freq", how: str = "left", heavy: int = 256,
                  buckets: int | None = None, hot: list[int] | None = None, unique: bool = False) -> DataFrame:
    """``stream ⋈ table`` on ``key`` (left or inner) with hot keys salted.

    ``salt_cols`` identify a stream row (e.g. doc_id, pos); ``weight`` is the
    key frequency column of ``table`` (dropped from the result); ``unique`` says
    that the table has one row a key.  Both sides
    decide "hot" with the same predicate on the key hash (a hash collision only
    salts one more key, which is still correct), so the dictionary appears
    once in the plan."""
    spark = stream.sparkSession
    # (key, salt) pairs hash onto reduce partitions with collisions: S salts over
    # P partitions reach about P(1 - e^(-S/P)) of them, so use S = 2P (~86 %)
    s = buckets or 2 * shuffle_partitions(spark)
    keys = [key] if isinstance(key, str) else list(key)
    if hot is None:
        hot = hot_key_hashes(table, keys, weight, heavy, unique)
    if not hot or s <= 1:
        return stream.join(table.drop(weight), keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    left = stream.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*salt_cols), F.lit(s)))
                                       .otherwise(F.lit(0).cast("bigint")))
    right = table.drop(weight).withColumn("_salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0).cast("bigint"), F.lit(s - 1).cast("bigint")))
         .otherwise(F.array(F.lit(0).cast("bigint")))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
