"""Dense global positions without a single-partition window.

``row_number() over (order by k)`` puts every row into one task.  Instead:

1. range-partition on the order key into N partitions and sort inside each
   (Spark samples the key, so partitions are balanced even when one group or
   prefix is hot: the order key is unique, ties broken by the caller's columns);
2. write the result to the reliable checkpoint folder, which fixes partition
   contents and order (recomputation after an executor loss re-reads the same
   files, so positions never change between the two uses below);
3. count rows per partition (N rows: a proven-small table), running sum = offset;
4. position = offset of the partition + index inside the partition, taken from
   ``monotonically_increasing_id`` (partition index in the upper 31 bits, row
   index in the lower 33) over the fixed files, joined to the N offsets by
   broadcast.  No shuffle of the data beyond the one range exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, shuffle_partitions

_LOW_BITS = (1 << 33) - 1


def _fixed(df: DataFrame, order_cols: list, num_partitions: int | None) -> DataFrame:
    """The rows range-partitioned and sorted by ``order_cols``, fixed in the
    checkpoint folder, each with its partition ``_part`` and place there ``_local``."""
    ensure_checkpoint_dir(df.sparkSession)
    n = num_partitions or shuffle_partitions(df.sparkSession)
    fixed = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    tagged = fixed.withColumn("_mid", F.monotonically_increasing_id())
    return (tagged.withColumn("_part", F.shiftright(F.col("_mid"), 33))
                  .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).drop("_mid"))


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based BIGINT position in the total order of ``order_cols``.

    ``order_cols`` must identify rows (include a unique tie-breaker)."""
    tagged = _fixed(df, order_cols, num_partitions)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
                  .select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_local")).alias(rank_col)))


def rank_within_groups(df: DataFrame, group_cols: list[str], order_cols: list,
                       rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """0-based position inside each group, without a per-group window.

    Range partitions by (group, order) spread a hot group over many of them.  A
    group's piece of a partition stands together, so a row's position is its
    place there less the piece's first place, plus the rows of the group's
    pieces before it: one count per (partition, group), at most groups +
    partitions rows, joined back on that pair, so no join key holds more rows
    than one range partition.  Null groups are a group."""
    tagged = _fixed(df, [*group_cols, *order_cols], num_partitions).withColumn("_key", F.struct(*group_cols))
    pieces = tagged.groupBy("_part", "_key").agg(F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select("_part", "_key", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    return (tagged.join(bases, ["_part", "_key"])
                  .select(*[F.col(c) for c in df.columns], (F.col("_base") + F.col("_local")).alias(rank_col)))


def running_total(df: DataFrame, group_cols: list[str], order_cols: list, value_col: str,
                  out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of ``value_col`` inside each group, in the order
    of ``order_cols`` (which must identify rows within a group).

    Same shape as :func:`global_rank`: range-partition on (group, order) and fix
    the partitions in the checkpoint folder; a group may span many partitions,
    so a few (or one hot) group never becomes one task.  Per (partition, group)
    totals form a table of at most partitions + groups rows; their running sum
    per group gives each piece's base, and the in-piece running sum is a
    window over one range partition's piece (balanced by the range sampler)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    keys = [*group_cols, *order_cols]
    fixed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    tagged = fixed.withColumn("_part", F.spark_partition_id())
    totals = tagged.groupBy("_part", *group_cols).agg(F.sum(value_col).alias("_t"))
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", *group_cols,
                          F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inner = (Window.partitionBy("_part", *group_cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, -1))
    within = tagged.withColumn("_in", F.coalesce(F.sum(value_col).over(inner), F.lit(0)))
    return (within.join(bases, ["_part", *group_cols])
            .withColumn(out_col, F.col("_base") + F.col("_in"))
            .drop("_part", "_base", "_in"))
