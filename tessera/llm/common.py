"""Shared pieces of the operators: inputs, stored tables, joins on hot keys,
connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, load_table, scratch_path, shuffle_partitions

#: A key counts as hot from this share of all rows on; at most ``HOT_SHARE - 1``
#: keys can have it, which bounds the broadcast list of hot keys.
HOT_SHARE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that extra
    columns of the caller (whatever their names) never clash; null text = ''."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows evenly over two tasks a core where the scan gives fewer
    splits than that (one oversized row group); the plan changes, no result."""
    want = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() * 2 <= want else df


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it from there:
    computed once, column-pruned by later readers, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, max_rows: int = 4096,
               max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of a bounded size."""
    out: list[tuple] = []
    size = 0
    for row in rows:
        out.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(out) >= max_rows or size >= max_bytes:
            yield _batch(out, schema)
            out, size = [], 0
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def attach_by_key(rows: DataFrame, lookup: DataFrame, keys: list[str], size_col: str,
                  spread_by: Column) -> DataFrame:
    """Left join of ``rows`` to ``lookup`` (one row a key, whose ``size_col``
    says how many of ``rows`` carry the key) that no hot key can stall.

    Keys with at least a ``1/HOT_SHARE`` share of all rows (fewer than
    ``HOT_SHARE`` of them, by pigeonhole: the broadcast bound) are dealt over a
    number of salts in proportion to their measured share."""
    total = lookup.agg(F.sum(size_col)).first()[0] or 0
    salts = 4 * shuffle_partitions(rows.sparkSession)
    share = F.ceil(F.col(size_col) * F.lit(salts) / F.lit(max(total, 1))).cast("int")
    hot = (lookup.where(F.col(size_col) * F.lit(HOT_SHARE) > F.lit(total))
           .select(*keys, F.greatest(share, F.lit(1)).alias("_salts")))
    salted_rows = (rows.join(F.broadcast(hot), keys, "left")
                   .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
                       F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")))
                   .drop("_salts"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(
        F.col(size_col) * F.lit(HOT_SHARE) > F.lit(total), F.greatest(share, F.lit(1)) - 1).otherwise(F.lit(0)))))
    return salted_rows.join(salted_lookup, [*keys, "_salt"], "left").drop("_salt")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component = smallest node reachable) for every node of ``edges``
    (columns ``u``, ``v``; undirected; any orderable type; loops and repeats
    allowed).

    Alternating large-star and small-star rounds: every round is a map-side
    combined minimum per node and one join; the edge table never grows, it is
    written to the shared checkpoint folder each round, and nothing but its
    row count and a checksum reaches the driver."""
    ensure_checkpoint_dir(edges.sparkSession)
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct()
    e = e.checkpoint()

    def mark(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    state = mark(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        down = large.where(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        e = small.where(F.col("u") != F.col("v")).distinct().checkpoint()
        new = mark(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("connected components did not settle")
    root = e.groupBy("u").agg(F.min("v").alias("component"))
    return (nodes.join(root, nodes["node"] == root["u"], "left")
            .select("node", F.coalesce("component", "node").alias("component")))


def released(run: Callable) -> Callable:
    """``run`` for mapInArrow, which gives the memory that its task no longer
    uses back to the machine when it ends (workers live on for other tasks)."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
            trim(0)
    return wrapped


def text_slices(batch: pa.RecordBatch, name: str = "text", size: int = 4 << 20) -> Iterator[tuple]:
    """(bytes, offsets, first row, end row) of stretches of about ``size`` bytes
    of text, so that what is derived from a batch at once stays small; a longer
    text is a stretch of its own."""
    buf, offsets = arrow_text(batch, name)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield buf, offsets[lo:hi + 1], lo, hi
        lo = hi


def arrow_text(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column of an Arrow batch, nulls as empty."""
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets
