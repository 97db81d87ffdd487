"""Row numbers of a stored table from its files: an index of (file, first row).

The index is one partial/final count per file.  A row's number is its file's
first row plus its index within the file, so numbering a table joins it to a
table of files and shuffles nothing, and fetching row k reads one file.
Files are ordered by name; a table must not change under its index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import materialize

#: Files up to which the index is broadcast.
BROADCAST_FILES = 200_000


def file_index(table: DataFrame) -> DataFrame:
    """(file, n_rows, first_row) of a table just read from files; a row per file."""
    counts = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file, not a row a row
    return materialize(counts.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0))))


def with_row_id(table: DataFrame, index: DataFrame, row_col: str = "row_id") -> DataFrame:
    """``table`` (just read from its files) with each row's number."""
    files = index.select(F.col("file").alias("_file"), F.col("first_row").alias("_first"))
    if index.count() <= BROADCAST_FILES:
        files = F.broadcast(files)
    cols = table.columns
    named = table.withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.col("_metadata.row_index"))
    return named.join(files, "_file").select(*cols, (F.col("_first") + F.col("_at")).alias(row_col))


def size(index: DataFrame) -> int:
    return index.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def fetch(spark: SparkSession, index: DataFrame, k: int, row_col: str = "row_id") -> DataFrame:
    """Row ``k`` (an empty table where there is none): reads only the file that holds it."""
    at = index.where((F.col("first_row") <= k) & (F.col("first_row") + F.col("n_rows") > k)).first()
    if at is None:
        first = index.first()
        if first is None:
            raise ValueError("the index names no file")
        return spark.read.parquet(first["file"]).limit(0).withColumn(row_col, F.lit(k).cast("bigint"))
    table = spark.read.parquet(at["file"])
    return (table.where(F.col("_metadata.row_index") == F.lit(k - at["first_row"]))
            .withColumn(row_col, F.lit(k).cast("bigint")))
