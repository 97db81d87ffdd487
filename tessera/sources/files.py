"""File sources and sinks of the studied workflow, as Spark readers/writers.

* labelled CSV: header ``Label,Text``, comma, ``"`` quoting with doubled ``""``
  escapes, fields may span lines;
* whole-file UTF-8 text (one row per file; written as one file per key);
* headerless tab-separated ``ham``/``spam`` file, no quoting;
* split sink (train / validation / test): Parquet partitioned by split, or three labelled CSVs.

Explicit schemas everywhere (no inference pass over the data).
"""

from __future__ import annotations

import os
import re
import shutil
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from urllib.parse import quote
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

LABELLED_SCHEMA = "Label INT, Text STRING"
RAW_LABEL_SCHEMA = "Label STRING, Text STRING"
# Fixed values of the raw label file: class names and their ids.
RAW_LABEL_IDS = {"ham": 0, "spam": 1}


def read_labelled_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``escape='"'`` is required: with Spark's default backslash escape,
    doubled quotes inside a quoted field are mis-read.  ``multi_line`` reads
    fields with line breaks, a file per task; turn it off for large files
    without them, which then split."""
    reader = (spark.read.schema(LABELLED_SCHEMA)
              .option("header", True).option("multiLine", multi_line).option("mode", "FAILFAST"))
    # a field that is not there is null, a quoted empty one is the empty text: the
    # reader tells them apart only where its null mark is not the empty string
    return _lossless(reader).option("nullValue", "\0null\0").option("emptyValue", "").csv(path)


def write_labelled_csv(df: DataFrame, path: str) -> None:
    out = df.select(F.col("Label").cast("int"), F.col("Text").cast("string"))
    _lossless(out.write.mode("overwrite").option("header", True)).option("nullValue", "").csv(path)


def _lossless(io):
    """Options under which a text comes back as written: no trimming, an empty
    text as ``""`` and a null as nothing, quotes doubled."""
    return (io.option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def _local(path: str) -> str | None:
    """The folder of a ``file:`` path."""
    local = re.fullmatch(r"file:(?://(?=/))?(/(?!/).*)", path, re.DOTALL)
    return local[1].rstrip("/") if local else None


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, text).  Partition columns in the folder names
    (``key=value``) are recovered as columns.

    The folders that ``write_text_per_key`` fills in a ``file:`` store are
    listed and read by the tasks: the driver holds a row a folder.  Of all else
    Spark's reader has the driver list every file."""
    root = _local(path)
    folders = _written_folders(spark, root) if root else None
    if folders is None:
        df = spark.read.text(path, wholetext=True)
        return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"),
                         *[c for c in df.columns if c != "value"])
    pieces = [(n, k, of) for n, files, size in folders for of in [max(-(-files // PIECE_FILES), -(-size // PIECE_BYTES))]
              for k in range(of)]
    rows = spark.range(0, len(pieces), 1, max(1, len(pieces))).mapInArrow(
        _piece_reader(root, pieces), "path string, text binary, folder int")
    return rows.select("path", F.col("text").cast("string").alias("text"), "folder")


# A task reads so many files or bytes of a folder, about.
PIECE_FILES, PIECE_BYTES = 4096, 32 << 20
# A batch of files ends at so many files or bytes.
BATCH_FILES, BATCH_BYTES = 1024, 4 << 20


def _files(folder: str) -> Iterator[os.DirEntry]:
    """What Spark's reader takes of a folder: no hidden names, no empty files."""
    with os.scandir(folder) as entries:
        for e in entries:
            hidden = e.name.startswith(".") or e.name.endswith("._COPYING_") or (e.name.startswith("_") and "=" not in e.name)
            if not hidden and (e.is_dir() or e.stat().st_size):
                yield e


def _written_folders(spark: SparkSession, root: str) -> list[tuple[int, int, int]] | None:
    """(number, files, bytes) of the folders of ``write_text_per_key``; None if
    ``root`` holds anything else."""
    numbers = []
    if not os.path.isdir(root):
        return None
    for e in _files(root):
        if not e.is_dir() or not re.fullmatch("folder=(0|[1-9][0-9]{0,8})", e.name):
            return None
        numbers.append(int(e.name.partition("=")[2]))

    def count(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                files = size = 0
                for e in _files(f"{root}/folder={numbers[i]}"):
                    if e.is_dir() or not re.fullmatch("[^=]+=.*[.]txt", e.name, re.DOTALL):
                        size = None
                        break
                    files, size = files + 1, size + e.stat().st_size
                yield pa.RecordBatch.from_pydict({"n": [numbers[i]], "files": [files], "bytes": [size]}, schema=counted)

    counted = pa.schema([("n", pa.int64()), ("files", pa.int64()), ("bytes", pa.int64())])
    found = spark.range(0, len(numbers), 1, max(1, len(numbers))).mapInArrow(count, "n bigint, files bigint, bytes bigint").collect()
    return [tuple(r) for r in found] if all(r["bytes"] is not None for r in found) and any(r["files"] for r in found) else None


def _piece_reader(root: str, pieces: list[tuple[int, int, int]]):
    """Reads the files of a piece: those of its folder whose name has its number."""
    schema = pa.schema([("path", pa.string()), ("text", pa.binary()), ("folder", pa.int32())])

    def read(batches):
        for b in batches:
            for n, piece, of in (pieces[i] for i in b.column(0).to_pylist()):
                folder, paths, texts, size = f"{root}/folder={n}", [], [], 0
                for e in _files(folder):
                    if crc32(e.name.encode("utf-8", "surrogateescape")) % of != piece:
                        continue
                    with open(e.path, "rb") as f:
                        texts.append(f.read())
                    paths.append(_uri(e.path))
                    size += len(texts[-1])
                    if len(texts) >= BATCH_FILES or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.binary()), pa.array([n] * len(texts), pa.int32())], schema=schema)
                        paths, texts, size = [], [], 0
                if texts:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.binary()), pa.array([n] * len(texts), pa.int32())], schema=schema)
    return read


def _uri(path: str) -> str:
    """The path as Spark writes it in ``_metadata.file_path``."""
    return "file:" + re.sub(r"[^\w\-!.~'()*,;:$&+=/@]", lambda c: c[0] if c[0] > "\x7f" and unicodedata.category(c[0])[0] != "Z"
                              and unicodedata.category(c[0]) != "Cc" else quote(c[0], safe=""), path)


# The files of a written folder are dealt over so many subfolders.
FOLDERS = 256
# Stands for a null key, as in Spark's own partition folders.
NULL_KEY = "__HIVE_DEFAULT_PARTITION__"


def write_text_per_key(df: DataFrame, key: str, text_col: str, path: str) -> None:
    """One file per key value (``folder=<n>/<key>=<value>.txt``), in place of
    what ``path`` held; each row ends with a newline, which
    ``strip_written_newline`` removes on read, and rows of one key follow each
    other.  An empty key is a null one.

    In a ``file:`` store, which driver and executors share, the tasks make the
    files themselves: Spark's writer took 67 s for 10,000 there, on 8 cores.
    Elsewhere it is used (``<key>=<value>/part-*``)."""
    root = _local(path)
    if root is None:
        df.select(key, text_col).repartition(key).write.mode("overwrite").partitionBy(key).text(path)
        return
    if os.path.isdir(root):
        shutil.rmtree(root)
    rows = df.select(F.nullif(F.col(key).cast("string"), F.lit("")).alias("key"),
                     F.col(text_col).cast("binary").alias("text"))
    (rows.withColumn("folder", F.pmod(F.hash("key"), F.lit(FOLDERS)))
     .repartition("key").sortWithinPartitions("folder", "key")
     .foreachPartition(_file_writer(root, key)))


def _file_writer(root: str, key: str) -> Callable[[Iterable[Row]], None]:
    """Writes the sorted rows of a task, a file per key.  A file gets its name
    when it is whole, and another attempt of the task replaces it."""
    def write(rows: Iterable[Row]) -> None:
        part = f".{TaskContext.get().taskAttemptId()}.part"  # a hidden name: never read
        for (folder, value), group in groupby(rows, lambda r: (r.folder, r.key)):
            at = f"{root}/folder={folder}"
            os.makedirs(at, exist_ok=True)
            with open(f"{at}/{part}", "wb") as out:
                for row in group:
                    out.write(row.text or b"")
                    out.write(b"\n")
            name = NULL_KEY if value is None else quote(value, safe="")
            os.replace(f"{at}/{part}", f"{at}/{key}={name}.txt")
    return write


def key_of_path(path_col: str, key: str) -> F.Column:
    """The key value, as text, in the path of a file of ``write_text_per_key``:
    escaped once in the name and once more in the path."""
    value = name = F.regexp_extract(path_col, f"/{key}=([^/]*?)(?:\\.txt$|/[^/]*$)", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(name != NULL_KEY, value)


def strip_written_newline(text_col: str = "text") -> F.Column:
    return F.expr(f"substring({text_col}, 1, length({text_col}) - 1)")


def read_label_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``label<TAB>text`` lines; quoting disabled (``\\u0000``).  The
    format has no null: a missing text is the empty one."""
    return (spark.read.schema(RAW_LABEL_SCHEMA)
            .option("sep", "\t").option("header", False).option("quote", "\u0000")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("mode", "FAILFAST")
            .csv(path)
            .withColumn("Text", F.coalesce("Text", F.lit(""))))


def tsv_safe(text_col: str) -> F.Column:
    """A TSV line cannot hold tabs or line breaks: they become spaces."""
    return F.regexp_replace(F.col(text_col), "[\t\n\r]", " ")


def write_label_tsv(df: DataFrame, path: str) -> None:
    (df.select("Label", tsv_safe("Text").alias("Text"))
     .write.mode("overwrite").option("sep", "\t").option("header", False).option("quote", "\u0000")
     .option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def raw_label_ids(label_col: str = "Label") -> F.Column:
    m = F.create_map(*[x for k, v in RAW_LABEL_IDS.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, F.col(label_col))


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


SPLIT_NAMES = ("train", "validation", "test")


def write_csv_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """The three labelled CSVs of a split, one folder each (``path/<split>``)."""
    for name in SPLIT_NAMES:
        write_labelled_csv(df.where(F.col(split_col) == name), f"{path}/{name}")


def read_csv_splits(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    out = None
    for name in SPLIT_NAMES:
        part = read_labelled_csv(spark, f"{path}/{name}", multi_line).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
