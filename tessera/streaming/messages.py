"""A partitioned message log as a Spark data source (Python Data Source API).

A log is a folder of immutable segments, JSON lines, one subfolder a partition:

    <path>/p=<partition>/<first offset>-<rows>.jsonl

A message's place is (partition, offset); offsets count from 0 without gaps, so
the end of a partition is read off its file names, and a read from any offset
opens only the segments that hold it.  Streams start at 0, restart from the
offsets in their checkpoint and neither lose nor repeat a message.

Writers stage their rows in files of their own and publish them by renaming
when the whole job (or micro-batch) has ended: a failed or repeated task leaves
nothing behind that a reader sees.  A micro-batch's number is recorded with
what it published, so running it again after a failure publishes nothing new.
One writer at a time may publish to a log.

``path`` is a folder of a file system that pyarrow can open (``file:``,
``hdfs:``, object stores) and that driver and executors share.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition,
    WriterCommitMessage,
)

FORMAT = "tessera_messages"
SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
_SEGMENT = re.compile(r"(\d+)-(\d+)\.jsonl")


def _open(path: str):
    from pyarrow import fs

    # file:/x and file:///x are both in use for one folder
    system, base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")
    return system, base.rstrip("/")


def _segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """partition -> (first offset, rows, file), ascending."""
    from pyarrow import fs

    system, base = _open(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for f in system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
        folder, _, name = f.path.rpartition("/")
        m, part = _SEGMENT.fullmatch(name), folder.rpartition("/")[2]
        if m and part.startswith("p="):
            out.setdefault(int(part[2:]), []).append((int(m[1]), int(m[2]), f.path))
    return {p: sorted(s) for p, s in sorted(out.items())}


def _ends(path: str) -> dict[str, int]:
    return {str(p): s[-1][0] + s[-1][1] for p, s in _segments(path).items()}


@dataclass
class Stretch(InputPartition):
    """Offsets [start, end) of a partition, within one segment."""
    file: str
    first: int
    start: int
    end: int

    def __init__(self, file: str, first: int, start: int, end: int):
        self.file, self.first, self.start, self.end = file, first, start, end


def _stretches(path: str, start: dict[str, int], end: dict[str, int]) -> list[InputPartition]:
    out: list[InputPartition] = []
    for p, segments in _segments(path).items():
        lo, hi = start.get(str(p), 0), end.get(str(p), 0)
        out += [Stretch(file, first, max(first, lo), min(first + rows, hi))
                for first, rows, file in segments if first < hi and first + rows > lo]
    return out


class _Reading:
    def __init__(self, schema, options):
        self.path, self.names = options["path"], [f.name for f in schema.fields]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        system, _ = _open(self.path)
        with system.open_input_stream(partition.file) as raw:
            import io

            for offset, line in enumerate(io.TextIOWrapper(raw, encoding="utf-8", newline="\n"), partition.first):
                if offset >= partition.end:
                    return
                if offset >= partition.start:
                    row = json.loads(line)
                    yield tuple(row.get(n) for n in self.names)


class LogReader(_Reading, DataSourceReader):
    def partitions(self):
        return _stretches(self.path, {}, _ends(self.path)) or [Stretch("", 0, 0, 0)]

    def read(self, partition):
        return super().read(partition) if partition.file else iter(())


class LogStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return _ends(self.path)

    def partitions(self, start: dict, end: dict):
        return _stretches(self.path, start, end)

    def commit(self, end: dict) -> None:
        """Segments stay: other streams read them at their own pace."""


@dataclass
class Staged(WriterCommitMessage):
    files: list  # (partition, file, rows)


class _Writing:
    def __init__(self, schema, options):
        self.path, self.names = options["path"], [f.name for f in schema.fields]
        self.parts, self.key = int(options.get("partitions", 4)), options.get("key", self.names[0])

    def write(self, iterator) -> Staged:
        import zlib

        system, base = _open(self.path)
        system.create_dir(f"{base}/_staged", recursive=True)
        run, out = uuid.uuid4().hex, {}
        try:
            for row in iterator:
                p = zlib.crc32(str(row[self.key]).encode()) % self.parts
                if p not in out:
                    name = f"{base}/_staged/{run}-{p}"
                    out[p] = [system.open_output_stream(name), name, 0]
                line = json.dumps({n: row[n] for n in self.names}, ensure_ascii=False)
                out[p][0].write(line.encode() + b"\n")
                out[p][2] += 1
        finally:
            for stream, _, _ in out.values():
                stream.close()
        return Staged([(p, name, rows) for p, (_, name, rows) in sorted(out.items())])

    def publish(self, messages) -> None:
        system, base = _open(self.path)
        ends = {int(p): e for p, e in _ends(self.path).items()}
        for m in messages:
            for p, file, rows in m.files if m is not None else ():
                first = ends.get(p, 0)
                system.create_dir(f"{base}/p={p}", recursive=True)
                system.move(file, f"{base}/p={p}/{first:012d}-{rows}.jsonl")
                ends[p] = first + rows

    def drop(self, messages, but: frozenset = frozenset()) -> None:
        from pyarrow import fs

        system, _ = _open(self.path)
        for m in messages:
            for _, file, _ in m.files if m is not None else ():
                if file not in but and system.get_file_info(file).type != fs.FileType.NotFound:
                    system.delete_file(file)


class LogWriter(_Writing, DataSourceWriter):
    def commit(self, messages) -> None:
        self.publish(messages)

    def abort(self, messages) -> None:
        self.drop(messages)


class LogStreamWriter(_Writing, DataSourceStreamWriter):
    """Publishes a micro-batch once: what it will publish is recorded before
    the first rename, so a repeated commit finishes the recorded one."""

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        from pyarrow import fs

        system, base = _open(self.path)
        record = f"{base}/_batches/{batchId}"
        if system.get_file_info(record).type == fs.FileType.NotFound:
            ends, plan = {int(p): e for p, e in _ends(self.path).items()}, []
            for m in messages:
                for p, file, rows in m.files if m is not None else ():
                    first = ends.get(p, 0)
                    plan.append((file, f"{base}/p={p}/{first:012d}-{rows}.jsonl"))
                    ends[p] = first + rows
            system.create_dir(f"{base}/_batches", recursive=True)
            with system.open_output_stream(f"{record}.tmp") as out:
                out.write(json.dumps(plan).encode())
            system.move(f"{record}.tmp", record)
        with system.open_input_stream(record) as raw:
            plan = json.loads(raw.read())
        self.drop(messages, but=frozenset(file for file, _ in plan))  # of a batch recorded before
        for file, to in plan:
            if system.get_file_info(file).type != fs.FileType.NotFound:
                system.create_dir(to.rpartition("/")[0], recursive=True)
                system.move(file, to)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self.drop(messages)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return LogReader(schema, self.options)

    def streamReader(self, schema):  # noqa: N802
        return LogStreamReader(schema, self.options)

    def writer(self, schema, overwrite):
        return LogWriter(schema, self.options)

    def streamWriter(self, schema, overwrite):  # noqa: N802
        return LogStreamWriter(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)


def publish(df: DataFrame, path: str, partitions: int = 4, key: str = "conv_id") -> None:
    """Append rows to the log; rows of a key share a partition."""
    register(df.sparkSession)
    times = [F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
             for f in df.schema.fields]
    df.select(*times).write.format(FORMAT).mode("append").options(
        path=path, partitions=str(partitions), key=key).save()


def read_stream(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.readStream.format(FORMAT).schema(schema).option("path", path).load()


def read_log(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).schema(schema).option("path", path).load()
