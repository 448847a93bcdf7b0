"""Source and sink connectors: any system as a batch or streaming source, and as a sink, by Python data sources.

A source says how far each of its partitions reaches and reads a range of offsets of one; Spark plans the
ranges, keeps the offsets of each micro-batch in the checkpoint and reads them again, the same ones, after a
failure. A sink's tasks stage their rows, and what all of them report is committed or given up as a whole.
Commits carry the batch id, so a repeated batch can be told from a new one.
"""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType


class SourceConnector(ABC):
    """A source, made from its options on the driver and in each task."""

    #: The rows' type as DDL.
    schema: str

    def __init__(self, options: dict[str, str]):
        self.options = options

    @abstractmethod
    def ends(self) -> dict[str, int]:
        """The offset after the last row, for each partition there is now."""

    @abstractmethod
    def read(self, partition: str, start: int, end: int) -> Iterator[tuple]:
        """The rows with offsets from ``start`` to before ``end``; the same ones whenever it is asked."""

    def starts(self) -> dict[str, int]:
        """Where a new query starts; partitions that aren't named start at 0."""
        return {}

    def committed(self, offsets: dict[str, int]) -> None:
        """All rows before ``offsets`` are done with and won't be asked for again."""


class SinkConnector(ABC):
    """A sink, made from its options on the driver and in each task."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    @abstractmethod
    def stage(self, rows: Iterator[Row]) -> str:
        """Put the rows of a task where nobody sees them yet; what ``commit`` needs to find them."""

    @abstractmethod
    def commit(self, staged: list[str], batch_id: int | None) -> None:
        """Show what was staged, all or nothing; a ``batch_id`` that was committed before changes nothing."""

    def abort(self, staged: list[str], batch_id: int | None) -> None:
        """Give up what was staged."""


class _Range(InputPartition):
    def __init__(self, name: str, start: int, end: int):
        self.name, self.start, self.end = name, start, end


class _Message(WriterCommitMessage):
    def __init__(self, staged: str):
        self.staged = staged


def _ranges(start: dict, end: dict) -> list[_Range]:
    return [_Range(p, int(start.get(p, 0)), int(e)) for p, e in sorted(end.items()) if int(e) > int(start.get(p, 0))]


class _Reader(DataSourceReader):
    def __init__(self, source: SourceConnector):
        self.source = source

    def partitions(self) -> list[_Range]:
        # without rows there is one empty range, as a read has one partition at least
        return _ranges(self.source.starts(), self.source.ends()) or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return iter(()) if partition.start == partition.end else self.source.read(partition.name, partition.start, partition.end)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, source: SourceConnector):
        self.source = source

    def initialOffset(self) -> dict:
        return dict(self.source.starts())

    def latestOffset(self) -> dict:
        return dict(self.source.ends())

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        return _ranges(start, end)

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.source.read(partition.name, partition.start, partition.end)

    def commit(self, end: dict) -> None:
        self.source.committed(end)


class _Writer(DataSourceWriter):
    def __init__(self, sink: SinkConnector):
        self.sink = sink

    def write(self, iterator: Iterator[Row]) -> _Message:
        return _Message(self.sink.stage(iterator))

    def commit(self, messages: list, batch_id: int | None = None) -> None:
        self.sink.commit([m.staged for m in messages if m is not None], batch_id)

    def abort(self, messages: list, batch_id: int | None = None) -> None:
        self.sink.abort([m.staged for m in messages if m is not None], batch_id)


class _StreamWriter(DataSourceStreamWriter, _Writer):
    write, commit, abort = _Writer.write, _Writer.commit, _Writer.abort


def register(spark: SparkSession, name: str, source: type[SourceConnector] | None = None, sink: type[SinkConnector] | None = None) -> None:
    """Makes a connector the format ``name`` of ``spark.read``, ``readStream``, ``write`` and ``writeStream``."""

    class Connected(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return source.schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(source(dict(self.options)))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _StreamReader(source(dict(self.options)))

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(sink(dict(self.options)))

        def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
            return _StreamWriter(sink(dict(self.options)))

    spark.dataSource.register(Connected)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LineFiles(SourceConnector):
    """The whole lines of the files in a folder that are written to at their ends: file, position, value.

    An offset is a byte of the file, so a line has the position it starts at, in a batch and on a stream; a
    line without its end yet waits for it. Option ``path``: a folder that all tasks reach by pyarrow.
    """

    schema = "file string, position long, value string"
    BLOCK = 1 << 20

    def ends(self) -> dict[str, int]:
        files, path = _opened(self.options["path"])
        found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return {i.base_name: self._last_end(files, i) for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))}

    def _last_end(self, files: fs.FileSystem, info: fs.FileInfo) -> int:
        """The place after the last line feed."""
        with files.open_input_file(info.path) as f:
            end = info.size
            while end:
                start = max(0, end - self.BLOCK)
                f.seek(start)
                at = f.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def read(self, partition: str, start: int, end: int) -> Iterator[tuple]:
        files, path = _opened(self.options["path"])
        with files.open_input_file(f"{path.rstrip('/')}/{partition}") as f:
            f.seek(start)
            at, rest, left = start, b"", end - start
            while left:
                block = f.read(min(self.BLOCK, left))
                if not block:
                    raise OSError(f"{partition} has become shorter")
                left -= len(block)
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                for line in lines:
                    yield partition, at, line.removesuffix(b"\r").decode(errors="replace")
                    at += len(line) + 1


class JsonFiles(SinkConnector):
    """Rows as lines of JSON; a manifest file names the files of a batch, and what no manifest names isn't there.

    Option ``path``: a folder that all tasks reach by pyarrow. ``committed_files`` lists what counts.
    """

    def stage(self, rows: Iterator[Row]) -> str:
        files, path = _opened(self.options["path"])
        files.create_dir(f"{path}/data", recursive=True)
        name = f"data/{uuid.uuid4().hex}.json"
        with files.open_output_stream(f"{path}/{name}") as f:
            for r in rows:
                f.write(json.dumps(r.asDict(True), default=str).encode() + b"\n")
        return name

    def commit(self, staged: list[str], batch_id: int | None) -> None:
        files, path = _opened(self.options["path"])
        files.create_dir(f"{path}/manifests", recursive=True)
        to = f"{path}/manifests/{uuid.uuid4().hex if batch_id is None else f'batch-{batch_id:012d}'}"
        if files.get_file_info(to).type == fs.FileType.File:  # this batch is there already
            return self.abort(staged, batch_id)
        with files.open_output_stream(f"{to}.tmp") as f:
            f.write(json.dumps(staged).encode())
        files.move(f"{to}.tmp", to)

    def abort(self, staged: list[str], batch_id: int | None) -> None:
        files, path = _opened(self.options["path"])
        for name in staged:
            files.delete_file(f"{path}/{name}")


def committed_files(path: str) -> list[str]:
    """The files that the manifests at ``path`` name."""
    files, at = _opened(path)
    found = files.get_file_info(fs.FileSelector(f"{at}/manifests", allow_not_found=True))
    names = []
    for info in sorted(found, key=lambda i: i.base_name):
        if not info.base_name.endswith(".tmp"):
            with files.open_input_stream(info.path) as f:
                names += json.loads(f.read())
    return [f"{path.rstrip('/')}/{n}" for n in names]
