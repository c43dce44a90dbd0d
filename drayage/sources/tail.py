"""A streaming source that follows growing log files.

Spark's own file stream reads each file once and never sees lines appended to
it later. This source keeps a byte offset per file instead.
"""

from __future__ import annotations

import fnmatch
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PARTITION_BYTES = 64 << 20
_BLOCK = 1 << 16
#: Bytes at the front of a file by which it is known again.
_HEAD = 4096
_BATCH_LINES = 10_000


class ByteRange(InputPartition):
    """Lines of a file that start in [start, stop); ``aligned`` if one starts at start."""

    def __init__(self, path: str, start: int, stop: int, end: int, aligned: bool):
        self.path = path
        self.start = start
        self.stop = stop
        self.end = end
        self.aligned = aligned


class TailReader(DataSourceStreamReader):
    """Offsets are ``{path: [bytes read, digest of the first of them]}``; they end behind
    the last complete line. Plain numbers of older checkpoints are read too.

    A file that is gone is forgotten, so one of the same name starts over, as
    does a file that became shorter or begins with other bytes than those read.
    """

    def __init__(self, folder: str, glob: str, partition_bytes: int, max_bytes: int | None):
        self.folder = folder
        self.glob = glob
        self.partition_bytes = partition_bytes
        self.max_bytes = max_bytes
        self.served: dict | None = None

    def initialOffset(self) -> dict:
        self.served = {}
        return {}

    def latestOffset(self) -> dict:
        files, base = fs.FileSystem.from_uri(self.folder)
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
        known = self.served or {}
        starts = {}
        for info in found:
            if info.is_file and fnmatch.fnmatch(info.base_name, self.glob):
                start = _start(files, info.path, known.get(info.path, 0), info.size)
                starts[info.path] = (start, info.size)
        grown = sum(start < size for start, size in starts.values())
        # An equal share each, so that no file waits for a faster one. Right after
        # a restart the starts are unknown and nothing is held back.
        share = None
        if self.max_bytes is not None and self.served is not None:
            share = max(1, self.max_bytes // max(1, grown))
        ends = {}
        for path, (start, size) in starts.items():
            limit = size if share is None else min(size, start + share)
            end = _complete_end(files, path, start, limit, size)
            if end:
                ends[path] = [end, _head(files, path, end)]
        self.served = ends
        return ends

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.served = end
        files, _ = fs.FileSystem.from_uri(self.folder)
        ranges = []
        for path, to in end.items():
            stop = _bytes(to)
            if start.get(path) == to:
                continue
            first = _start(files, path, start.get(path, 0), stop)
            for at in range(first, stop, self.partition_bytes):
                ranges.append(
                    ByteRange(path, at, min(at + self.partition_bytes, stop), stop, at == first)
                )
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.folder)
        try:
            raw = files.open_input_file(partition.path)
        except FileNotFoundError:
            return  # deleted since: there is nothing left to read
        with io.BufferedReader(raw, 1 << 20) as stream:
            at = partition.start
            if partition.aligned:
                stream.seek(at)
            else:
                stream.seek(at - 1)
                at += len(stream.readline()) - 1
            offsets, lines = [], []
            while at < partition.stop:
                line = stream.readline(partition.end - at)
                if not line:
                    break
                offsets.append(at)
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                at += len(line)
                if len(lines) == _BATCH_LINES:
                    yield _batch(partition.path, offsets, lines)
                    offsets, lines = [], []
            if lines:
                yield _batch(partition.path, offsets, lines)


def _batch(path: str, offsets: list[int], lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(lines)), pa.array(offsets, pa.int64()), pa.array(lines)],
        names=["path", "offset", "line"],
    )


def _bytes(offset: list | int) -> int:
    return offset if isinstance(offset, int) else offset[0]


def _head(files: fs.FileSystem, path: str, upto: int) -> str | None:
    """Digest of the first bytes of a file before ``upto``; none if it is gone."""
    try:
        with files.open_input_file(path) as stream:
            return hashlib.sha256(stream.read(min(_HEAD, upto))).hexdigest()
    except FileNotFoundError:
        return None


def _start(files: fs.FileSystem, path: str, offset: list | int, stop: int) -> int:
    """Where to go on: at the offset if the file is still the one that was read up to there."""
    start = _bytes(offset)
    if start > stop:
        return 0
    if isinstance(offset, int) or not start:
        return start
    # A file gone since is no other one: nothing of it is read.
    return start if _head(files, path, start) in (None, offset[1]) else 0


def _complete_end(files: fs.FileSystem, path: str, start: int, limit: int, size: int) -> int:
    """End of the last line complete by ``limit``; of the first line if that is longer."""
    with files.open_input_file(path) as stream:
        at = limit
        while at > start:
            low = max(start, at - _BLOCK)
            stream.seek(low)
            cut = stream.read(at - low).rfind(b"\n")
            if cut >= 0:
                return low + cut + 1
            at = low
        at = limit
        while start < limit and at < size:
            stream.seek(at)
            block = stream.read(min(_BLOCK, size - at))
            cut = block.find(b"\n")
            if cut >= 0:
                return at + cut + 1
            at += len(block)
    return start


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail_logs"

    def schema(self) -> str:
        return "path string, offset long, line string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        limit = self.options.get("maxBytesPerTrigger")
        return TailReader(
            self.options["path"],
            self.options.get("glob", "*.log"),
            int(self.options.get("partitionBytes", PARTITION_BYTES)),
            int(limit) if limit else None,
        )


def tail_logs(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """Follow the log files of a folder: path, byte offset and text of each complete line.

    Options: ``glob``, ``partitionBytes`` (a longer range is read by several
    tasks) and ``maxBytesPerTrigger``, which each growing file may exceed by a
    line. The offset names every file of the folder; for folders of very many
    finished files use ``scan_logs``.
    """
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail_logs").options(**options).load(folder)
