"""Writing whole payloads of any length to files, published together or not at all."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from drayage.sources.files import swap_in

COLUMNS = ("blob_id", "i", "chunk", "num_chunks", "size", "dest_path", "mode")


@dataclass
class Written(WriterCommitMessage):
    """What a task has staged: whole payloads, and of those at fault their number and some examples."""

    whole: int
    faulty: int
    examples: list[str]


class _Draft:
    """A payload on its way to a file, chunk by chunk, in order."""

    def __init__(self, target: fs.FileSystem, base: str, row: dict):
        self.target, self.row = target, row
        parts = row["dest_path"].split("/")
        self.fault = "bad_path" if row["dest_path"].startswith("/") or ".." in parts or "" in parts else None
        self.path = f"{base}/{row['dest_path']}"
        self.draft = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.next = self.bytes = 0
        self.last: bytes | None = None
        self.out = None
        if self.fault is None:
            target.create_dir(os.path.dirname(self.path), recursive=True)
            self.out = target.open_output_stream(self.draft)

    def add(self, i: int, chunk: bytes) -> None:
        if self.fault is not None:
            return
        if not 0 <= i < self.row["num_chunks"]:
            self.fault = "surplus"
        elif i == self.next:
            self.out.write(chunk)
            self.next, self.bytes, self.last = i + 1, self.bytes + len(chunk), chunk
        elif i > self.next:
            self.fault = "missing"
        elif chunk != self.last:
            self.fault = "conflict"

    def finish(self) -> str | None:
        """Puts a whole payload in its place and returns None, or says what is wrong with it."""
        if self.fault is None and self.next < self.row["num_chunks"]:
            self.fault = "missing"
        if self.fault is None and self.bytes != self.row["size"]:
            self.fault = "size_mismatch"
        if self.out is not None:
            self.out.close()
            if self.fault is not None:
                self.target.delete_file(self.draft)
            else:
                if self.row["mode"] is not None and isinstance(self.target, fs.LocalFileSystem):
                    os.chmod(self.draft, self.row["mode"])
                self.target.move(self.draft, self.path)
        return self.fault


class PayloadWriter(DataSourceArrowWriter):
    """Tasks stage files under the names they will have; the commit swaps the folder in."""

    def __init__(self, options: dict[str, str]):
        self.staged, self.target = options["staged"], options["path"]
        self.payloads, self.strict = int(options["payloads"]), options["strict"] == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = fs.FileSystem.from_uri(self.staged)
        message = Written(0, 0, [])
        current: _Draft | None = None

        def close(draft: _Draft | None) -> None:
            if draft is None:
                return
            fault = draft.finish()
            if fault is None:
                message.whole += 1
            else:
                message.faulty += 1
                if len(message.examples) < 5:
                    message.examples.append(f"{draft.row['blob_id']}: {fault}")

        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in COLUMNS]
            for n in range(batch.num_rows):
                row = {c: column[n].as_py() for c, column in zip(COLUMNS, columns)}
                if current is None or current.row["blob_id"] != row["blob_id"]:
                    close(current)
                    current = _Draft(system, base, row)
                if row["i"] is not None:
                    current.add(row["i"], row["chunk"] or b"")
        close(current)
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        whole, faulty = sum(m.whole for m in done), sum(m.faulty for m in done)
        if whole + faulty != self.payloads or (faulty and self.strict):
            self.abort(messages)
            examples = [x for m in done for x in m.examples][:5]
            raise ValueError(f"{faulty} of {self.payloads} payloads are at fault, nothing was published: {examples}")
        system, base = fs.FileSystem.from_uri(self.staged)
        system.create_dir(base, recursive=True)
        swap_in(self.staged, self.target)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, base = fs.FileSystem.from_uri(self.staged)
        if system.get_file_info(base).type != fs.FileType.NotFound:
            system.delete_dir(base)


class PayloadFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "payload_files"

    def writer(self, schema, overwrite: bool) -> PayloadWriter:
        return PayloadWriter(self.options)


def write_payloads(chunks: DataFrame, manifest: DataFrame, target: str, strict: bool = True) -> None:
    """Write each payload of ``manifest`` to ``dest_path`` below ``target``, with the bits in ``mode``.

    ``manifest(blob_id, num_chunks, size, dest_path, mode)`` says which payloads there are; an
    empty one becomes an empty file, and chunks of payloads it doesn't list are left out. The
    chunks of a payload stream through one task in order, so a file may be of any length and no row
    or task holds it. Copies of a chunk that agree count once. A payload with chunks missing,
    beyond the manifest or in conflict, of another length or with a path that leaves the tree is at
    fault: with ``strict`` nothing is published then and the old ``target`` stays, else the whole
    ones are. Files appear under ``target`` all at once, in place of what was there.
    """
    repeated = manifest.groupBy("dest_path").count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"several payloads go to {repeated[0]['dest_path']!r}")
    spark = manifest.sparkSession
    spark.dataSource.register(PayloadFiles)
    plan = manifest.select(
        F.col("blob_id").cast("string").alias("blob_id"), F.col("num_chunks").cast("long"), F.col("size").cast("long"), "dest_path", F.col("mode").cast("int")
    )
    sent = chunks.select(F.col("blob_id").cast("string").alias("blob_id"), F.col("i").cast("long"), "chunk")
    dealt = plan.join(sent, "blob_id", "left").select(*COLUMNS).repartition("blob_id").sortWithinPartitions("blob_id", "i")
    writer = dealt.write.format("payload_files").mode("append")
    writer.options(path=target, staged=f"{target.rstrip('/')}.staged-{uuid.uuid4().hex}", payloads=plan.count(), strict=strict).save()
