"""Directory trees and log directories as tables, and replacing what a tree holds."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


# Parts of Spark's own split of a tree that one task reads.
SCANS_PER_TASK = 16


def scan_tree(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root``: rel_path, length, mtime and content.

    Content is read only when a query selects it. ``root`` is an absolute path or URI.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    prefix = urlparse(root).path.rstrip("/") + "/"
    start = F.instr("path", prefix) + len(prefix)
    found = reader.load(root)
    # Spark counts each file as 4 MB, so a task takes few small ones; tasks cost more than these.
    parts = found.select("path").rdd.getNumPartitions()
    least = min(parts, 4 * spark.sparkContext.defaultParallelism)
    found = found.coalesce(max(1, least, -(-parts // SCANS_PER_TASK)))
    return found.select(
        F.substr("path", start).alias("rel_path"),
        "length",
        F.col("modificationTime").alias("mtime"),
        "content",
    )


def scan_logs(
    spark: SparkSession, folder: str, glob: str = "*.log", stream: bool = False, **options: object
) -> DataFrame:
    """Lines of the log files in a folder, with the file each comes from.

    As a stream it picks up new files; ``tail_logs`` also follows growing ones.
    """
    reader = (spark.readStream if stream else spark.read).options(pathGlobFilter=glob, **options)
    return reader.text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )


def replace_tree(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Write ``df`` over ``path``, removing what was there.

    With partition keys only the partitions that ``df`` has rows for are
    replaced. Rebalancing splits a hot partition over several writers and keeps
    the small ones from scattering into many files.
    """
    writer = df.hint("rebalance", *keys) if keys else df.hint("rebalance")
    out = writer.write.mode("overwrite")
    if keys:
        out = out.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    out.parquet(path)


def write_files(files: DataFrame, folder: str) -> None:
    """Write each row's ``content`` to a file at ``rel_path`` below a shared folder.

    A file appears whole, under its final name, so repeated tasks do no harm. On
    a local or mounted file system it gets the permission bits in ``mode``.
    """
    with_mode = "mode" in files.columns

    def write(rows: Iterator[Row]) -> None:
        target, base = fs.FileSystem.from_uri(folder)
        for row in rows:
            path = f"{base}/{row.rel_path}"
            draft = f"{path}.{uuid.uuid4().hex}.tmp"
            target.create_dir(os.path.dirname(path), recursive=True)
            with target.open_output_stream(draft) as out:
                out.write(row.content)
            if with_mode and isinstance(target, fs.LocalFileSystem):
                os.chmod(draft, row.mode)
            target.move(draft, path)

    files.foreachPartition(write)


def swap_in(staged: str, target: str) -> None:
    """Put a finished folder in the place of ``target``; what was there is deleted last."""
    system, new = fs.FileSystem.from_uri(staged)
    _, old = fs.FileSystem.from_uri(target)
    aside = f"{old.rstrip('/')}.old-{uuid.uuid4().hex}"
    there = system.get_file_info(old).type != fs.FileType.NotFound
    if there:
        system.move(old, aside)
    system.create_dir(os.path.dirname(old), recursive=True)
    system.move(new, old)
    if there:
        system.delete_dir(aside)
