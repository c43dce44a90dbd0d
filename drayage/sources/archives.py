"""Packing trees into compressed archives and unpacking them again."""

from __future__ import annotations

import gzip
import io
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_BYTES = 128 << 20
_FLUSH_BYTES = 32 << 20


def pack_archives(tree: DataFrame, root: str = "root", part_bytes: int = PART_BYTES) -> DataFrame:
    """Pack the files of each root into ``gztar`` payloads of about ``part_bytes`` each.

    A root larger than that gets several archives, each valid by itself, over
    which its files are spread by a hash of their path; unpacking all of them
    gives the tree. The same files give the same bytes.
    """
    sizes = tree.groupBy(root).agg(
        F.ceil(F.sum(F.octet_length("content").cast("long") + 1024) / part_bytes).alias("parts")
    )
    mode = F.col("mode") if "mode" in tree.columns else F.lit(0o600)
    files = tree.join(sizes, root).select(
        F.col(root).alias("root"),
        F.pmod(F.xxhash64("rel_path"), F.col("parts")).cast("int").alias("part"),
        F.col("parts").cast("int").alias("parts"),
        "rel_path",
        mode.cast("int").alias("mode"),
        "content",
    )
    root_type = tree.schema[root].dataType.simpleString()
    return files.groupBy("root", "part").applyInPandas(
        _pack, f"root {root_type}, part int, parts int, entries long, content binary"
    )


def _pack(files: pd.DataFrame) -> pd.DataFrame:
    payload = io.BytesIO()
    # Fixed times and sorted names make the bytes depend on the files alone.
    with (
        gzip.GzipFile(fileobj=payload, mode="wb", mtime=0) as zipped,
        tarfile.open(fileobj=zipped, mode="w") as archive,
    ):
        for row in files.sort_values("rel_path").itertuples(index=False):
            info = tarfile.TarInfo(row.rel_path)
            info.size, info.mode, info.mtime = len(row.content), row.mode, 0
            archive.addfile(info, io.BytesIO(row.content))
    first = files.iloc[0]
    return pd.DataFrame({
        "root": [first["root"]], "part": [first["part"]], "parts": [first["parts"]],
        "entries": [len(files)], "content": [payload.getvalue()],
    })


def unpack_archives(archives: DataFrame, content: str = "content") -> DataFrame:
    """One row per file in tar.gz, tar or zip payloads, next to the payload's other columns.

    Names that are absolute or climb out of the tree get status ``unsafe`` and
    no content; a payload that cannot be read gives one row ``unreadable``.
    """
    kept = [f for f in archives.schema if f.name != content]
    names = [f.name for f in kept]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + ["rel_path string", "mode int", "size long", "content binary", "status string"]
    )

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*names, "rel_path", "mode", "size", "content", "status"]
        for batch in batches:
            for record in batch.to_dict("records"):
                base = [record[n] for n in names]
                rows, held = [], 0
                for entry in _entries(record[content]):
                    rows.append([*base, *entry])
                    held += entry[2] or 0
                    if held >= _FLUSH_BYTES:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return archives.select(*names, content).mapInPandas(unpack, schema)


def _entries(payload: bytes) -> Iterator[tuple]:
    try:
        if zipfile.is_zipfile(io.BytesIO(payload)):
            with zipfile.ZipFile(io.BytesIO(payload)) as archive:
                for item in archive.infolist():
                    if not item.is_dir():
                        yield _entry(item.filename, item.external_attr >> 16 & 0o7777,
                                     archive.read(item))
        else:
            with tarfile.open(fileobj=io.BytesIO(payload), mode="r:*") as archive:
                for item in archive:
                    if item.isfile():
                        yield _entry(item.name, item.mode & 0o7777, archive.extractfile(item).read())
    except (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError):
        yield None, None, None, None, "unreadable"


def _entry(name: str, mode: int, data: bytes) -> tuple:
    path = posixpath.normpath(name)
    if path.startswith("/") or path.split("/")[0] == "..":
        return name, mode, len(data), None, "unsafe"
    return path, mode, len(data), data, "ok"
