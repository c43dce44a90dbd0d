"""Digests, comparison and shape checks of directory trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS = 4  # 32-bit words of an MD5 digest


def tree_digest(tree: DataFrame, root: str = "root") -> DataFrame:
    """Files, bytes and a digest per root that does not depend on file order.

    The digest adds up the MD5 words of every (path, content digest), each
    modulo 2**32. Sums combine before the shuffle, so a root may hold any number
    of files.
    """
    # Digested in a projection of its own: inside the sums it would run once per word.
    entries = tree.select(
        root,
        F.octet_length("content").cast("long").alias("bytes"),
        F.md5(F.concat("rel_path", F.lit(":"), F.md5("content"))).alias("entry"),
    )
    words = [
        F.sum(F.conv(F.substring("entry", 8 * w + 1, 8), 16, 10).cast("decimal(20,0)")).alias(f"w{w}")
        for w in range(_WORDS)
    ]
    sums = entries.groupBy(root).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), *words
    )
    parts = [
        F.lpad(F.lower(F.hex((F.col(f"w{w}") % 2**32).cast("long"))), 8, "0") for w in range(_WORDS)
    ]
    return sums.select(root, "files", "bytes", F.concat(*parts).alias("digest"))


def fingerprint(tree: DataFrame) -> DataFrame:
    """Path, size, digest and mode of each file, for comparing without the content."""
    mode = F.col("mode") if "mode" in tree.columns else F.lit(None).cast("int")
    return tree.select(
        "rel_path",
        F.octet_length("content").cast("long").alias("size"),
        F.md5("content").alias("digest"),
        mode.alias("mode"),
    )


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Compare two fingerprinted trees: ``added``, ``removed``, ``changed`` or ``same``.

    Content is digested before the shuffle; only fingerprints travel.
    """
    a, b = source.alias("a"), target.alias("b")
    same = F.lit(True)
    for column in ("size", "digest", "mode"):
        same = same & F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))
    status = (
        F.when(F.col("b.rel_path").isNull(), "removed")
        .when(F.col("a.rel_path").isNull(), "added")
        .when(same, "same")
        .otherwise("changed")
    )
    return a.join(b, F.col("a.rel_path") == F.col("b.rel_path"), "full").select(
        F.coalesce("a.rel_path", "b.rel_path").alias("rel_path"),
        status.alias("status"),
        F.col("a.size").alias("source_size"),
        F.col("b.size").alias("target_size"),
    )


def top_level(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def single_root(entries: DataFrame, archive: str = "archive") -> DataFrame:
    """Whether each archive holds one top-level item that is a directory.

    Reduced per (archive, item) first, so a huge archive is counted by many tasks.
    """
    items = entries.groupBy(archive, top_level(F.col("path")).alias("item")).agg(
        F.bool_and(F.contains("path", F.lit("/"))).alias("is_dir")
    )
    return items.groupBy(archive).agg(
        F.count(F.lit(1)).alias("items"),
        ((F.count(F.lit(1)) == 1) & F.bool_and("is_dir")).alias("valid"),
    )
