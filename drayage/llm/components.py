"""Connected components of a table of links, by rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.session import materialized


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for each node of ``links(a, b)``.

    Each round replaces the neighbours of a node by links to the smallest of them, first for
    the larger neighbours, then for the smaller ones; the links become stars around the roots
    after a number of rounds that grows with the logarithm of the longest path. Minima are
    combined before the shuffle. Each round is a table in the shared folder, so that a lost
    executor costs no earlier round.
    """
    links = materialized(links.filter("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        larger = _star(links.union(links.select("b", "a")), larger=True)
        links = materialized(
            _star(larger.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), larger=False),
            "links",
        )
        # Equal sums over two rounds: the links have come to rest.
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links each neighbour of ``a`` (the larger ones, or all where all are smaller) to the
    smallest among ``a`` and its neighbours. The smallest is known for each ``a`` beforehand,
    so the neighbours of a node never meet in one task; the join deals a hot node out."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("of"), F.least("a", "m").alias("m")
    )
    joined = links.join(least, F.col("a") == F.col("of"))
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # ``a`` itself keeps its link to the smallest.
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("of").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()
