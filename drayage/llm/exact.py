"""Exact dedup by a content sort.

Splitters taken from a sample cut the order of the normalised texts into ranges;
each range is sorted externally, so that equal texts lie next to each other, and
each text is compared in full with its neighbour. A group of copies larger than a
range is cut by the splitters as well; the parts of such groups, at most two runs
for each range, are put together afterwards by comparing their texts in full.

Texts are equal when identical after deleting white space. Of equal texts the row
with the most code points in its original text stays, then the smallest id; a null
id sorts last. A null text counts as empty; rows repeated with the same id and
text are rows of one group, of which one stays. An empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drayage.llm.frames import numbered, stored, without_spaces

#: Splitters are made of this many leading characters and a hash of the whole text.
#: They steer which range a text goes to; texts are compared whole.
HEAD_CHARS = 16
#: Ranges for each shuffle partition, and sampled rows for each range.
RANGES_PER_PARTITION = 8
SAMPLE_PER_RANGE = 24


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id`` (the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    runs = _runs(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    size = F.count(F.lit(1)).over(Window.partitionBy("bucket", "run"))
    light = runs.select(
        "c0", "bucket", "run", "first", "cut", "own", "head", "sha",
        F.when(F.col("first") & F.col("cut"), F.col("norm")).alias("norm"),
    )
    parts = stored(light.withColumn("size", size), "exact")
    fixes = _whole_groups(parts.filter("first AND cut"))
    best = F.coalesce("best", "head")
    return parts.join(F.broadcast(fixes), ["bucket", "run"], "left").select(
        F.col("c0").alias("doc_id"),
        best["id"].alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("first") & (F.col("own") == best)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    heads = _runs(docs, id_col, text_col).filter("first")
    parts = stored(
        heads.select(*columns, "bucket", "run", "cut", "own", F.when(F.col("cut"), F.col("norm")).alias("norm")),
        "distinct",
    )
    fixes = _whole_groups(parts.filter("cut").withColumn("size", F.lit(1).cast("long")))
    return (
        parts.join(F.broadcast(fixes), ["bucket", "run"], "left")
        .filter(F.col("best").isNull() | (F.col("own") == F.col("best")))
        .select(*columns)
        .toDF(*docs.columns)
    )


def _runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows sorted by content within ranges: ``run`` numbers the groups of equal
    neighbours of a range, ``first`` marks the row of a run that stays, ``head`` is that
    row's ``own`` and ``cut`` tells that a splitter may lie inside the group."""
    docs, names = numbered(docs)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    id_ = F.col(names[id_col])
    own = F.struct(
        (-F.length(text)).alias("less"), id_.isNull().alias("no_id"), id_.alias("id")
    )
    norm = without_spaces(text)
    keyed = docs.withColumn("norm", norm).select(
        *docs.columns,
        F.substring("norm", 1, HEAD_CHARS).alias("start"),
        F.xxhash64("norm").alias("hash"),
        own.alias("own"),
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("start", "hash", "own.less", "own.no_id", "own.id")
    weighed = keyed.select(key.alias("key"), F.length(text).cast("long").alias("weight"))
    splitters, cuts = _splitters(weighed, docs.count(), partitions * RANGES_PER_PARTITION)
    bucket = _passed(key, splitters, cuts)
    here = keyed.withColumn("bucket", bucket)
    around = [F.get(splitters["hash"], F.col("bucket") + at) for at in (-1, 0)]
    cut = F.coalesce(F.col("hash") == around[0], F.lit(False)) | F.coalesce(
        F.col("hash") == around[1], F.lit(False)
    )
    dealt = here.withColumn("cut", cut if cuts else F.lit(False)).repartition(partitions, "bucket")

    order = Window.partitionBy("bucket").orderBy("start", "hash", "norm", "own")
    first = F.lag("norm").over(order)
    sorted_ = dealt.withColumn("norm", norm).withColumn("first", ~first.eqNullSafe(F.col("norm")))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return sorted_.withColumns({
        "run": F.sum(F.col("first").cast("long")).over(upto),
        "head": F.last(F.when(F.col("first"), F.col("own")), ignorenulls=True).over(upto),
        "sha": F.sha2("norm", 256),
    })


def _whole_groups(edges: DataFrame) -> DataFrame:
    """Puts the runs of cut groups together. One row for each of them, at most two for a
    range but for equal hashes of different texts, so few enough to broadcast."""
    same = Window.partitionBy("norm")
    return edges.select(
        "bucket", "run", F.min("own").over(same).alias("best"), F.sum("size").over(same).alias("total")
    )


def _splitters(weighed: DataFrame, rows: int, ranges: int) -> tuple[Column, int]:
    """Keys that cut the sampled order into ranges of like weight, as an array literal.

    The sample holds about ``SAMPLE_PER_RANGE`` short keys for each range whatever the
    size of the table. It steers balance only: any splitters give the same groups.
    """
    wanted = ranges * SAMPLE_PER_RANGE
    part = weighed if rows <= wanted else weighed.sample(min(1.0, wanted / rows), seed=11)
    sample = sorted(part.collect(), key=lambda r: _order(r["key"]))
    # Half of the weight of a row is its length, half is that it is a row.
    mean = sum(r["weight"] for r in sample) / max(1, len(sample)) or 1
    step = 2 * len(sample) / ranges
    points, passed = [], 0.0
    for row in sample:
        passed += 1 + row["weight"] / mean
        if step and passed >= step * (len(points) + 1) and len(points) < ranges - 1:
            if not points or points[-1] != row["key"]:
                points.append(row["key"])
    schema = weighed.select(F.array("key").alias("a")).schema["a"].dataType
    return F.from_json(F.lit(json.dumps([p.asDict() for p in points])), schema), len(points)


def _order(key) -> tuple:
    return (key["start"].encode(), key["hash"], key["less"], key["no_id"], key["id"] or 0)


def _passed(key: Column, splitters: Column, cuts: int) -> Column:
    """How many splitters lie at or before ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, cuts.bit_length())))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= cuts) & (F.get(splitters, low + step - 1) <= key), low + step
        ).otherwise(low),
    )
