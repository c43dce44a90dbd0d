"""Ranks, running sums and previous values that survive a hot key.

A window partitioned by a key puts all rows of that key into one task. The functions
here count the rows of each key, cut only the keys with more rows than a task should take
into order ranges, rank inside each range, and add what lies before the range. All other
keys take the plain window in the same pass. Cut points come from a sample of the hot keys
and steer balance only; the results are exact for any cut points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sampled rows for each range of a hot key.
SAMPLE_PER_RANGE = 64
# Rows of the sample at most; they are sorted by Spark and pass through the driver.
SAMPLE_ROWS = 131_072
ROWS_PER_TASK = 4_000_000
# Cut points at most, in all keys together; their tables are broadcast.
BROADCAST_POINTS = 8_192

_RANGE = "__range"
_CUTS = "__cuts"
_PART = "__part"


@dataclass(frozen=True)
class Cuts:
    """Sorted order cut points of each key that has too many rows for one task.

    There is about one for each ``rows_per_task`` rows of such keys, or less.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    points: dict[tuple, list[tuple]]

    @property
    def small(self) -> bool:
        """Whether a row for each range may be broadcast."""
        return sum(len(p) + 1 for p in self.points.values()) <= BROADCAST_POINTS


def plan_cuts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> Cuts | None:
    """Cut points for the keys of ``df`` with more than ``rows_per_task`` rows; None if there are none.

    Counts the rows of each key, combined before the shuffle, and samples the key and order
    columns of the hot keys alone. (keys, order) must identify a row. Where ranges of ``rows_per_task``
    rows would be more than ``BROADCAST_POINTS``, they are longer, so that cut points and sample
    stay bounded however long the table.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows_per_task)
    total = counts.agg(F.sum("__n")).first()[0] or 0
    # A key with more rows than this has less than two ranges for each so many.
    per_range = max(rows_per_task, -(-2 * total // BROADCAST_POINTS))
    hot = {tuple(r[k] for k in keys): r["__n"] for r in counts.filter(F.col("__n") > per_range).collect()}
    if not hot:
        return None
    ranges = {key: -(-n // per_range) for key, n in hot.items()}
    fields = T.StructType([df.schema[k] for k in keys])
    table = df.sparkSession.createDataFrame(list(hot), fields)
    picked = _lookup(
        df.select(*keys, *order), table.withColumn("__hot", F.lit(True)), keys, True
    ).filter("__hot").drop("__hot")
    wanted, rows = min(SAMPLE_PER_RANGE * sum(ranges.values()), SAMPLE_ROWS), sum(hot.values())
    if rows > wanted:
        picked = picked.sample(wanted / rows, seed=7)

    samples: dict[tuple, list[tuple]] = {}
    for row in picked.orderBy(*keys, *order).collect():
        samples.setdefault(tuple(row[k] for k in keys), []).append(tuple(row[c] for c in order))
    points: dict[tuple, list[tuple]] = {}
    for key, sample in samples.items():
        step = len(sample) / ranges[key]
        chosen = [sample[int(k * step)] for k in range(1, ranges[key])]
        points[key] = [p for n, p in enumerate(chosen) if n == 0 or p != chosen[n - 1]]
    points = {key: chosen for key, chosen in points.items() if chosen}
    return Cuts(tuple(keys), tuple(order), points) if points else None


def with_range(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add ``__range``, the number of cut points of its key at or before a row,
    and ``__cut``, whether its key has any.

    Two binary searches, among every so many cut points and then among those up to the next of them,
    so that no row meets all cut points of its key.
    """
    order = T.StructType([T.StructField(f"c{n}", df.schema[c].dataType) for n, c in enumerate(cuts.order)])
    lists = T.ArrayType(order)
    keys = [df.schema[c] for c in cuts.keys]
    longest = max(len(points) for points in cuts.points.values())
    step = max(1, int(longest**0.5))
    parts = [
        (*key, n, points[at : at + step])
        for key, points in cuts.points.items()
        # Part n lies behind n of the points in the first list.
        for n, at in enumerate(range(0, len(points) + 1, step))
    ]
    spark = df.sparkSession
    first = spark.createDataFrame(
        [(*key, points[step - 1 :: step]) for key, points in cuts.points.items()],
        T.StructType([*keys, T.StructField(_CUTS, lists)]),
    )
    second = spark.createDataFrame(parts, T.StructType([*keys, T.StructField(_PART, T.IntegerType()), T.StructField(_CUTS, lists)]))
    found = _lookup(df, first, cuts.keys, cuts.small).withColumn("__cut", F.col(_CUTS).isNotNull())
    found = found.withColumn(_PART, _passed(cuts.order, longest // step)).drop(_CUTS)
    found = _lookup(found, second, [*cuts.keys, _PART], cuts.small)
    return found.withColumn(
        _RANGE, F.coalesce(F.col(_PART) * step + _passed(cuts.order, step), F.lit(0))
    ).drop(_PART, _CUTS)


def _passed(order: Sequence[str], most: int) -> Column:
    """How many of the sorted points in ``__cuts``, ``most`` at most, are at or before a row."""
    row = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(order)])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))])

    def further(at: Column, by: Column) -> Column:
        # Structs compare as rows sort, nulls first.
        return F.when(
            (at + by <= F.size(_CUTS)) & (F.get(F.col(_CUTS), at + by - 1) <= row), at + by
        ).otherwise(at)

    return F.when(F.col(_CUTS).isNotNull(), F.aggregate(steps, F.lit(0), further))


def _lookup(df: DataFrame, small: DataFrame, keys: Sequence[str], few: bool) -> DataFrame:
    """Left join to one row per key, broadcast where they are known to be few; nulls are keys too."""
    renamed = small.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(renamed[f"__k_{k}"])
    return df.join(F.broadcast(renamed) if few else renamed, match, "left").drop(*[f"__k_{k}" for k in keys])


def _window(keys: Sequence[str], order: Sequence[str], ranged: bool):
    parts = [*keys, _RANGE] if ranged else list(keys)
    return Window.partitionBy(*parts).orderBy(*order)


def _before(ranged: DataFrame, cuts: Cuts, total: Column, name: str) -> DataFrame:
    """Per (cut key, range): the sum of ``total`` over the ranges before it."""
    per_range = ranged.filter("__cut").groupBy(*cuts.keys, _RANGE).agg(total.alias("__n"))
    earlier = Window.partitionBy(*cuts.keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(*cuts.keys, _RANGE, F.sum("__n").over(earlier).alias(name))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    cuts: Cuts | None,
) -> DataFrame:
    """Sum of ``value`` over the rows of the same key up to and including this one.

    Where there are cuts, ``df`` comes from :func:`with_range`.
    """
    upto = _window(keys, order, cuts is not None).rowsBetween(Window.unboundedPreceding, 0)
    if cuts is None:
        return df.withColumn(name, F.sum(value).over(upto))
    before = _before(df.withColumn("__v", value), cuts, F.sum("__v"), "__before")
    local = df.withColumn("__local", F.sum(value).over(upto))
    return (
        _lookup_range(local, before, cuts)
        .withColumn(name, F.col("__local") + F.coalesce("__before", F.lit(0)))
        .drop("__local", "__before")
    )


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "pos",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Number the rows of each key from 1 in ``order``, which must be unique per key.

    With no keys the whole table is numbered. One shuffle of the data where the cut points
    are few enough to broadcast; no task holds more than about ``rows_per_task`` rows of one key.
    """
    if not keys:
        # One key for all rows, always 0 but not a literal, so that the lookups
        # below stay hash joins.
        whole = df.withColumn("__all", F.pmod(F.xxhash64(*order), F.lit(1)))
        return positions(whole, ["__all"], order, name, rows_per_task).drop("__all")
    cuts = plan_cuts(df, keys, order, rows_per_task)
    if cuts is None:
        return df.withColumn(name, F.row_number().over(_window(keys, order, False)).cast("long"))
    ranged = with_range(df, cuts)
    before = _before(ranged, cuts, F.count(F.lit(1)), "__before")
    local = ranged.withColumn("__local", F.row_number().over(_window(keys, order, True)))
    return (
        _lookup_range(local, before, cuts)
        .withColumn(name, F.col("__local") + F.coalesce("__before", F.lit(0)))
        .drop("__local", "__before", _RANGE, "__cut")
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str,
    cuts: Cuts | None,
) -> DataFrame:
    """The value of ``column``, never null itself, in the row before; null on the first row.

    Where there are cuts, ``df`` comes from :func:`with_range`.
    """
    at = _window(keys, order, cuts is not None)
    if cuts is None:
        return df.withColumn(name, F.lag(column).over(at))
    last = df.filter("__cut").groupBy(*cuts.keys, _RANGE).agg(
        F.max_by(column, F.struct(*order)).alias("__last")
    )
    before = last.select(
        *cuts.keys, _RANGE,
        F.lag("__last").over(Window.partitionBy(*cuts.keys).orderBy(_RANGE)).alias("__before"),
    )
    local = df.withColumn("__local", F.lag(column).over(at))
    return (
        _lookup_range(local, before, cuts)
        .withColumn(name, F.coalesce("__local", "__before"))
        .drop("__local", "__before")
    )


def _lookup_range(df: DataFrame, before: DataFrame, cuts: Cuts) -> DataFrame:
    return _lookup(df, before, [*cuts.keys, _RANGE], cuts.small)


def first_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    name: str = "pos",
) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    Ranks twice: first among the rows of a key that share a salt taken from the
    map task, which leaves at most n rows per key and salt, then among those.
    """
    spark = df.sparkSession
    salts = max(1, min(1024, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    near = Window.partitionBy(*keys, "__salt").orderBy(*order)
    kept = salted.withColumn("__near", F.row_number().over(near)).filter(F.col("__near") <= n)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        kept.drop("__salt", "__near")
        .withColumn(name, F.row_number().over(final).cast("long"))
        .filter(F.col(name) <= n)
    )
