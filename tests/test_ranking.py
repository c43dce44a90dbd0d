"""Ranking over cut keys equals a plain window, also where one key has most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from drayage.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to key 7, some to the null key, the rest to 50 keys."""
    n = F.col("id")
    key = F.when(n % 2 == 0, 7).when(n % 11 == 1, F.lit(None)).otherwise(n % 50)
    return spark.range(20_000).select(
        key.alias("k"), F.hash("id").alias("t"), n.alias("n")
    ).repartition(6).cache()


def same(a, b):
    """The same rows, found in one job."""
    signed = a.withColumn("sign", F.lit(1)).unionByName(b.withColumn("sign", F.lit(-1)))
    return signed.groupBy(b.columns).agg(F.sum("sign").alias("left")).filter("left <> 0").isEmpty()


def at():
    return Window.partitionBy("k").orderBy("t", "n")


@pytest.mark.parametrize("per_task", [700, 1_000_000])
def test_positions(skewed, per_task):
    expected = skewed.withColumn("pos", F.row_number().over(at()).cast("long"))
    assert same(ranking.positions(skewed, ["k"], ["t", "n"], "pos", per_task), expected)


@pytest.mark.parametrize("per_task", [300, 1_000_000])
def test_positions_of_whole_table(skewed, per_task):
    expected = skewed.withColumn("pos", F.row_number().over(Window.orderBy("t", "n")).cast("long"))
    assert same(ranking.positions(skewed, [], ["t", "n"], "pos", per_task), expected)


def test_hot_key_is_cut(skewed):
    cuts = ranking.plan_cuts(skewed, ["k"], ["t", "n"], 500)
    assert len(cuts.points[(7,)]) >= 15
    sizes = ranking.with_range(skewed, cuts).filter("k = 7").groupBy("__range").count()
    assert sizes.agg(F.max("count")).first()[0] < 1_500


def test_small_table_is_not_cut(skewed):
    assert ranking.plan_cuts(skewed, ["k"], ["t", "n"]) is None


def test_only_hot_keys_are_cut(skewed):
    """50 keys of 200 rows each are far more rows than a task takes, but none is hot."""
    cuts = ranking.plan_cuts(skewed, ["k"], ["t", "n"], 2_000)
    assert set(cuts.points) == {(7,)}
    cold = ranking.with_range(skewed, cuts).filter("NOT k <=> 7")
    assert cold.filter("__cut OR __range <> 0").isEmpty()
    assert ranking.plan_cuts(skewed.filter("k <> 7"), ["k"], ["t", "n"], 2_000) is None


def test_many_cut_points_are_not_broadcast(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_POINTS", 3)
    expected = skewed.withColumn("pos", F.row_number().over(at()).cast("long"))
    assert same(ranking.positions(skewed, ["k"], ["t", "n"], "pos", 700), expected)


def test_cut_points_stay_bounded(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_POINTS", 8)
    cuts = ranking.plan_cuts(skewed, ["k"], ["t", "n"], 100)
    assert cuts.small and 2 <= len(cuts.points[(7,)]) <= 8


def test_many_ranges_of_one_table(spark):
    """A thousand cut points are planned and searched; nulls sort first."""
    df = spark.range(20_000).select(F.when(F.col("id") % 5 > 0, F.hash("id") % 100).alias("t"), "id")
    expected = df.withColumn("pos", F.row_number().over(Window.orderBy("t", "id")).cast("long"))
    assert same(ranking.positions(df, [], ["t", "id"], "pos", 20), expected)


def test_previous_value_and_running_sum(skewed):
    cuts = ranking.plan_cuts(skewed, ["k"], ["t", "n"], 500)
    ranged = ranking.with_range(skewed, cuts)
    seen = ranking.previous_value(ranged, ["k"], ["t", "n"], "n", "before", cuts)
    summed = ranking.running_sum(seen, ["k"], ["t", "n"], F.col("n"), "total", cuts)
    expected = skewed.withColumns({"before": F.lag("n").over(at()), "total": F.sum("n").over(at())})
    assert same(summed.select(expected.columns), expected)


@pytest.mark.parametrize("n", [1, 12, 2_000])
def test_first_n(skewed, n):
    ranked = skewed.withColumn("pos", F.row_number().over(at()).cast("long")).filter(F.col("pos") <= n)
    assert same(ranking.first_n(skewed, ["k"], [F.col("t"), F.col("n")], n), ranked)


def test_ties_between_cut_points(spark):
    """Few distinct order values: equal cut points collapse and nothing is lost."""
    df = spark.range(3_000).select(F.lit("a").alias("k"), (F.col("id") % 3).alias("t"), "id")
    got = ranking.positions(df, ["k"], ["t", "id"], "pos", 100)
    assert got.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first() == (3_000, 1, 3_000)
