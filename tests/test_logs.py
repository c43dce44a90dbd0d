"""Poll delta and drain against plain Python on small random inputs."""

import random

import pytest
from pyspark.sql import functions as F

from drayage.operators import logs

SNAPSHOTS = "source string, poll int, pos long, line string"


def random_pages(seed):
    """Rotating pages of three sources over few different lines, nulls among them."""
    rng = random.Random(seed)
    data = []
    for source in ("a", "b", None):
        history = [rng.choice(["x", "y", "z", None]) for _ in range(80)]
        for poll in range(12):
            if rng.random() < 0.15:
                continue  # an empty page
            low = rng.randint(0, 3) + poll * 5
            data += [(source, poll, i, history[i]) for i in range(low, low + rng.randint(1, 12))]
    return data


def delta(data):
    """The kept lines, found page by page."""
    pages = {}
    for source, poll, pos, line in data:
        pages.setdefault((source, poll), []).append((pos, line))
    kept = set()
    for (source, poll), page in pages.items():
        before = {line for _, line in pages.get((source, poll - 1), [])}
        page = sorted(page)
        while page and page[0][1] in before:
            page.pop(0)
        kept |= {(source, poll, pos, line) for pos, line in page}
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_poll_delta(spark, seed):
    data = random_pages(seed)
    got = logs.poll_delta(spark.createDataFrame(data, SNAPSHOTS))
    assert {tuple(r) for r in got.collect()} == delta(data)


def test_poll_delta_edges(spark, rows):
    data = [("s", 0, 0, "a"), ("s", 0, 1, "b"),   # first page: all new
            ("s", 1, 0, "b"), ("s", 1, 1, "a"),   # all seen: nothing
            ("s", 2, 0, "a"), ("s", 2, 1, "c"), ("s", 2, 2, "a")]  # repeats after news stay
    got = logs.poll_delta(spark.createDataFrame(data, SNAPSHOTS))
    assert rows(got) == [("s", 0, 0, "a"), ("s", 0, 1, "b"), ("s", 2, 1, "c"), ("s", 2, 2, "a")]


@pytest.mark.parametrize("per_task", [3, 1_000])
def test_drain(spark, per_task):
    """Lines first, then the code in a poll without lines."""
    output = spark.createDataFrame([(1, 10 * i, f"l{i}") for i in range(7)] + [(2, 5, "one")],
                                   "pid int, pos long, line string")
    exits = spark.createDataFrame([(1, 42), (2, 0), (3, -15)], "pid int, returncode int")
    got = logs.drain_batches(output, exits, 3, per_task).collect()
    polls = {}
    for r in sorted(got, key=lambda r: (r.pid, r.poll, r.pos or 0)):
        code, lines = polls.setdefault((r.pid, r.poll), (r.returncode, []))
        lines += [r.line] if r.line else []
    assert polls == {
        (1, 0): (None, ["l0", "l1", "l2"]), (1, 1): (None, ["l3", "l4", "l5"]), (1, 2): (None, ["l6"]),
        (1, 3): (42, []), (2, 0): (None, ["one"]), (2, 1): (0, []), (3, 0): (-15, []),
    }


def test_drain_of_full_batches(spark):
    output = spark.createDataFrame([(1, i, "x") for i in range(6)], "pid int, pos long, line string")
    exits = spark.createDataFrame([(1, 0)], "pid int, returncode int")
    assert logs.drain_batches(output, exits, 3).filter("returncode IS NOT NULL").first().poll == 2


def test_tail_lines(spark, rows):
    lines = spark.createDataFrame([("a", i, str(i)) for i in range(9)] + [("b", 0, "z")],
                                  "source string, pos long, line string")
    assert rows(logs.tail_lines(lines, 2).select("source", "line")) == [("a", "7"), ("a", "8"), ("b", "z")]


def test_delivery_lag(spark):
    data = [("h", 10.0, 9.0), ("h", 10.0, 12.5), ("h", 10.0, 17.0)]
    df = spark.createDataFrame(data, "host string, a double, b double").select(
        "host", F.col("a").cast("timestamp").alias("stamped_at"), F.col("b").cast("timestamp").alias("received_at"))
    assert tuple(logs.delivery_lag(df, ["host"]).first()) == ("h", 3, 7_000_000, 10_500_000, 2)
