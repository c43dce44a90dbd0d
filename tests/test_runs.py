"""Statements, attempts, waits and lives on small tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayage.functions import classify
from drayage.operators import objects, outcomes, paging, statements


@pytest.fixture(scope="module")
def output(spark):
    data = [
        ("one", 0, "hello"), ("one", 1, "P 4 YWJj"), ("one", 2, "after"), ("one", 3, "P 4 ZGVm"),
        ("none", 0, "only"), ("none", 1, "print"), ("bad", 5, "P 9 YWJj"), (None, 0, "x"), (None, 1, "P 4 YWJj"), (None, 2, "y"),
    ]
    return spark.createDataFrame(data, "stmt_id string, pos int, line string")


def test_first_frame(output):
    got = {r.stmt_id: (r.frame_pos, r.data, r.status) for r in statements.first_frame(output, "P ").collect()}
    assert got == {
        "one": (1, None, "bad_prefix"), "none": (None, None, "no_frame"),
        "bad": (5, None, "len_mismatch"), None: (1, None, "bad_prefix"),
    }
    ok = statements.first_frame(output, "P").filter("stmt_id = 'one'").first()
    assert (ok.frame_pos, ok.data, ok.status) == (1, b"abc", "ok")


def test_printed_lines(output, rows):
    printed = statements.printed_lines(output, "P").filter("stmt_id IS NOT NULL")
    assert rows(printed) == [("none", 0, "only"), ("none", 1, "print"), ("one", 0, "hello")]
    assert statements.printed_lines(output, "P").filter("stmt_id IS NULL").count() == 1


def test_statement_classes(spark):
    schema = "id int, state string, output struct<status: string, data: map<string, string>>"
    text, image = {"text/plain": "x"}, {"image/png": "y"}
    data = [
        (1, "waiting", None), (2, "running", None), (3, "available", ("ok", text)),
        (4, "available", ("error", text)), (5, "available", ("ok", image)),
        (6, "cancelled", None), (7, "available", ("ok", None)), (8, "available", None),
    ]
    df = spark.createDataFrame(data, schema)
    got = df.select("id", classify.classify_statement(F.col("state"), F.col("output")).alias("c")).collect()
    assert [r.c for r in sorted(got)] == [
        "pending", "pending", "ok", "error", "non_textual", "failed", "non_textual", "error"
    ]


def test_errors_join_as_broadcast_hash(spark):
    df = spark.createDataFrame([(1, "TypeError"), (2, "Py4JError"), (3, None), (4, "print")], "id int, ename string")
    typed = statements.classify_errors(df)
    assert {r.id: r.error_type for r in typed.collect()} == {
        1: "TypeError", 2: "StatementError", 3: "StatementError", 4: "StatementError"
    }
    assert "BroadcastHashJoin" in typed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("tries, codes, expected", [
    (3, [503, 503, 200], ("ok", 3, 0.02)),
    (3, [503, 404, 200], ("fatal", 2, 0.01)),
    (3, [503, 503, 503], ("exhausted", 3, 0.02)),
    (3, [503, 503, 503, 200], ("exhausted", 3, 0.02)),
    (2, [429, 200], ("ok", 2, 0.01)),
    (2, [503, 503], ("exhausted", 2, 0.01)),
    (1, [503, 200], ("exhausted", 1, 0.0)),
    (1, [200], ("ok", 1, 0.0)),
    (3, [None, 503], ("incomplete", 2, 0.01)),
])
def test_attempt_outcome(spark, tries, codes, expected):
    data = [("k", i + 1, code, code is None) for i, code in enumerate(codes)]
    df = spark.createDataFrame(data, "key string, att int, status int, transport_error boolean")
    r = outcomes.attempt_outcome(df, tries, 0.01).first()
    assert (r.outcome, r.used, r.slept) == expected


def test_wait_outcome(spark):
    t0 = datetime(2024, 1, 1)
    series = {"up": "starting busy idle", "slow": "starting busy busy busy idle", "bad": "busy dead idle", "new": "busy"}
    data = [(s, t0 + timedelta(seconds=i), i, state)
            for s, states in series.items() for i, state in enumerate(states.split())]
    df = spark.createDataFrame(data, "session_id string, ts timestamp, event_id int, state string")
    got = outcomes.wait_outcome(df, "ready", 4, 2.0).collect()
    assert {r.session_id: (r.outcome, r.polls, r.waited) for r in got} == {
        "up": ("done", 3, 4.0), "slow": ("timed_out", 4, 6.0), "bad": ("bad", 2, 2.0), "new": ("waiting", 1, 0.0),
    }
    last = {r.session_id: r.state for r in outcomes.latest_state(df).collect()}
    assert last == {"up": "idle", "slow": "idle", "bad": "idle", "new": "busy"}


@pytest.fixture(scope="module")
def beats(spark):
    """One session has most of the beats."""
    n = F.col("id")
    at = F.timestamp_seconds(1_700_000_000 + n * 7 + F.pmod(F.hash("id"), F.lit(40)))
    return spark.range(4_000).select(F.when(n % 3 == 0, n % 20).otherwise(99).alias("session_id"), at.alias("ts")).cache()


@pytest.mark.parametrize("ttl", [5, 20, 60])
def test_lives_are_the_same_cut_or_not(beats, rows, ttl):
    whole = outcomes.expire_sessions(beats, ttl)
    cut = outcomes.expire_sessions(beats, ttl, rows_per_task=300)
    assert rows(whole) == rows(cut)
    assert whole.agg(F.sum("beats")).first()[0] == 4_000


@pytest.mark.parametrize("per_task", [1, 100])
def test_a_beat_at_the_end_of_life_extends(spark, per_task):
    t0 = datetime(2024, 1, 1)
    data = [("s", t0 + timedelta(seconds=s)) for s in (0, 10, 20, 31)]
    df = spark.createDataFrame(data, "session_id string, ts timestamp")
    got = outcomes.expire_sessions(df, 10, rows_per_task=per_task).orderBy("born_at").collect()
    assert [(r.beats, r.dead_at - t0) for r in got] == [(3, timedelta(seconds=30)), (1, timedelta(seconds=41))]


@pytest.mark.parametrize("per_task", [1_000, 2])
def test_heartbeats_without_a_time_count_nowhere(spark, per_task):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0), ("a", None), ("a", t0 + timedelta(seconds=5)), ("a", t0 + timedelta(seconds=90)), ("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "session_id string, ts timestamp")
    got = outcomes.expire_sessions(df, 10, rows_per_task=per_task).orderBy("born_at").collect()
    assert [(r.session_id, r.beats) for r in got] == [("a", 2), ("a", 1)]


def test_deep_page_is_in_order(spark):
    df = spark.range(250_000).selectExpr("id", "250000 - id AS back").repartition(8)
    page = paging.offset_page(df, ["back"], 120_000, 40_000)
    assert [r.back for r in page.collect()] == list(range(120_001, 160_001))


def test_objects(spark):
    written = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)],
                                    "name string, version int, value string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    got = {r.name: (r.value, r.found) for r in objects.lookup_objects(asked, written).collect()}
    assert got == {"a": ("z", True), "b": (None, True), "c": (None, False)}


def test_pages(spark):
    df = spark.range(105)
    assert [r.id for r in paging.offset_page(df, ["id"], 100, 20).collect()] == list(range(100, 105))
    assert paging.offset_page(df, ["id"], 200, 20).isEmpty()
    for per_task in (10, 1_000):
        paged = paging.assign_pages(df, ["id"], 20, per_task)
        assert {(r.id, r.page) for r in paged.collect()} == {(i, i // 20) for i in range(105)}


def test_deep_page_avoids_top_k(spark):
    df = spark.range(250_000)
    page = paging.offset_page(df, ["id"], 200_000, 3)
    assert [r.id for r in page.collect()] == [200_000, 200_001, 200_002]
    assert "TakeOrdered" not in page._jdf.queryExecution().executedPlan().toString()


def test_new_items_and_duplicates(spark, rows):
    before = spark.createDataFrame([(1,), (2,)], "id int")
    now = spark.createDataFrame([(2, "b"), (3, "c")], "id int, name string")
    assert rows(paging.new_items(before, now, "id")) == [(3, "c")]
    names = spark.createDataFrame([("x",), ("y",), ("x",)], "name string")
    assert rows(outcomes.duplicate_names(names)) == [("x", 2)]


def test_missing_refs(spark, rows):
    tasks = spark.createDataFrame([(1, "A"), (2, "B")], "id int, class_name string")
    registry = spark.createDataFrame([("A",)], "class_name string")
    assert rows(objects.missing_refs(tasks, registry).select("id", "class_name")) == [(2, "B")]


def test_follow_end(spark):
    polls = spark.createDataFrame([(s, p, 10 * p + 9) for s in "abcde" for p in range(5)], "source string, poll long, at long")
    delta = spark.createDataFrame([("a", 0), ("a", 0), ("a", 1), ("a", 3), ("b", 0), ("d", 4)], "source string, poll long")
    observed = spark.createDataFrame(
        [
            ("a", 5, "busy", 200), ("a", 12, "success", 200), ("a", 30, "busy", 200),  # lines in poll 1, none in 2
            ("b", 20, None, 404),  # gone
            ("c", 5, "idle", 200), ("c", 6, None, 200),  # never stops
            ("d", 41, "killed", 200),  # lines in the last poll
            ("z", 1, "dead", 200),  # never polled
        ],
        "source string, at long, state string, status int",
    )
    rows = {r.source: tuple(r)[1:] for r in outcomes.follow_end(polls, delta, observed).collect()}
    assert rows == {
        "a": (2, "success", 12), "b": (2, "dead", 20), "c": (None, None, None),
        "d": (None, "killed", 41), "e": (None, None, None),
    }
    assert outcomes.follow_end(polls.limit(0), delta, observed).count() == 0
    # The same from one row per source, as the polls are regular.
    spans = polls.groupBy("source").agg(F.min("poll").alias("first"), F.max("poll").alias("last"))
    regular = outcomes.follow_end_regular(spans, delta, observed, start=9, every=10)
    assert {r.source: tuple(r)[1:] for r in regular.collect()} == rows


def test_regular_polls_take_no_row_each(spark):
    """A thousand million polls, one line; the stop comes before the first poll."""
    spans = spark.createDataFrame([("a", 0, 10**9), ("b", 3, 10**9)], "source string, first long, last long")
    delta = spark.createDataFrame([("a", 0), ("a", 1), ("b", 10**9)], "source string, poll long")
    observed = spark.createDataFrame([("a", -5, "dead", 200), ("b", 10**12, "killed", 200)], "source string, at long, state string, status int")
    found = outcomes.follow_end_regular(spans, delta, observed, start=0, every=1000)
    assert {tuple(r) for r in found.collect()} == {("a", 2, "dead", -5), ("b", None, "killed", 10**12)}
