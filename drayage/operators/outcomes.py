"""Outcomes of waiting, retrying and living, judged from recorded observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.functions.classify import classify_response, classify_state
from drayage.operators import ranking
from drayage.session import materialized


def latest_state(states: DataFrame, key: str = "session_id") -> DataFrame:
    """Last observed state of each session."""
    at = F.struct("ts", "event_id")
    return states.groupBy(key).agg(
        F.max_by("state", at).alias("state"), F.max("ts").alias("observed_at")
    )


def first_terminal(df: DataFrame, key: str, pos: str, klass: Column, waiting: str) -> DataFrame:
    """Per key: where the first row outside the waiting class is, its class, and the last row.

    A single aggregation that combines before the shuffle.
    """
    ended = klass != waiting
    return df.groupBy(key).agg(
        F.min(F.when(ended, F.col(pos))).alias("end_pos"),
        F.min_by(F.when(ended, klass), F.when(ended, F.col(pos))).alias("end_class"),
        F.max(pos).alias("last_pos"),
    )


def wait_outcome(
    states: DataFrame, goal: str, max_tries: int, pause: float, key: str = "session_id"
) -> DataFrame:
    """Result of polling until a terminal state, within ``max_tries`` observations.

    ``timed_out`` used up its tries, ``waiting`` has tries left.
    """
    polls = ranking.first_n(states, [key], [F.col("ts"), F.col("event_id")], max_tries, "poll")
    ends = first_terminal(polls, key, "poll", classify_state(F.col("state"), goal), "wait")
    used = F.coalesce("end_pos", "last_pos")
    outcome = F.coalesce(
        "end_class", F.when(F.col("last_pos") >= max_tries, "timed_out").otherwise("waiting")
    )
    return ends.select(
        key, outcome.alias("outcome"), used.alias("polls"), ((used - 1) * pause).alias("waited")
    )


def attempt_outcome(
    attempts: DataFrame, max_tries: int, pause: float, key: str = "key"
) -> DataFrame:
    """Result of each bounded retry: ``ok``, ``fatal``, ``exhausted`` or ``incomplete``.

    ``max_tries`` counts all calls and the pause between two calls is constant.
    """
    klass = classify_response(F.col("status"), F.col("transport_error"))
    made = attempts.filter(F.col("att") <= max_tries)
    ends = first_terminal(made, key, "att", klass, "retry")
    used = F.coalesce("end_pos", "last_pos")
    outcome = F.coalesce(
        "end_class", F.when(F.col("last_pos") >= max_tries, "exhausted").otherwise("incomplete")
    )
    return ends.select(
        key, outcome.alias("outcome"), used.alias("used"), ((used - 1) * pause).alias("slept")
    )


def duplicate_names(sessions: DataFrame, name: str = "name") -> DataFrame:
    """Names held by more than one session."""
    return sessions.groupBy(name).agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1")


def expire_sessions(
    beats: DataFrame,
    ttl_seconds: int,
    key: str = "session_id",
    rows_per_task: int = ranking.ROWS_PER_TASK,
) -> DataFrame:
    """Lives of each session: a heartbeat within ``ttl_seconds`` of the last one extends.

    Sessions with more heartbeats than one task should take are cut; without such ones all
    go through Spark's session window. Both give the same rows.
    A heartbeat without a time counts nowhere.
    """
    moments = beats.filter(F.col("ts").isNotNull()).groupBy(key, "ts").agg(F.count(F.lit(1)).alias("n"))
    cuts = ranking.plan_cuts(moments, [key], ["ts"], rows_per_task)
    whole = [F.min("ts").alias("born_at"), F.max("ts").alias("last_beat"), F.sum("n").alias("beats")]
    if cuts is None:
        lives = moments.groupBy(key, F.session_window("ts", f"{ttl_seconds} seconds")).agg(*whole)
    else:
        # Read several times below.
        ranged = ranking.with_range(materialized(moments, "moments"), cuts)
        seen = ranking.previous_value(ranged, [key], ["ts"], "ts", "previous", cuts)
        gap = F.unix_micros("ts") - F.unix_micros("previous")
        fresh = F.when(F.col("previous").isNull() | (gap > ttl_seconds * 1_000_000), 1).otherwise(0)
        numbered = ranking.running_sum(seen, [key], ["ts"], fresh, "life", cuts)
        lives = numbered.groupBy(key, "life").agg(*whole)
    return lives.select(
        key, "born_at", "last_beat", "beats",
        (F.col("last_beat") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("dead_at"),
    )


def follow_end(polls: DataFrame, delta: DataFrame, observed: DataFrame) -> DataFrame:
    """For each source of ``polls(source, poll, at)`` the poll with which following it ends.

    A source stops at the first of ``observed(source, at, state, status)`` whose state is terminal;
    a 404 counts as ``dead``. What is observed later changes nothing. The first poll at or after
    that time without a line in ``delta(source, poll)`` ends it, as lines may still come before.
    ``end_poll`` is null while it goes on, ``final_state`` and ``stopped_at`` while it runs.
    Only aggregations and joins by key; sources are not null.
    """
    stops = _stops(observed)
    fresh = delta.groupBy("source", "poll").agg(F.lit(True).alias("fresh"))
    seen = polls.join(fresh, ["source", "poll"], "left").join(stops, "source", "left")
    idle = F.col("fresh").isNull() & (F.col("at") >= F.col("stop.at"))
    return seen.groupBy("source").agg(
        F.min(F.when(idle, F.col("poll"))).alias("end_poll"),
        F.max("stop.state").alias("final_state"),
        F.max("stop.at").alias("stopped_at"),
    )


def follow_end_regular(
    polls: DataFrame, delta: DataFrame, observed: DataFrame, start: int, every: int
) -> DataFrame:
    """:func:`follow_end` for polls at regular times, without a row for each of them.

    ``polls(source, first, last)`` has one row per source; its poll ``p`` is at ``start + p * every``.
    Following can only end with the first poll from the stop on or with one right after a poll that
    shows something, so the rows grow with ``delta`` and not with the polls of all sources.
    """
    stops = _stops(observed)
    # ceil((at - start) / every) in whole numbers.
    due = F.expr(f"(stop.at - {start}) div {every}") + F.when(
        F.expr(f"(stop.at - {start}) % {every}") > 0, 1
    ).otherwise(0)
    begun = polls.join(stops, "source", "left").withColumn("due", F.greatest("first", due))
    begun = begun.withColumn("due", F.when(F.col("stop.at").isNotNull(), F.col("due")))
    shown = delta.select("source", "poll").distinct().select(
        "source", F.explode(F.array(
            F.struct("poll", F.lit(True).alias("fresh")),
            F.struct((F.col("poll") + 1).alias("poll"), F.lit(False).alias("fresh")),
        )).alias("at"),
    ).select("source", "at.*")
    starts = begun.filter(F.col("due").isNotNull()).select("source", F.col("due").alias("poll"), F.lit(False).alias("fresh"))
    idle = shown.unionByName(starts).groupBy("source", "poll").agg(F.max("fresh").alias("fresh")).filter("NOT fresh")
    ended = idle.join(begun.select("source", "due", "last"), "source").filter(
        F.col("poll").between(F.col("due"), F.col("last"))
    ).groupBy("source").agg(F.min("poll").alias("end_poll"))
    return begun.join(ended, "source", "left").select(
        "source", "end_poll", F.col("stop.state").alias("final_state"), F.col("stop.at").alias("stopped_at")
    )


def _stops(observed: DataFrame) -> DataFrame:
    """``stop``, the time and state of the first terminal observation of each source, null without one."""
    state = F.when(F.col("status") == 404, "dead").otherwise(F.col("state"))
    stopped = classify_state(state, "follow") == "stopped"
    return observed.groupBy("source").agg(
        F.min(F.when(stopped, F.struct("at", state.alias("state")))).alias("stop")
    )
