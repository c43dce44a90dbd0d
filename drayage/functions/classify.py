"""Classification of responses, states, statements and return codes."""

from __future__ import annotations

import signal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The session states of the job server.
WAITING_STATES = ("not_started", "starting", "busy")
FINISHED_STATES = ("killed", "success", "error")
STOPPED_STATES = ("error", "dead", "killed", "success")

UNKNOWN = "<unknown>"


def classify_response(status: Column, transport_error: Column) -> Column:
    """``ok``, ``retry`` or ``fatal`` for one request attempt."""
    return (
        F.when(transport_error, "retry")
        .when(status < 300, "ok")
        .when((status == 429) | (status >= 500), "retry")
        .otherwise("fatal")
    )


def classify_state(state: Column, goal: str) -> Column:
    """How an observed session state relates to what the caller waits for.

    ``ready``: done, wait or bad. ``closed``: deleted, finished or wait.
    ``follow``: stopped or live.
    """
    if goal == "ready":
        return F.when(state == "idle", "done").when(state.isin(*WAITING_STATES), "wait").otherwise("bad")
    if goal == "closed":
        return (
            F.when(state == "dead", "deleted")
            .when(state.isin(*FINISHED_STATES), "finished")
            .otherwise("wait")
        )
    if goal == "follow":
        return F.when(state.isin(*STOPPED_STATES), "stopped").otherwise("live")
    raise ValueError(f"unknown goal: {goal!r}")


def classify_statement(state: Column, output: Column) -> Column:
    """``pending``, ``failed``, ``error``, ``non_textual`` or ``ok``.

    ``output`` is a struct with a status and a map ``data`` of MIME type to text.
    """
    return (
        F.when(state.isin("waiting", "running"), "pending")
        .when(state != "available", "failed")
        .when(~output["status"].eqNullSafe(F.lit("ok")), "error")
        .when(F.try_element_at(output["data"], F.lit("text/plain")).isNull(), "non_textual")
        .otherwise("ok")
    )


def classify_returncode(code: Column) -> Column:
    """Struct of outcome (``running``, ``ok``, ``failed``, ``killed``) and signal name."""
    names = F.create_map(*[F.lit(v) for s in signal.Signals for v in (int(s), s.name)])
    outcome = (
        F.when(code.isNull(), "running")
        .when(code == 0, "ok")
        .when(code > 0, "failed")
        .otherwise("killed")
    )
    return F.struct(
        outcome.alias("outcome"),
        F.when(code < 0, F.try_element_at(names, (-code).cast("int"))).alias("signal"),
    )


def or_unknown(value: Column) -> Column:
    """Null and empty values as ``<unknown>``."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(UNKNOWN))


def refresh_record(record: Column, state: Column) -> Column:
    """A session record as re-read: without its log, and in the new state."""
    return record.dropFields("log").withField("state", state)
