"""Line, log-text and template expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drayage.functions.binding import let

EOL = "\r\n"
LAST_SECOND = 253_402_300_800


def split_lines(text: Column) -> Column:
    """The lines of a text without their ends; a final line end adds no empty line."""
    def trimmed(lines: Column) -> Column:
        return F.when(
            F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)
        ).otherwise(lines)

    return let(F.split(text, "\r?\n"), trimmed)


def strip_eol(line: Column) -> Column:
    """Drop every trailing carriage return and line feed."""
    return F.rtrim(line, F.lit(EOL))


def parse_log_line(line: Column) -> Column:
    """Split ``LEVEL time: message`` or ``epoch: message`` at the first ``': '``.

    Gives a struct of level, stamped_at and message. A line in neither shape is
    all message.
    """
    def read(head: Column) -> Column:
        iso = F.try_to_timestamp(F.nullif(F.regexp_extract(head, r"^[A-Z]+ (\S+)$", 1), F.lit("")))
        epoch = F.nullif(F.regexp_extract(head, r"^(\d+(?:\.\d+)?)$", 1), F.lit(""))
        # Numbers that are no time before the year 10000 stamp nothing.
        seconds = epoch.try_cast("decimal(20,6)")
        micros = F.when(seconds < LAST_SECOND, (seconds * 1_000_000).cast("long"))
        stamp = F.when(F.length(head) < F.length(line), F.coalesce(iso, F.timestamp_micros(micros)))
        level = F.nullif(F.regexp_extract(head, r"^([A-Z]+) \S+$", 1), F.lit(""))
        return let(stamp, lambda at: F.struct(
            F.when(at.isNotNull(), level).alias("level"),
            at.alias("stamped_at"),
            F.when(at.isNotNull(), F.substr(line, F.length(head) + 3)).otherwise(line).alias("message"),
        ))

    return let(F.substring_index(line, ": ", 1), read)


def render_template(text: Column, env: Column) -> Column:
    """Fill ``%(NAME)s`` from a map in one pass, so values are not expanded again.

    ``%%`` is a percent sign and a null value prints as ``None``. Gives a struct
    of text and status: ``ok``, ``missing_key`` or ``unsupported`` for any other
    use of the percent sign; the text is null unless ok.
    """
    def name(token: Column) -> Column:
        return F.substr(token, F.lit(3), F.length(token) - 4)

    def is_name(token: Column) -> Column:
        return F.startswith(token, F.lit("%("))

    def fill(token: Column) -> Column:
        return (
            F.when(is_name(token), F.coalesce(F.try_element_at(env, name(token)), F.lit("None")))
            .when(token == "%%", F.lit("%"))
            .otherwise(token)
        )

    def render(tokens: Column) -> Column:
        missing = F.exists(tokens, lambda t: is_name(t) & ~F.map_contains_key(env, name(t)))
        status = (
            F.when(F.array_contains(tokens, "%"), "unsupported")
            .when(missing, "missing_key")
            .otherwise("ok")
        )
        return let(status, lambda s: F.struct(
            F.when(s == "ok", F.array_join(F.transform(tokens, fill), "")).alias("text"),
            s.alias("status"),
        ))

    tokens = F.regexp_extract_all(text, F.lit(r"(?s)(%\([^)]*\)s|%%|[^%]+|%)"), F.lit(1))
    return let(tokens, render)


def error_text(ename: Column, evalue: Column, traceback: Column) -> Column:
    """One readable message for a failed statement; a missing name or value prints as ``None``."""
    none = F.lit("None")
    return F.concat(
        F.lit("error in statement execution: "), F.coalesce(ename, none), F.lit("("),
        F.coalesce(evalue, none), F.lit("):\n"), F.coalesce(F.array_join(traceback, ""), F.lit("")),
    )
