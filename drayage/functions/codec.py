"""Framed result lines and response bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drayage.functions.binding import let


def base64_line(data: Column) -> Column:
    """Base64 on one line; Spark's own function may break it every 76 characters."""
    return F.translate(F.base64(data), "\r\n", "")


def encode_frame(data: Column, prefix: str) -> Column:
    """``prefix length base64`` on one line."""
    body = base64_line(data)
    return F.concat_ws(" ", F.lit(prefix), F.length(body).cast("string"), body)


def decode_frame(line: Column, prefix: str) -> Column:
    """Read a framed line into a struct of size, data and status.

    Status is ``ok``, or the first check that failed: ``bad_parts``,
    ``bad_size``, ``len_mismatch``, ``bad_prefix`` or ``bad_b64``. A line that
    does not start with the prefix gives a null struct.
    """
    def check(parts: Column) -> Column:
        size = F.get(parts, F.lit(1)).try_cast("int")
        body = F.get(parts, F.lit(2))
        fault = (
            F.when(F.size(parts) != 3, "bad_parts")
            .when(size.isNull(), "bad_size")
            .when(size != F.length(body), "len_mismatch")
            .when(F.get(parts, F.lit(0)) != prefix, "bad_prefix")
        )
        data = F.when(fault.isNull(), F.try_to_binary(body, F.lit("base64")))
        return let(
            F.struct(fault.alias("fault"), data.alias("data")),
            lambda r: F.struct(
                F.when(F.size(parts) == 3, size).alias("size"),
                r["data"].alias("data"),
                F.coalesce(r["fault"], F.when(r["data"].isNull(), "bad_b64"), F.lit("ok")).alias("status"),
            ),
        )

    parts = F.split(F.trim(line, F.lit(" \t\r\n")), r"\s+", 4)
    return F.when(F.startswith(line, F.lit(prefix)), let(parts, check))


def decode_body(body: Column) -> Column:
    """Read response bytes as JSON, else text, else text with replacement marks.

    Gives a struct of kind (``json``, ``text`` or ``bytes``) and text.
    """
    raw = body.cast("string")
    kind = (
        F.when(~F.is_valid_utf8(raw), "bytes")
        .when(F.try_parse_json(raw).isNotNull(), "json")
        .otherwise("text")
    )
    return F.struct(kind.alias("kind"), F.make_valid_utf8(raw).alias("text"))
