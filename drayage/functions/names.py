"""Path, URL and file-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEMPLATE_MARKER = ".tmpl"


def join_url(base: Column, path: Column) -> Column:
    """Append a path to a base URL whose trailing slashes are dropped."""
    return F.concat(F.rtrim(base, F.lit("/")), path)


def url_basename(url: Column) -> Column:
    """Last path segment of a URL; for text that is no URL, the last segment of the text."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), url)
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def is_template(name: Column) -> Column:
    return F.contains(name, F.lit(TEMPLATE_MARKER))


def rendered_name(name: Column) -> Column:
    """The name a template is rendered to: every marker removed."""
    return F.replace(name, F.lit(TEMPLATE_MARKER), F.lit(""))


def matches_glob(name: Column, glob: str) -> Column:
    """Whole-name match of a shell pattern made of text, ``*`` and ``?``."""
    like = glob.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return name.like(like.replace("*", "%").replace("?", "_"))


def mode_octal(mode: Column) -> Column:
    """Permission bits written as ``0o600``."""
    bits = mode.cast("long").bitwiseAND(F.lit(0o7777))
    return F.concat(F.lit("0o"), F.conv(bits.cast("string"), 10, 8))
