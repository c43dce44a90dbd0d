"""Merging of header maps and environment overlays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drayage.functions.binding import let


def merge_headers(base: Column, over: Column) -> Column:
    """Union of two maps under lower-cased keys; the last value of a key wins.

    A null map counts as empty.
    """
    entries = F.transform(
        F.concat(_entries(base), _entries(over)),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    def last_wins(all: Column) -> Column:
        keys = F.array_distinct(F.transform(all, lambda e: e["key"]))
        return F.map_from_arrays(keys, F.transform(
            keys, lambda k: F.element_at(F.filter(all, lambda e: e["key"] == k), -1)["value"]
        ))

    return let(entries, last_wins)


def overlay_env(base: Column, over: Column) -> Column:
    """Environment after an overlay: its values win, and its nulls delete. A null map counts as empty."""
    empty = F.create_map().cast("map<string,string>")
    given = F.coalesce(over, empty)
    kept = F.map_filter(F.coalesce(base, empty), lambda k, _: ~F.map_contains_key(given, k))
    return F.map_filter(F.map_concat(kept, given), lambda _, v: v.isNotNull())


def _entries(column: Column) -> Column:
    return F.coalesce(F.map_entries(column), F.array())
