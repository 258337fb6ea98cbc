"""Work on string maps, the shape of dynamic JSON objects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(source: Column, names: Mapping[str, str]) -> list[Column]:
    """``names`` maps output column to map key."""
    return [source[key].alias(out) for out, key in names.items()]


def overlay(base: Column, top: Column) -> Column:
    """All entries of both maps; where a key is in both, ``top`` wins.

    A null map counts as empty.  Written without duplicate keys, so that it
    does not depend on the session's map policy.
    """
    empty = F.create_map().cast("map<string,string>")
    low, high = F.coalesce(base, empty), F.coalesce(top, empty)
    kept = F.map_filter(low, lambda key, _: ~F.map_contains_key(high, key))
    return F.map_concat(kept, high)


def keep_listed(source: Column, listed: Column) -> Column:
    """Entries whose key is in the array ``listed``."""
    return F.map_filter(source, lambda key, _: F.array_contains(listed, key))


def comma_list(text: Column) -> Column:
    """The parts of a comma list, not trimmed."""
    return F.split(text, ",")


def without_nulls(source: Column) -> Column:
    return F.map_filter(source, lambda _, value: value.isNotNull())
