"""Predicates on half-open spans, for joins and filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (b_start < a_end)


def within(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """a lies in b."""
    return (a_start >= b_start) & (a_end <= b_end)


def covers(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return within(b_start, b_end, a_start, a_end)


def coextensive(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start == b_start) & (a_end == b_end)


def one_sided(start: Column, end: Column, low: Column, high: Column) -> Column:
    """The span starts in [low, high) or ends in (low, high]."""
    return ((start >= low) & (start < high)) | ((end > low) & (end <= high))


def same(a: Column, b: Column) -> Column:
    """Two spans, as structs with ``start``, ``end``, ``type`` and a map of ``features``, agree in everything."""
    entries = lambda m: F.array_sort(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))))
    return coextensive(a["start"], a["end"], b["start"], b["end"]) & a["type"].eqNullSafe(b["type"]) & (entries(a["features"]) == entries(b["features"]))
