"""Rows spread over tasks by the work that they make."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Texts that one task goes through.
TEXTS = 500_000


def spread(rows: DataFrame, *keys: str, each: int = 1, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` in as many tasks as their texts ask for, by their keys; each row becomes ``each`` texts.

    A scan is cut by bytes, and at row groups: a small file whose rows become many
    texts would be one task otherwise. ``counted``: what has as many rows and is
    counted without work, such as a file.
    """
    texts = (rows if counted is None else counted).count() * each
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-texts // TEXTS)), *keys)
