"""Paths of nested fields, and constraints on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_constraint(constraint: str) -> tuple[list[tuple[bool, str]], bool]:
    """``[(a gap may come before, segment)]`` and whether anything may follow.

    ``X`` is a field anywhere, ``/X`` one at the root, ``A/B`` starts at the root,
    ``//`` is a gap of any length.
    """
    text = constraint.strip()
    if text and "/" not in text:
        return [(True, text)], False
    trailing = text.endswith("//")
    steps, gap = [], False
    for part in (text[1:] if text.startswith("/") and not text.startswith("//") else text).split("/"):
        if part:
            steps.append((gap, part))
            gap = False
        else:
            gap = True
    return steps, trailing


def path_matches(path: Column, constraint: str) -> Column:
    """Whether a path (array of names, root first) meets a constraint.

    Segments are regular expressions that a name has to match in full. Names are
    taken from left to right, each segment by the first name it fits, without a
    second try; what is left over fails unless the constraint ends in a gap.
    """
    steps, trailing = parse_constraint(constraint)
    if not steps:
        return F.lit(trailing)
    gaps, names = F.array(*[F.lit(g) for g, _ in steps]), [s for _, s in steps]
    n = len(steps)

    def fits(k: Column, name: Column) -> Column:
        return F.coalesce(*[F.when(k == i, name.rlike(f"^(?:{s})$")) for i, s in enumerate(names)], F.lit(False))

    start = F.struct(F.lit(0).alias("k"), F.lit(True).alias("ok"))

    def step(acc: Column, name: Column) -> Column:
        k = acc["k"]
        took = (k < n) & fits(k, name)
        skip = F.when(k < n, F.get(gaps, k)).otherwise(F.lit(trailing))
        return F.struct(F.when(took, k + 1).otherwise(k).alias("k"), (acc["ok"] & (took | F.coalesce(skip, F.lit(False)))).alias("ok"))

    return F.aggregate(path, start, step, lambda acc: acc["ok"] & (acc["k"] == n))
