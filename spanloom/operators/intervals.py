"""Joins of spans with spans: by bins of offsets, so a document isn't compared with itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters in a bin. Most spans lie in one or two; a field over a whole report lies in as many as it is long.
WIDTH = 128


def _bin(place: Column | str, width: int) -> Column:
    return F.floor((F.col(place) if isinstance(place, str) else place) / width).cast("int")


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _same(keys: tuple[str, ...], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(k) == F.col(f"{prefix}{k}"))
    return out


def join_within(inner: DataFrame, outer: DataFrame, keys: tuple[str, ...] = ("doc_id",), how: str = "inner", also: Column | None = None, prefix: str = "o_", width: int = WIDTH) -> DataFrame:
    """``inner`` joined (in any of Spark's ways) with the spans of ``outer`` that it lies in; their columns get the prefix.

    A span lies in another only if that one lies over its start. So ``inner`` is
    put in the bin of its start, ``outer`` in every bin that it touches, and both
    meet by document and bin: an equi-join whose keys are short stretches of a
    document, however long that is. ``also`` is a further condition.
    """
    o = _renamed(outer, prefix).withColumn(f"{prefix}_bin", F.explode(F.sequence(_bin(f"{prefix}start", width), F.greatest(_bin(f"{prefix}start", width), _bin(f"{prefix}end", width)))))
    on = _same(keys, prefix) & (F.col("_bin") == F.col(f"{prefix}_bin")) & (F.col("start") >= F.col(f"{prefix}start")) & (F.col("end") <= F.col(f"{prefix}end"))
    joined = inner.withColumn("_bin", _bin("start", width)).join(o, on if also is None else on & also, how)
    return joined.drop("_bin", f"{prefix}_bin")


def join_overlapping(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("doc_id",), also: Column | None = None, prefix: str = "o_", width: int = WIDTH) -> DataFrame:
    """Pairs of spans of ``a`` and ``b`` that overlap, each once; the columns of ``b`` get the prefix.

    Both are put in every bin that they touch; a pair counts in the bin where the
    later of the two starts.
    """

    def spread(df: DataFrame, p: str, out: str) -> DataFrame:
        first = _bin(f"{p}start", width)
        return df.withColumn(out, F.explode(F.sequence(first, F.greatest(first, _bin(F.col(f"{p}end") - 1, width)))))

    o = spread(_renamed(b, prefix), prefix, f"{prefix}_bin")
    meet = (F.col("start") < F.col(f"{prefix}end")) & (F.col(f"{prefix}start") < F.col("end"))
    once = F.col("_bin") == _bin(F.greatest("start", f"{prefix}start"), width)
    on = _same(keys, prefix) & (F.col("_bin") == F.col(f"{prefix}_bin")) & meet & once
    return spread(a, "", "_bin").join(o, on if also is None else on & also).drop("_bin", f"{prefix}_bin")


def without_overlap(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("doc_id",), also: Column | None = None, by: tuple[str, ...] = ("start", "end"), prefix: str = "o_", width: int = WIDTH) -> DataFrame:
    """The spans of ``a`` that none of ``b`` overlaps. ``by``: what of ``a``, beside the keys, decides it (its place, and what ``also`` reads)."""
    names = [*keys, *by]
    hit = join_overlapping(a.select(*names).distinct(), b, keys, also, prefix, width).select(*names).distinct()
    return a.join(hit, names, "left_anti")
