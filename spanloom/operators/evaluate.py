"""Found spans against expected ones: recall and precision, strict and lenient."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import join_overlapping


def gold_documents(docs: DataFrame, gold: DataFrame, name_col: str = "name") -> DataFrame:
    """``docs`` with the gold document whose name starts with theirs (the text before the last ``_`` of the gold name).

    Of several the first by name is taken; documents without one stay.
    """
    named = gold.withColumn("_key", F.regexp_extract(name_col, r"^(.*)_", 1)).withColumnRenamed(name_col, "gold_name")
    first = named.withColumn("_rank", F.row_number().over(Window.partitionBy("_key").orderBy("gold_name"))).where("_rank = 1").select("_key", "gold_name")
    return docs.join(first, docs[name_col] == first["_key"], "left").drop("_key")


def matched(system: DataFrame, gold: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """Each system and each gold span with ``strict`` (an equal one) and ``lenient`` (an overlapping one)."""

    def side(a: DataFrame, b: DataFrame) -> DataFrame:
        near = join_overlapping(a, b, keys, F.col("type") == F.col("o_type")).select(*a.columns).distinct().withColumn("lenient", F.lit(True))
        equal = b.withColumn("strict", F.lit(True))
        found = a.join(near, a.columns, "left").join(equal, a.columns, "left")
        return found.select(*a.columns, F.coalesce("strict", F.lit(False)).alias("strict"), (F.coalesce("lenient", F.lit(False)) | F.coalesce("strict", F.lit(False))).alias("lenient"))

    cols = [*keys, "type", "start", "end"]
    s, g = system.select(*cols).distinct(), gold.select(*cols).distinct()
    return side(s, g), side(g, s)


def scores(system: DataFrame, gold: DataFrame, by: tuple[str, ...] = ("type",), keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(by, matches, n_system, n_gold, recall, recall_lenient, precision, precision_lenient)``, and a row for all."""
    s, g = matched(system, gold, keys)
    found = s.rollup(*by).agg(F.count(F.lit(1)).alias("n_system"), F.count_if("strict").alias("matches"), F.count_if("lenient").alias("s_lenient"))
    wanted = g.rollup(*by).agg(F.count(F.lit(1)).alias("n_gold"), F.count_if("strict").alias("g_strict"), F.count_if("lenient").alias("g_lenient"))
    on = F.lit(True)
    for b in by:
        on = on & found[b].eqNullSafe(wanted[b])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = lambda a, b: F.when(zero(b) > 0, zero(a) / zero(b))
    return found.join(wanted, on, "full_outer").select(*[F.coalesce(found[b], wanted[b]).alias(b) for b in by], zero("matches").alias("matches"), zero("n_system").alias("n_system"), zero("n_gold").alias("n_gold"), share("g_strict", "n_gold").alias("recall"), share("g_lenient", "n_gold").alias("recall_lenient"), share("matches", "n_system").alias("precision"), share("s_lenient", "n_system").alias("precision_lenient"))
