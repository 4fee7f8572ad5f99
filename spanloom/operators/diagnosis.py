"""Coded findings by keyword, with a certainty from their context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import matches
from spanloom.operators.intervals import join_within, without_overlap


def keyword_annotations(docs: DataFrame, keywords: dict[str, list[str]], text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, code, text)``: every place where a code's keyword pattern matches whole tokens."""
    none = F.array().cast("array<struct<start:int,end:int,text:string,code:string>>")

    def coded(code: str, pattern: str) -> Column:
        whole = rf"(?<![\p{{L}}\p{{N}}])(?:{pattern})(?![\p{{L}}\p{{N}}])"
        return F.transform(matches(F.coalesce(F.col(text_col), F.lit("")), whole), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), F.lit(code).alias("code")))

    found = [coded(code, p) for code, patterns in keywords.items() for p in patterns]
    return docs.select(*keys, F.explode(F.array_distinct(F.concat(none, *found))).alias("a")).select(*keys, "a.*")


def certainty(found: DataFrame, contexts: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``found`` with ``reliability``: excluded or suspected by a context around it, else null."""
    around = join_within(found, contexts.select(*keys, "start", "end", "context"), keys, "left", prefix="c_")
    which: Column = F.when(F.bool_or(F.col("c_context") == "ExclusionContext"), "excluded").when(F.bool_or(F.col("c_context") == "SuspectionContext"), "suspected")
    return around.groupBy(*found.columns).agg(which.alias("reliability"))


def consolidate(found: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, code, reliability, text)``: one row per code and certainty of a document.

    A finding without certainty that overlaps one with it gives way; what is left
    is confirmed; the first text of each stays.
    """
    sure = found.where("reliability is not null").select(*keys, "start", "end")
    unsure = without_overlap(found.where("reliability is null"), sure, keys)
    kept = found.where("reliability is not null").unionByName(unsure).withColumn("reliability", F.coalesce("reliability", F.lit("confirmed")))
    first = kept.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "code", "reliability").orderBy("start", "end", "text")))
    return first.where("_rank = 1").select(*keys, "code", "reliability", "text")
