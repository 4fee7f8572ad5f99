"""Name annotations from strings of token classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.lexicon import name_codes
from spanloom.operators.rules import Rule, with_phase
from spanloom.rulesets import names


def name_annotations(words: DataFrame, hits: DataFrame, rules: list[Rule] = names.RULES, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, type, subtype, rule)`` in characters, from matches in tokens."""
    # explode alone would make Spark push a test of the array's size, and with it all rules, below each projection once more
    coded = with_phase(name_codes(words, hits, keys), rules, "found", "codes").select(*keys, "starts", "ends", F.explode_outer("found").alias("a")).where("a is not null")
    return coded.select(*keys, F.get("starts", F.col("a.start")).alias("start"), F.get("ends", F.col("a.end") - 1).alias("end"), "a.type", "a.subtype", "a.rule")
