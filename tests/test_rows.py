"""What happens within a row: repeated and missing ids, long texts, rules as data."""

import time

import pytest
from pyspark.sql import functions as F

from spanloom.functions.text import running
from spanloom.operators.contexts import propagate, trigger_contexts
from spanloom.operators.rules import RULE_ROW, Rule, rules_of
from spanloom.operators.substitute import rebuild_text
from spanloom.operators.tokens import token_table


def test_tokens_of_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (1, "xyz uvw"), (None, "a b"), (None, "cc"), (2, None), (3, "")], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["string"], r["start"], r["end"]) for r in token_table(docs).collect() if r["kind"] != "space")
    assert found == [(0, "a", 0, 1), (0, "b", 2, 3), (0, "cc", 0, 2), (1, "ab", 0, 2), (1, "cd", 3, 5), (1, "uvw", 4, 7), (1, "xyz", 0, 3)]


def test_running_sums_of_any_length(spark):
    for n in (0, 1, 63, 64, 65, 200, 5000):
        got = spark.range(1).select(running(F.array_repeat(F.lit(2), n)).alias("x")).first()["x"]
        assert got == list(range(0, 2 * n + 1, 2))


def test_long_texts_take_time_in_proportion(spark):
    def seconds(k):
        docs = spark.createDataFrame([(1, "of the " * k)], "doc_id long, text string")
        sure = spark.createDataFrame([(1, 0, "of the", "Name", "FieldMapping-x", None)], "doc_id long, start int, text string, type string, rule string, confidence string")
        triggers = spark.createDataFrame([("of", "NameContext", 1, 1)], "token string, context string, left int, right int")
        start = time.perf_counter()
        assert propagate(docs, sure).count() == k
        assert trigger_contexts(docs, triggers).count() == k
        spans = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct((7 * i).alias("start"), (7 * i + 2).alias("end"), F.lit("X").alias("new")))
        assert docs.select(F.length(rebuild_text(F.col("text"), spans))).first()[0] == 6 * k
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8000) < 10 * seconds(2000) + 3


def test_contexts_end_at_the_borders(spark):
    docs = spark.createDataFrame([(1, "kein Husten bei ihm"), (1, "Verdacht auf Grippe"), (2, None)], "doc_id long, text string")
    triggers = spark.createDataFrame([("kein", "ExclusionContext", 3, 0), ("Verdacht auf", "SuspicionContext", 0, 9)], "token string, context string, left int, right int")
    assert sorted(tuple(r) for r in trigger_contexts(docs, triggers).collect()) == [(1, 0, 11, "ExclusionContext"), (1, 0, 19, "SuspicionContext")]
    assert trigger_contexts(docs, triggers.where("false")).count() == 0


def test_rules_are_data(spark):
    rows = spark.createDataFrame([("b", "()(x)", [(2, "A", "s")], None, "Kind", None), ("a", "(y)", None, 7, None, ["y"])], RULE_ROW)
    assert rules_of(rows) == [Rule("a", "(y)", (), 7, None, ("y",)), Rule("b", "()(x)", ((2, "A", "s"),), -1, "Kind")]
    with pytest.raises(ValueError, match="emits"):
        rules_of(spark.createDataFrame([("c", "(y)", [(3, "A", "")], None, None, None)], RULE_ROW))
