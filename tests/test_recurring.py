"""Texts that recur are looked at once, and what is exploded from them isn't broadcast."""

from pyspark.sql import functions as F

from spanloom import queries
from spanloom import templates as t
from spanloom.operators import rules, tokens
from spanloom.operators.names import name_annotations
from tests.test_shuffles import plan_of


def test_names_by_lexicon_broadcast_no_hits(spark, tmp_path):
    spark.range(40).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    customers = spark.read.parquet(f"{tmp_path}/customer.parquet")
    docs = t.texts(spark, customers, "c_custkey", t.LEXICON_NAMES)
    found = name_annotations(*queries.looked_up(spark, docs))
    # Spark took the hits, one and more a text, for as small as the file, and sent them all through the driver
    assert "Broadcast" not in plan_of(found)
    # and it tested the size of the found spans, with all rules in the test, where tokens are put together
    assert "size(concat(" not in plan_of(found)
    names = ["doc_id", "start", "end", "type", "subtype", "text"]
    want = queries.with_texts(docs, found.select("doc_id", "start", "end", "type", "subtype")).select(names)
    assert sorted(map(tuple, queries.QUERIES["q_rule_names_by_lexicon"](spark, str(tmp_path)).select(names).collect())) == sorted(map(tuple, want.collect()))


def test_only_texts_that_do_not_recur_are_looked_at_by_themselves(spark):
    seen = []

    def find(texts, keys):
        seen.append(keys)
        return tokens.token_table(texts, keys=keys).select(*keys, "start", "string")

    often = [(k % 7 if k % 5 else None, ["ein Satz", "zwei", ""][k % 3]) for k in range(30)]
    rare = [(40, "einmal"), (41, None), (42, "x " * 200), (43, "x " * 200)]
    for rows, passes in ((often + rare, 2), (often, 1)):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        seen.clear()
        got = rules.of_recurring(docs, find)
        assert len(seen) == passes
        assert sorted(map(str, got.collect())) == sorted(map(str, find(docs, ("doc_id",)).collect()))


def test_rows_made_of_few_values_get_their_spans_with_these(spark, monkeypatch):
    pieces = [[("'am '", None), (t.YEAR, t.D), ("' da'", None)], [("'Unfall '", None), (f"{t.YEAR} || '-' || {t.MONTH} || '-' || o_mark", t.D), ("''", None)], [("'nichts'", None)]]
    phases = {"p": [rules.Rule("Year", "()([0-9]{4})(-[0-9]+)?", ((2, "Date", "other"), (3, "Date", "x")))]}
    days = ["2012-03-04", None, "1999-12-31", "2012-03-05"]
    table = spark.createDataFrame([(k if k % 9 else None, days[k % 4], ["x", None, "y"][k % 3], k) for k in range(200)], "o_orderkey long, day string, o_mark string, o_custkey long").withColumn("o_orderdate", F.to_date("day"))
    assert t.sources(table, pieces) == ["o_mark", "o_orderdate"] and t.sources(table, t.IDS) == ["o_custkey"]
    want = sorted(map(str, rules.annotate(t.texts(spark, table, "o_orderkey", pieces), phases).collect()))
    found = t.annotated(spark, table, "o_orderkey", pieces, phases)
    assert sorted(map(str, found.collect())) == want and len(want) > 300
    # every row was put into every template, three times over
    assert "inline" not in plan_of(found)
    monkeypatch.setattr(t, "RECURRING", 20)
    assert "inline" in plan_of(again := t.annotated(spark, table, "o_orderkey", pieces, phases))
    assert sorted(map(str, again.collect())) == want
