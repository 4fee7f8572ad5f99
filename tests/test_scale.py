"""What keeps queries within memory and time on larger tables."""

from spanloom.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_send_no_texts_and_code_tokens_once(spark):
    found = plan(QUERIES["q_rule_lookups"](spark, SF))
    assert "BuildLeft" not in found
    assert found.count("ArrowEvalPython") <= 3


def test_names_by_lexicon_send_no_texts(spark):
    assert "BuildLeft" not in plan(QUERIES["q_rule_names_by_lexicon"](spark, SF))


def test_texts_are_spread_over_tasks(spark):
    """A file of one row group is one task when it is read; its texts are many."""
    from spanloom import templates as t

    orders = spark.read.parquet(f"{SF}/orders.parquet").coalesce(1)
    assert t.texts(spark, orders, "o_orderkey", t.MORE_DATES).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_reports_are_spread_over_tasks(spark):
    from spanloom.queries import order_reports

    assert "REPARTITION_BY_NUM" in plan(order_reports(spark, SF))


def test_marks_in_a_text_are_text(spark):
    """Characters that mark matches while a text is searched, in texts, between matches and in them."""
    from spanloom.operators.rules import Rule, annotate

    edge, border = "﷐", "﷑"
    rows = [(1, f"a1b a2{edge}b"), (2, f"{border}a{edge}{border}b{edge}"), (3, "a1b"), (4, None), (5, edge)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["start"], r["end"], r["text"], r["other"]) for r in annotate(docs, {"p": [Rule("x", "()(a)([^a]*?)(b)", ((2, "A", ""), (3, "C", "")))]}).collect()}
    want = set()
    for doc, a, b in ((1, 0, 2), (1, 4, 7), (2, 1, 4), (3, 0, 2)):
        text = dict(rows)[doc]
        want |= {(doc, a, a + 1, "a", text[a + 1 : b]), (doc, a + 1, b, text[a + 1 : b], "a")}
    assert got == want


def test_recurring_texts_are_annotated_once_and_alike(spark):
    from spanloom.operators.rules import annotate, annotate_recurring
    from spanloom.rulesets import dates

    texts = ["am 03.05.2011 und 04.06.2012", "nichts", "seit 2012", "", None, "am 01.02.2003 " + "x" * 300]
    docs = spark.createDataFrame([(k, texts[k % 6] if k % 7 else f"am 03.05.2011 in {k}") for k in range(200)], "doc_id long, text string")
    whole, once = annotate(docs, {"Dates": dates.RULES}), annotate_recurring(docs, {"Dates": dates.RULES})
    assert sorted(map(repr, once.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))
    assert "BroadcastHashJoin" in plan(once)


def test_reports_are_read_in_parts_and_once(spark):
    """More reports than are read at once, with unreadable, missing and empty ones between; each is read once."""
    import pyarrow as pa

    from spanloom.operators import fields

    texts = [['{"a": "x", "b": [1, null]}', "no", None, "{}", "[]"][k % 5] for k in range(3 * fields.READ + 7)]
    got = fields._leaves(pa.array(texts), lambda x: None if x == "no" else [(("a",), ("a",), x, False)] * (x != "[]")).to_pylist()
    assert [None if g is None else len(g) for g in got] == [None if x in (None, "no") else int(x != "[]") for x in texts]
    assert fields._leaves(pa.array([], pa.string()), lambda x: []).to_pylist() == []
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").coalesce(1)
    flat = fields.flatten(docs)
    assert plan(flat).count("ArrowEvalPython") == 1
    assert flat.count() == sum({0: 3, 3: 1, 4: 1}.get(k % 5, 0) for k in range(len(texts)))


def test_phrases_are_found_in_parts_of_a_batch(spark):
    from pyspark.sql import functions as F

    from spanloom.operators import automaton

    def find(words):
        import numpy as np
        import pyarrow as pa

        assert len(words.row) < 2 * automaton.MOST_TOKENS
        return words.row, {"start": pa.array(words.start.astype(np.int32))}

    docs = spark.range(4000).coalesce(1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 != 0, F.expr("repeat('a b ', 50)")).alias("text"))
    found = automaton.found_in_rows(docs, "text", ("doc_id",), find, "start:int")
    assert found.count() == 100 * sum(k % 9 != 0 for k in range(4000))


def test_equal_reports_are_annotated_together_and_alike(spark, monkeypatch):
    """Equal texts meet, in several groups where very many rows hold one; missing texts, long ones and kinds of fields between."""
    from pyspark.sql import functions as F

    from spanloom.operators.rules import Rule, annotate
    from spanloom.plans import stages

    monkeypatch.setattr(stages, "GROUP", 40)
    phases = {"p": [Rule("plain", "()(a[0-9])", ((2, "A", ""),)), Rule("own", "()(b)", ((2, "B", ""),), context="K")]}
    texts = ["a1 b", "nichts", None, "", "a2 " + "x" * 300 + " b"]
    rows = [(k, texts[k % 5] if k % 7 else f"a3 in {k}", ["K"] if k % 2 else ["L"]) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kinds array<string>")
    want, got = annotate(docs, phases, contexts_col="kinds"), stages.annotated_alike(docs, phases, "kinds")
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    assert plan(got).count("ArrowEvalPython") == 0 and "Exchange" not in plan(got)
    assert stages.annotated_alike(docs.where(F.lit(False)), phases, "kinds").isEmpty()


def test_reports_are_parsed_once_for_all_stages(spark):
    """What stages read of reports is a written table: none of their plans parses a report again, nor runs a rule."""
    import json

    from spanloom.operators.fields import Mapping
    from spanloom.plans.deidentify import Settings, find_in_reports
    from spanloom.rulesets import others

    reports = spark.createDataFrame([(1, json.dumps({"a": "Tel 044 255 11 11", "b": "xora tulip"})), (2, "no")], "doc_id long, content string")
    settings = Settings(mappings=(Mapping("a", "K"),), structured=(Mapping.parse("b; Name; type=patient"),), blacklist={"a": ["Name"]})
    leaves, spans = find_in_reports(reports, settings, {"Contacts": others.CONTACTS}, plan=["rules", "structured", "propagate", "blacklist", "schema", "conflicts"])
    assert "ArrowEvalPython" not in plan(leaves) + plan(spans)
    assert {(r["doc_id"], r["start"], r["type"]) for r in spans.collect()} == {(1, 4, "Contact"), (1, 18, "Name")}


def test_date_rules_are_tried_only_where_their_marks_are(spark):
    """A number alone is no reason to try the rules for dates; every text that a rule matches holds what the rule needs."""
    from pyspark.sql import functions as F

    from spanloom import templates as t
    from spanloom.operators.rules import DIGIT
    from spanloom.rulesets import dates

    tried = [r for r in dates.RULES if not r.needs or DIGIT in r.needs]
    assert not tried
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    docs = t.texts(spark, orders, "o_orderkey", t.DATES + t.MORE_DATES)
    held = lambda r: F.greatest(*[F.col("text").contains(x) for x in r.needs], F.lit(False))
    missed = docs.agg(*[F.count_if(F.col("text").rlike(r.pattern) & ~held(r)).alias(r.name) for r in dates.RULES]).first()
    assert not any(missed)


def test_a_report_that_is_one_text_has_no_name(spark):
    """All columns are written down, so a leaf without a path must not raise."""
    from spanloom.operators.fields import flatten

    assert [(r["name"], r["value"]) for r in flatten(spark.createDataFrame([(1, '"xora"')], "doc_id long, content string")).collect()] == [(None, "xora")]
