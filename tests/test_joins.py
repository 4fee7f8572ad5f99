"""Joins of spans by bins, and phrases by automaton, against plain loops."""

import io
import random
import time
from contextlib import redirect_stdout

import pytest

from spanloom.operators import automaton, lexicon
from spanloom.operators.contexts import trigger_contexts
from spanloom.operators.fields import token_fields
from spanloom.operators.intervals import join_overlapping, join_within, without_overlap
from spanloom.operators.tokens import token_table, work_tokens

SPAN = "doc_id long, ann_id long, start int, end int"


def spans(spark, n, seed, longest=400, empty=True):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        start = draw.randint(0, 600)
        rows.append((draw.choice([1, 2, 3]), k, start, start + draw.randint(0 if empty else 1, draw.choice([3, 40, longest]))))
    return spark.createDataFrame(rows, SPAN), rows


@pytest.mark.parametrize("width", [1, 16, 128, 10_000])
def test_spans_meet_as_in_a_loop(spark, width):
    (a, x), (b, y) = spans(spark, 150, 1), spans(spark, 120, 2)
    within = {(r["ann_id"], r["o_ann_id"]) for r in join_within(a, b, width=width).collect()}
    assert within == {(p[1], q[1]) for p in x for q in y if p[0] == q[0] and q[2] <= p[2] and p[3] <= q[3]}
    over = [(r["ann_id"], r["o_ann_id"]) for r in join_overlapping(a, b, width=width).collect()]
    want = {(p[1], q[1]) for p in x for q in y if p[0] == q[0] and p[2] < q[3] and q[2] < p[3]}
    assert len(over) == len(set(over)) and set(over) == want
    left = {r["ann_id"] for r in without_overlap(a, b, width=width).collect()}
    assert left == {p[1] for p in x} - {p for p, _ in want}


def test_time_grows_with_the_document(spark):
    """Twice the tokens and fields of one document take about twice as long, not four times."""

    def seconds(n):
        fields = spark.range(n).selectExpr("1L as doc_id", "cast(id * 20 as int) as start", "cast(id * 20 + 19 as int) as end", "array('a', cast(id as string)) as path", "cast(id as string) as name").unionByName(spark.createDataFrame([(1, 0, 20 * n, ["all"], "all")], "doc_id long, start int, end int, path array<string>, name string"))
        words = spark.range(4 * n).selectExpr("1L as doc_id", "cast(id as int) as tok_idx", "cast(id * 5 as int) as start", "cast(id * 5 + 3 as int) as end")
        began = time.perf_counter()
        assert token_fields(words, fields).where("field_name != 'all'").count() == 4 * n
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(40_000) < 4 * seconds(10_000) + 4


def plain_hits(text_tokens, phrases):
    """``(first, behind the last, entry)`` by comparing all places with all phrases."""
    return sorted((k, k + len(p), e) for k in range(len(text_tokens)) for e, p in enumerate(phrases) if p and text_tokens[k : k + len(p)] == p)


def test_automaton_finds_what_a_loop_finds(spark):
    draw = random.Random(3)
    phrases = [draw.choices("abcd", k=draw.choice([0, 1, 1, 2, 3, 5])) for _ in range(40)]
    texts = ["".join(draw.choice(["a", "b", "c", "d", "ä"]) + draw.choice([" ", "  ", "\t", ",", "\n"]) for _ in range(draw.choice([0, 1, 30]))) for _ in range(25)] + [None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    table = spark.createDataFrame([(" ".join(p), str(e), "", "") for e, p in enumerate(phrases)], "term string, major string, minor string, language string")
    got = sorted((r["doc_id"], r["start"], r["end"], int(r["major"])) for r in lexicon.text_lookups(docs, table).collect())
    words = {}
    for r in work_tokens(token_table(docs)).orderBy("tok_idx").collect():
        words.setdefault(r["doc_id"], []).append(r)
    want = sorted((d, ws[a]["start"], ws[b - 1]["end"], e) for d, ws in words.items() for a, b, e in plain_hits([w["string"] for w in ws], phrases))
    assert got == want


def test_the_longest_entry_of_a_list_stays_and_large_lexica_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "bei St. Gallen West und St. Gallen"), (2, None), (3, "St. Gallen")], "doc_id long, text string")
    rows = [("St. Gallen", "location", "city", "de"), ("St.  Gallen West", "location", "city", "de"), ("St", "general", "general", ""), ("Gallen", "location", "city", "zz"), ("Gallen", "location", "city", "aa")]
    table = lexicon.read_lexicon(spark.createDataFrame(rows, "term string, major string, minor string, language string"))
    found = lambda: sorted((r["doc_id"], r["start"], r["end"], r["term"], r["language"]) for r in lexicon.text_lookups(docs, table).collect())
    small = found()
    assert (1, 4, 19, "St.  Gallen West", "de") in small and (1, 4, 14, "St. Gallen", "de") not in small and (1, 8, 14, "Gallen", "aa") in small
    monkeypatch.setattr(lexicon, "MOST_BYTES", 0)
    assert found() == small


def test_no_token_is_shuffled_and_100_000_terms_fit(spark):
    table = spark.range(100_000).selectExpr("concat('wort', id, ' zwei drei vier fünf sechs') as term", "'a' as major", "'b' as minor", "'' as language")
    docs = spark.createDataFrame([(1, "und wort99999 zwei drei vier fünf sechs sieben")], "doc_id long, text string")
    found = lexicon.text_lookups(docs, table)
    assert [tuple(r)[1:3] for r in found.collect()] == [(4, 39)]
    out = io.StringIO()
    with redirect_stdout(out):
        found.explain()
    plan = out.getvalue()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_tokens_are_cut_once(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    out = io.StringIO()
    with redirect_stdout(out):
        token_table(docs).explain()
    assert out.getvalue().count("ArrowEvalPython") == 1 and out.getvalue().count("regexp_extract_all") == 1


def test_lists_are_read_by_their_index(spark, tmp_path):
    (tmp_path / "places").mkdir()
    (tmp_path / "places/city.lst").write_text("﻿Bern\n# no\n\nSt. Gallen\tkind=town\n")
    (tmp_path / "stop.lst").write_text("und\n")
    (tmp_path / "lists.def").write_text("places/city.lst:location:city:german\n\n# x\nstop.lst:stop\n")
    got = sorted(tuple(r) for r in lexicon.read_lists(spark, f"file://{tmp_path}").collect())
    assert got == [("Bern", "location", "city", "german", 1), ("St. Gallen", "location", "city", "german", 3), ("und", "stop", "", "", 1)]


def test_too_many_triggers_raise(spark, monkeypatch):
    from spanloom.operators import contexts

    monkeypatch.setattr(contexts, "MOST_BYTES", 3)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="triggers"):
        trigger_contexts(docs, spark.createDataFrame([("abcd", "X", 1, 1)], "token string, context string, left int, right int"))
    assert automaton.Automaton.of([[]]).ends == {}
