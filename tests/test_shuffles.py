"""What is shuffled and held: tokens stay in the rows of their texts."""

import io
import random
import tracemalloc
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spanloom.functions.arrows import running_sums
from spanloom.operators import contexts, features, lexicon, tokens
from spanloom.operators.rules import Rule
from spanloom.plans.deidentify import find
from spanloom.queries import QUERIES


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_a_large_lexicon_goes_to_the_texts(spark, monkeypatch):
    draw = random.Random(5)
    words = ["a", "bb", "ccc", "ä", "x1"]
    docs = spark.createDataFrame([(k % 37 if k % 11 else None, None if k == 3 else " ".join(draw.choices(words, k=draw.choice([0, 1, 20])))) for k in range(60)], "doc_id long, text string")
    terms = [(" ".join(draw.choices(words, k=draw.choice([1, 1, 2, 3]))), draw.choice("mn"), draw.choice(["", "o"]), draw.choice([None, "", "de"])) for _ in range(40)]
    table = lexicon.read_lexicon(spark.createDataFrame(terms, "term string, major string, minor string, language string"))
    found = lambda: sorted(map(str, lexicon.text_lookups(docs, table).collect()))
    small = found()
    assert small
    monkeypatch.setattr(lexicon, "MOST_BYTES", 0)
    for together in (1 << 20, 100):
        monkeypatch.setattr(lexicon, "TOGETHER", together)
        assert found() == small
    # tokens were windowed and shuffled, one row each, with every list's hits after them
    assert "Window" not in plan_of(lexicon.text_lookups(docs, table))


def test_sentences_of_fields_are_cut_within_the_text(spark):
    draw = random.Random(7)
    bits = ["a", "Haus", " ", "  ", ".", "!", "\n", "\r\n", "Dr", "12", "\t", ",", " "]
    docs = spark.createDataFrame([(k if k % 5 else None, None if k == 8 else "".join(draw.choices(bits, k=draw.choice([0, 1, 60])))) for k in range(40)], "doc_id long, text string").where("doc_id is not null or text is null")
    leaves = spark.createDataFrame([(k, f, a, a + draw.choice([0, 7, 30, 500])) for k in range(0, 40, 2) for f in range(4) for a in [draw.randrange(0, 60)]], "doc_id long, field_id int, start int, end int")
    names = ["doc_id", "sentence_nr", "field_id", "start", "end", "token_count", "work_token_count"]
    rows = lambda df: sorted(map(str, df.select(names).collect()))
    want = rows(tokens.field_sentences(tokens.with_sentence_nr(tokens.token_table(docs)), leaves))
    assert len(want) > 50
    found = tokens.text_field_sentences(docs, leaves)
    assert rows(found) == want
    assert "Window" not in plan_of(found)


def test_the_query_shuffles_texts_and_no_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "Ein Satz. Noch einer! " * 20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["q_field_sentences"](spark, str(tmp_path))
    # the tokens' window and their join by bins were exchanges of token rows
    assert "Window" not in plan_of(found) and "_bin" not in plan_of(found)
    assert found.count() == 1


def test_token_features_are_worked_out_within_the_text(spark):
    draw = random.Random(9)
    docs = spark.createDataFrame([(k if k else None, None if k == 8 else "".join(draw.choices(["a", "Haus", " ", ".", "\n", "12", "\t"], k=draw.choice([0, 1, 60])))) for k in range(30)], "doc_id long, text string")
    spans = lambda n: [(k if k else None, a, a + draw.choice([0, 3, 9, 500]), draw.choice(["A", "Bä", "", None, "C"])) for k in range(0, 30, 2) for a in [draw.randrange(-1, 50) for _ in range(n)]]
    labels = spark.createDataFrame(spans(6), "doc_id long, start int, end int, type string")
    hits = spark.createDataFrame(spans(9), "doc_id long, start int, end int, major string").withColumn("minor", F.lit("m"))
    want = features.token_features(tokens.work_tokens(tokens.token_table(docs)), labels, hits)
    found = features.text_features(docs, labels, hits)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert len({r["label"] for r in found.collect()}) >= 4
    assert "Window" not in plan_of(found)


def test_the_query_of_features_shuffles_no_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "of the la and the die In " * 20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["q_ml_features"](spark, str(tmp_path))
    # tokens were numbered in a window, and met spans, labels and tags in four joins
    assert "Window" not in plan_of(found) and plan_of(found).count("Join") == 2
    assert found.count() > 2


def test_running_sums_hold_little_more_than_the_batch():
    for rows, each in ((0, 0), (1, 3_000_000), (4000, 1000)):
        lengths = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * each), pa.array(np.full(rows * each, 2, dtype=np.int32)))
        tracemalloc.start()
        sums = running_sums(lengths)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert np.array_equal(sums.flatten().to_numpy(), np.tile(np.arange(1, each + 1) * 2, rows))
        # a batch of many texts was copied five times in 64 bits, 32 bytes and more a token
        assert rows < 2 or peak < 20 * rows * each
    some = pa.array([[1, 2], None, [], [3]], pa.list_(pa.int32()))
    assert running_sums(some).to_pylist() == [[1, 3], None, [], [3]] and running_sums(some.slice(1, 3)).to_pylist() == [None, [], [3]]


def test_running_sums_are_set_down_once():
    lengths = pa.array([[1, 2], None, *[[3] * 1000] * 4000, []], pa.list_(pa.int32())).slice(1)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    sums = running_sums(lengths)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # sums of stretches were put together in a second array, and a stretch took 40 MB
    assert held + pa.total_allocated_bytes() - before < 5 * 4_000_000 and peak < 6 * 4_000_000
    assert sums.type == lengths.type and sums.slice(0, 1).to_pylist() == [None] and sums.slice(4001).to_pylist() == [[]]
    assert sums[1].as_py() == sums[4000].as_py() == list(range(3, 3001, 3))


def test_rules_are_worked_out_once_for_conflicts(spark):
    docs = spark.createDataFrame([(1, "am 01.02.2012 Tel 031 111 22 33"), (2, None)], "doc_id long, text string")
    found = find(docs, phases={"p": [Rule("Year", "()([0-9]{4})", ((2, "Date", "other"),))]})
    # both sides of the join of conflicts held the rules
    assert "_m0" not in plan_of(found)
    assert [tuple(r)[2:5] for r in found.collect()] == [(9, 13, "Date")]


def test_metadata_values_are_found_within_the_row(spark, tmp_path):
    draw = random.Random(7)
    words = ["EN", "En", "ENX", "en", "-", "\n", "ä", "Ä", "1"]
    docs = spark.createDataFrame([(k % 37 if k % 11 else None, None if k == 3 else draw.choice(["", " ", "  "]).join(draw.choices(words, k=draw.choice([0, 1, 20, 150])))) for k in range(60)], "doc_id long, text string")
    values = spark.createDataFrame([(draw.choice([None, *range(40)]), draw.choice(["Name", "Date"]), draw.choice(["en", "EN", "-", "ä", "", " ", "1", "\n", None])) for _ in range(120)], "doc_id long, type string, value string")
    hits = spark.createDataFrame([(k, 2 * k, 2 * k + 5, draw.choice(["medical", "x"]), None) for k in range(37)], "doc_id long, start int, end int, major string, minor string")
    work = tokens.work_tokens(tokens.token_table(docs))
    for passed in (None, hits):
        found = [sorted(tuple(r) for r in x.collect()) for x in (contexts.text_metadata_annotations(docs, values, passed), contexts.metadata_annotations(work, values, passed))]
        assert found[0] == found[1] and len(found[0]) > 100
    assert contexts.text_metadata_annotations(docs, values.where("false")).count() == contexts.text_metadata_annotations(docs.where("false"), values).count() == 0
    spark.createDataFrame([(1, "EN en En ENX", "en"), (2, "de", "de"), (3, None, "fr")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["q_metadata_annotator"](spark, str(tmp_path))
    # batches of offsets went through Python, and all tokens through a shuffle
    assert "EvalPython" not in plan_of(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "EN", 1), (1, "En", 1)]
