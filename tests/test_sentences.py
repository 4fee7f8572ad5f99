"""Sentences of texts, and rows for learning, made within the row."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import features, fields, tokens
from spanloom.queries import QUERIES
from tests.test_shuffles import plan_of


def test_sentences_are_cut_within_the_text(spark, tmp_path):
    draw = random.Random(11)
    bits = ["a", "Haus", " ", "  ", ".", ".", "!", "?", "\n", "\r\n", "Dr", "12", "\t", ",", "Ä", " ", "\r"]
    docs = spark.createDataFrame([(k, None if k == 8 else "".join(draw.choices(bits, k=draw.choice([0, 1, 60, 200])))) for k in range(60)], "doc_id long, text string")
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "sentence_nr", "start", "end", "token_count").collect()))
    want = rows(tokens.sentences(tokens.token_table(docs)))
    assert len(want) > 200 and rows(tokens.text_sentences(docs)) == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # all tokens were shuffled and sorted for a window
    assert "Window" not in plan_of(QUERIES["q_sentences"](spark, str(tmp_path)))


def test_rows_for_learning_are_made_within_the_text(spark, tmp_path):
    draw = random.Random(13)
    bits = ["a", "Haus", " ", ".", "!", "\n", "Dr", "12", "\t", ","]
    docs = spark.createDataFrame([(k, None if k == 8 else "".join(draw.choices(bits, k=draw.choice([0, 1, 60]))), draw.choice("xy")) for k in range(30)], "doc_id long, text string, doc_type string")
    spans = lambda *columns: [(k, a, a + draw.choice([0, 3, 9, 500]), *[draw.choice(c) for c in columns]) for k in range(0, 30, 2) for a in [draw.randrange(-1, 50) for _ in range(6)]]
    kinds, place = ["A", "Bä", "", None, "C"], "doc_id long, start int, end int, "
    found, gold = (spark.createDataFrame(spans(kinds, kinds, kinds), place + "type string, subtype string, rule string") for _ in range(2))
    hits = spark.createDataFrame(spans(kinds, kinds), place + "major string, minor string")
    leaves = spark.createDataFrame(spans([["p"], ["p", "q"], ["ä", "b", "c"], []]), place + "path array<string>").withColumn("name", F.try_element_at("path", F.lit(-1)))
    words = tokens.work_tokens(tokens.with_sentence_nr(tokens.token_table(docs))).where("kind != 'newline'")
    extended = lambda s: s.withColumn("type", F.concat_ws("_", "type", F.when(F.col("subtype") != "", F.col("subtype"))))
    want = words.withColumn("token_nr", F.row_number().over(Window.partitionBy("doc_id", "sentence_nr").orderBy("tok_idx")) - 1)
    for table, value, name in ((found, "type", "label"), (extended(found), "type", "label_extended"), (found, "rule", "triggered_rule"), (gold, "type", "manual_label"), (extended(gold), "type", "manual_label_extended"), (hits.withColumn("x", F.concat_ws("_", "major", "minor")), "x", "lookup_tags")):
        joined = features._joined(words, table, value, name, ("doc_id",), ";" if name == "lookup_tags" else ",")
        want = want.join(joined, ["doc_id", "tok_idx"], "left").withColumn(name, F.coalesce(name, F.lit("" if name == "triggered_rule" else "O")))
    want = fields.token_fields(want, leaves).join(docs.select("doc_id", "doc_type"), "doc_id")
    want = want.select("doc_id", "sentence_nr", "token_nr", "string", "kind", F.coalesce("field_name", F.lit("")), F.coalesce("field_path", F.lit("")), "doc_type", "label", "label_extended", "lookup_tags", "triggered_rule", "manual_label", "manual_label_extended")
    table = features.ml_table(docs, found, hits, gold, leaves)
    names = [c for c in table.columns if c not in ("pos_tag", "sentence_beginning")]
    assert sorted(map(str, map(tuple, table.select(names).collect()))) == sorted(map(str, map(tuple, want.collect())))
    # tokens were numbered in windows and met each table of spans in a join by bins
    assert "Window" not in plan_of(table) and "_bin" not in plan_of(table)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert "Window" not in plan_of(QUERIES["q_ml_tokens"](spark, str(tmp_path)))
