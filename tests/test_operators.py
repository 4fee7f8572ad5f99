import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions.dates import best_format, date_parts
from spanloom.functions.paths import path_matches
from spanloom.functions.spans import coextensive, covers, one_sided, overlaps, within
from spanloom.functions.text import tokens
from spanloom.operators import cases, fields, resolve
from spanloom.operators.rules import Rule, annotate
from spanloom.operators.substitute import Method, Policy, rebuild_text, substitute, tags_valid
from spanloom.plans.deidentify import TEXT_PHASES, deidentify, find
from spanloom.rulesets import dates, others
from spanloom.sources import reports
from spanloom.streaming.stream import annotate_stream, read_stream, windowed_counts, write_stream

FOUND = [
    ("Dates", dates.RULES, "Wieder am 3. Mai 2017 und 12/2011, nicht 4/10 oder 5.5 mg", ["3. Mai 2017", "12/2011"]),
    ("Dates", dates.RULES, "2003 - 2008 stabil, um 1900 Uhr, ED 7/12", ["2003", "2008", "7/12"]),
    ("Dates", dates.RULES, "vom\n12.03", []),
    ("Age", others.AGE, "ein 7 jähriger Bub; im Alter von 41 Jahren; 99 Punkte", ["7", "41"]),
    ("Age", others.AGE, "Kinder (3, 5J)", ["3", "5"]),
    ("Contacts", others.CONTACTS, "Tel. 043 222 11 00, Wert 12345678", ["043 222 11 00"]),
    ("Internet", others.INTERNET, "an b.c_d@mail.firma-x.org oder www.firma-x.org", ["b.c_d@mail.firma-x.org", "www.firma-x.org"]),
    ("Names", others.NAMES, "Frau Dr. Bodo-Nope und Herr Rasu", ["Bodo-Nope", "Rasu"]),
    ("Locations", others.LOCATIONS, "Tannenweg 7b, Stiftung Morgenrot", ["Tannenweg 7b", "Stiftung Morgenrot"]),
    ("Occupations", others.OCCUPATIONS, "arbeitet als Dachdecker, gelernter Koch", ["Dachdecker", "Koch"]),
    ("IDs", others.IDS, "756.1234.5678.97 und PatNr: 4711", ["756.1234.5678.97", "4711"]),
]


@pytest.mark.parametrize(("phase", "rules", "text", "expected"), FOUND)
def test_rules_find_their_spans(spark, phase, rules, text, expected):
    rows = annotate(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string"), {phase: rules}).where("type != 'Salutation'").collect()
    assert [r["text"] for r in sorted(rows, key=lambda r: r["start"])] == expected
    assert all(text[r["start"] : r["end"]] == r["text"] and r["phase"] == phase for r in rows)


def test_longest_then_priority_then_order(spark):
    docs = spark.createDataFrame([(1, "aab aab ab")], "doc_id long, text string")
    rules = [Rule("one", "()(a+)", ((2, "X", ""),), 9), Rule("two", "()(a+b)", ((2, "X", ""),)), Rule("three", "()(ab)", ((2, "X", ""),), 5), Rule("four", "()(ab)", ((2, "X", ""),), 5)]
    assert [r["rule"] for r in annotate(docs, {"p": rules}).orderBy("start").collect()] == ["two", "two", "three"]
    with pytest.raises(ValueError, match="group"):
        Rule("bad", "(x)", ((2, "X", ""),))


def test_tokens_cover_the_text(spark):
    texts = ["2J alt,\r\n\tÜber-\x0bgang  3½ 🙂", "", "a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokens("t").alias("k")).collect()
    assert all("".join(r["k"]) == r["t"] for r in rows)


@pytest.mark.parametrize(("constraint", "path", "fits"), [("X", "A/X", True), ("X", "A/X/B", False), ("/A", "A", True), ("/B", "A/B", False), ("A/B", "A/B", True), ("A/B", "Z/A/B", False), ("A//C", "A/B/B/C", True), ("//A/B", "A/A/B", False), ("A//", "A/B/C", True), ("Te.t", "Q/Text", True)])
def test_path_constraints(spark, constraint, path, fits):
    assert spark.range(1).select(path_matches(F.split(F.lit(path), "/"), constraint).alias("m")).first()["m"] is fits


def test_span_predicates(spark):
    c = lambda *x: [F.lit(v) for v in x]
    row = spark.range(1).select(overlaps(*c(0, 3, 2, 5)), overlaps(*c(0, 3, 3, 5)), within(*c(1, 2, 0, 3)), covers(*c(0, 3, 1, 2)), coextensive(*c(1, 2, 1, 2)), one_sided(*c(0, 9, 2, 5)), one_sided(*c(3, 9, 2, 5))).first()
    assert tuple(row) == (True, False, True, True, True, False, True)


def merge(rows):
    weak, out = (None, "", "other"), []
    for a in sorted(rows, key=lambda r: (r[1], -r[2], -r[0])):
        last = out[-1] if out else None
        if last and (last[1], last[2]) == (a[1], a[2]) and (last[3] in weak or a[3] in weak or last[3] == a[3]):
            if last[3] in weak:
                last[3] = a[3] if a[3] not in weak else last[3] if last[3] is not None else a[3]
        elif last and last[1] <= a[1] and a[2] <= last[2] and (last[1], last[2]) != (a[1], a[2]):
            continue
        else:
            out.append(list(a))
    return [tuple(x) for x in out]


def test_merge_is_the_ordered_fold(spark):
    import random

    rnd = random.Random(6)
    rows = [(d, "Name", k, s, s + rnd.randrange(1, 5), rnd.choice([None, "other", "a", "b", ""])) for d in range(30) for k in range(8) for s in [rnd.randrange(6)]]
    found = resolve.merge_spans(spark.createDataFrame(rows, "doc_id long, type string, ann_id long, start int, end int, subtype string")).collect()
    for d in range(30):
        assert sorted((r["ann_id"], r["start"], r["end"], r["subtype"] or "") for r in found if r["doc_id"] == d) == sorted((a, s, e, t or "") for a, s, e, t in merge([(k, s, e, t) for x, _, k, s, e, t in rows if x == d]))


def test_reports_flatten_and_come_back(spark):
    report = {"Kopf": {"Name": "Bodo Nope", "Leer": None, "Zahl": 123, "Objekt": {}}, "Liste": [{"T": "a"}, {"T": "b\nc"}], "Ok": True}
    docs = spark.createDataFrame([(1, json.dumps(report)), (2, "{kaputt"), (3, None)], "doc_id long, content string")
    flat = fields.flatten(docs).orderBy("field_id").collect()
    assert [("/".join(r["path"]), r["value"]) for r in flat] == [("Kopf/Name", "Bodo Nope"), ("Kopf/Leer", None), ("Kopf/Zahl", "123"), ("Kopf/Objekt", "{}"), ("Liste/LISTELEMENT/T", "a"), ("Liste/LISTELEMENT/T", "b\nc"), ("Ok", "true")]
    assert sorted(r["doc_id"] for r in fields.quarantine(docs).collect()) == [2, 3]
    back = {r["doc_id"]: r["content"] for r in fields.rebuild(docs, fields.flatten(docs)).collect()}
    assert json.loads(back[1]) == report and back[2] == "{kaputt"
    for name in ("", "9a", "Ä b", "x-1"):
        assert fields.unescape_name(fields.escape_name(name)) == name
    xml = spark.createDataFrame([(1, "<r><a><b>x</b><b>y</b></a><c/></r>"), (2, "<r>")], "doc_id long, content string")
    assert [("/".join(r["path"]), r["value"]) for r in fields.flatten(xml, xml=True).orderBy("field_id").collect()] == [("a/b", "x"), ("a/b", "y"), ("c", "")]


def test_date_parts_and_formats(spark):
    for text, parts in (("05.03.19", ("5", "3", "2019", "dd.MM.yy")), ("20. Oktober 2012", ("20", "Oktober", "2012", "dd. MMMM yyyy")), ("Sept. 2010", (None, "Sept", "2010", "MMM. yyyy")), ("2018-12-01", ("1", "12", "2018", "yyyy-MM-dd")), ("16.3.", ("16", "3", None, "dd.MM.")), ("3/2005", (None, "3", "2005", "MM/yyyy")), ("1994", (None, None, "1994", "yyyy"))):
        assert tuple(spark.range(1).select(date_parts(F.lit(text)).alias("p")).first()["p"]) == parts
    assert spark.range(1).select(best_format(F.lit("31.12.2019")), best_format(F.lit("x"))).first()[:] == ("dd.MM.yyyy", None)


def test_policies(spark):
    docs = spark.createDataFrame([(1, "Herr Rasu kam am 31.12.2019 und 05.01.2020 nach Hause."), (2, None), (3, "nichts")], "doc_id long, text string")
    out = {m: {r["doc_id"]: r["text"] for r in deidentify(docs, Policy(m, min_days=5, max_days=6, seed=1) if m is Method.DATE_SHIFT else Policy(m)).collect()} for m in Method}
    assert out[Method.SCRUBBER] == {1: "Herr NAME kam am DATE und DATE nach Hause.", 2: None, 3: "nichts"}
    assert out[Method.DATE_SHIFT][1] == "Herr NAME kam am 26.12.2019 und 31.12.2019 nach Hause."
    assert out[Method.IDENTITY][1] == docs.first()["text"]
    assert "[&[Date;31.12.2019;rule=RegularDotDates;subtype=other]&]" in out[Method.REPLACEMENT_TAGS][1]
    assert tuple(spark.range(1).select(tags_valid(F.lit(out[Method.REPLACEMENT_TAGS][1])), tags_valid(F.lit("[&[a")), tags_valid(F.lit("[&[a[&[b]&]]&]"))).first()) == (True, False, False)
    for bad in ({"method": Method.DATE_SHIFT}, {"method": Method.REPLACEMENT_TAGS, "keep_dates": True}):
        with pytest.raises(ValueError):
            Policy(**bad)
    spans = F.array(F.struct(F.lit(4).alias("start"), F.lit(5).alias("end"), F.lit("Z").alias("new")), F.struct(F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit("Y").alias("new")))
    assert spark.range(1).select(rebuild_text(F.lit("abcdef"), spans)).first()[0] == "YbcdZf"


def test_found_spans_never_overlap(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    spans = find(docs)
    assert resolve.overlapping(spans).where("overlaps").isEmpty()
    assert substitute(docs, docs.join(spans, "doc_id").withColumn("text", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))), Policy(Method.IDENTITY)).exceptAll(docs).isEmpty()


def test_tagged_cases(spark, tmp_path):
    (tmp_path / "date.txt").write_text("Date; Feld\nGesehen am <Date>02.02.2012</Date>. # gut\n# nichts\nSeit\\n<Date>2010</Date> <Date>99</Date>\n", encoding="utf-8")
    docs, expected = cases.read_cases(spark, str(tmp_path))
    assert docs.count() == 2 and expected.count() == 3
    bad = cases.failures(docs, expected, lambda d: annotate(d, {"Dates": dates.RULES})).collect()
    assert [(r["doc_id"], r["problem"]) for r in bad] == [("date.txt:4", "missing")]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A-1.json").write_text('{"T": "x"}', encoding="utf-8")
    assert [tuple(r) for r in reports.read_json_folder(spark, str(tmp_path / "in")).collect()] == [("A-1", '{"T": "x"}')]
    docs = spark.createDataFrame([("A", "1", None), ("B", "2", "y")], "doc_type string, reportnr string, extra string")
    reports.write_corpus(docs, str(tmp_path / "corpus"))
    assert reports.read_corpus(spark, str(tmp_path / "corpus")).where("doc_type = 'A'").count() == 1
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    reports.write_jdbc(docs.select("reportnr", "extra"), url, "reports", ["reportnr", "extra", "dest"])
    rows = reports.read_jdbc(spark, url, "select * from reports").orderBy("reportnr").collect()
    assert [(r["reportnr"], r["extra"], r["dest"]) for r in rows] == [("1", None, ""), ("2", "y", "")]
    found = spark.createDataFrame([(1, "a;b", "G35", "confirmed")], "doc_id long, text string, code string, reliability string")
    reports.write_diagnosis(found, str(tmp_path / "diagnosis"))
    assert spark.read.csv(str(tmp_path / "diagnosis"), sep=";", header=True).first()["annotationText"] == "aSEPb"


def test_streams_equal_batches(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    phases = {"Internet": others.INTERNET, "IDs": others.IDS}
    stream = annotate_stream(read_stream(spark, str(tmp_path / "in"), "doc_id long, text string", 1), phases)
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = annotate(docs, phases)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == batch.count() > 0 and found.exceptAll(batch).isEmpty()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()
    assert set(TEXT_PHASES) >= {"Dates", "Names"}
