"""Hooks, sinks that bear repeated tasks, and XML reports whole."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import markup
from spanloom.operators import fields
from spanloom.operators.substitute import Policy
from spanloom.plans.deidentify import Settings, deidentify_reports
from spanloom.plans.workflow import Concern, SinksFailed, Workflow, substitute_through
from spanloom.rulesets import others
from spanloom.sources.reports import read_json_folder
from spanloom.sources.sinks import file_name, upsert_jdbc, write_documents

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def test_a_failing_sink_is_tried_again_alone_and_told(spark):
    docs = spark.createDataFrame([(1, "am 01.02.2012"), (2, None)], "doc_id long, text string")
    calls, told = [], []

    def good(df):
        calls.append(("good", sorted(r["text"] or "" for r in df.collect())))

    def late(df):
        calls.append(("late", df.count()))
        if sum(c[0] == "late" for c in calls) < 3:
            raise OSError("not yet")

    def bad(df):
        calls.append(("bad", 0))
        raise OSError("never")

    concerns = [
        Concern("upper", before=lambda d: d.withColumn("text", F.upper("text"))), Concern("mark", after=lambda d: d.withColumn("text", F.concat("text", F.lit("!")))),
        Concern("good", merged=good, done=told.append), Concern("late", merged=late), Concern("bad", merged=bad),
    ]
    with pytest.raises(SinksFailed, match="bad: OSError: never") as e:
        Workflow(lambda d: d, concerns, tries=3).run(docs)
    assert [c[0] for c in calls] == ["good", "late", "late", "late", "bad", "bad", "bad"] and calls[0][1] == ["", "AM 01.02.2012!"]
    assert [(o.concern, o.tries, o.error is None) for o in e.value.outcomes] == [("good", 1, True), ("late", 3, True), ("bad", 3, False)] and told == [e.value.outcomes]
    with pytest.raises(ValueError, match="names"):
        Workflow(lambda d: d, [Concern("a"), Concern("a")])


def test_work_is_done_once_for_all_sinks(spark):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        ran.add(1)
        return text

    docs = spark.createDataFrame([(k, f"t{k}") for k in range(20)], "doc_id long, text string").repartition(2)
    seen = []
    Workflow(lambda d: d.withColumn("text", counted("text")), [Concern(str(k), merged=lambda d: seen.append(d.count())) for k in range(3)]).run(docs)
    assert seen == [20, 20, 20] and ran.value == 20


def test_one_file_a_document_round_trip(spark, tmp_path):
    reports = {"A-1": {"Patient": {"Name": "xora"}}, "B/2": {"x": [1, None, "ü"]}, "..": {"y": "z"}}
    rows = spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in reports.items()], "name string, content string")
    path = str(tmp_path / "out")
    write_documents(rows, path)
    assert sorted(os.listdir(path)) == sorted(f"{file_name(k)}.json" for k in reports)
    back = {r["name"]: json.loads(r["content"]) for r in read_json_folder(spark, path).collect()}
    assert sorted(map(str, back.values())) == sorted(map(str, reports.values()))
    write_documents(rows.where("name = 'A-1'"), path)
    assert os.listdir(path) == ["A-1.json"]
    with pytest.raises(Exception, match="share names"):
        write_documents(rows.unionAll(rows), str(tmp_path / "twice"))
    assert not os.path.exists(tmp_path / "twice") or os.listdir(tmp_path / "twice") == []


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    rows = spark.range(20).selectExpr("cast(id as string) as name", "if(id = 13, raise_error('stop'), 'x') as content").repartition(4)
    with pytest.raises(Exception, match="stop"):
        write_documents(rows, str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out") or os.listdir(tmp_path / "out") == []


def test_rows_go_to_a_database_by_key(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(DERBY)
    db = jvm.java.sql.DriverManager.getConnection(url)
    db.createStatement().executeUpdate('create table reports ("id" varchar(20) primary key, "content" clob)')
    put = lambda rows: upsert_jdbc(spark.createDataFrame(rows, "id string, content string").repartition(3), url, "reports", "id", driver=DERBY)
    read = lambda: {r["id"]: r["content"] for r in spark.read.format("jdbc").option("url", url).option("driver", DERBY).option("dbtable", "reports").load().collect()}
    put([("a", "1"), ("b", "2")])
    put([("a", "1"), ("b", "2")])
    assert read() == {"a": "1", "b": "2"}
    put([("b", "3"), ("c", None)])
    assert read() == {"a": "1", "b": "3", "c": None}
    with pytest.raises(Exception, match="key"):
        put([("d", "4"), (None, "5")])
    assert read() == {"a": "1", "b": "3", "c": None}
    tables = db.getMetaData().getTables(None, "APP", "%", None)
    names = []
    while tables.next():
        names.append(tables.getString("TABLE_NAME"))
    assert names == ["REPORTS"]
    db.close()


XML = """<?xml version="1.0"?>
<r lang='de'><a id="7 &amp; 8" n='x'>vor <b>xora &lt;tulip&gt;</b> nach<!-- <b>kein</b> --> ihm</a>
  <c/><d></d><e>  </e><![CDATA[Patient <xora tulip>]]><f>am 01.02.2012</f></r>"""


def test_xml_comes_back_byte_for_byte():
    values = [(("/".join(s.path)), s.value) for s in markup.slots(XML)]
    assert values == [("@lang", "de"), ("a/@id", "7 & 8"), ("a/@n", "x"), ("a", "vor "), ("a/b", "xora <tulip>"), ("a", " nach"), ("a", " ihm"), ("c", ""), ("d", ""), ("e", "  "), ("", "Patient <xora tulip>"), ("f", "am 01.02.2012")]
    assert markup.with_slots(XML, [v for _, v in values]) == XML
    draw = random.Random(2)
    for _ in range(200):
        new = [draw.choice([v, "<&>\"'", "neu"]) for _, v in values]
        out = markup.with_slots(XML, new)
        kept = [s.value for s in markup.slots(out)]
        assert markup.readable(out) and [k for k, v in zip(kept, new, strict=True) if v != "" and k != v] == [k for (k, v), (p, _) in zip(zip(kept, new, strict=True), values, strict=True) if p == "c" and v]
    for bad in ("<a>", "<!DOCTYPE a><a/>", "", "<a>&x;</a>", "text"):
        assert not markup.readable(bad)


def test_xml_reports_are_substituted(spark):
    reports = spark.createDataFrame([(1, XML), (2, "<broken>")], "doc_id long, content string")
    settings = Settings(structured=(fields.Mapping("a/b", "Name", (("type", "patient"),)), fields.Mapping("a/@id", "ID")))
    out = {r["doc_id"]: r["content"] for r in deidentify_reports(reports, Policy(), settings, {"IDs": others.IDS}, xml=True).collect()}
    assert out == {1: XML.replace('id="7 &amp; 8"', 'id="ID"').replace("xora &lt;tulip&gt;", "NAME")}


def test_substitution_through_hooks(spark):
    docs = spark.createDataFrame([(1, "ruf 044 an")], "doc_id long, text string")
    spans = spark.createDataFrame([(1, 4, 7, "Contact", "phone number", "r", "044")], "doc_id long, start int, end int, type string, subtype string, rule string, text string")
    got = []
    substitute_through(docs, spans, Policy(), [Concern("x", merged=lambda d: got.extend(r["text"] for r in d.collect()))])
    assert got == ["ruf PHONE an"]
