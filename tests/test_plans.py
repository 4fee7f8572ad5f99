"""Plans and configurations, and the chain over streams."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom.operators.fields import Mapping
from spanloom.operators.substitute import Policy
from spanloom.plans.config import load, read_keys
from spanloom.plans.deidentify import deidentify_reports, diagnoses, find, find_in_reports
from spanloom.plans.stages import STAGES, Settings, checked, planned, stage
from spanloom.rulesets import others
from spanloom.streaming.stream import deidentify_stream, numbered_pieces, read_stream, windowed_counts, write_stream

REPORT = "doc_id long, content string"


def test_a_plan_is_checked():
    assert checked(["rules", "words", "metadata", "schema", "conflicts"])
    for bad, told in ((["rules", "nothing"], "no such"), (["rules", "rules"], "twice"), (["rules", "lookup_rules"], "needs lookups"), (["conflicts", "rules"], "needs schema"), (["rules", "schema", "conflicts", "clean"], "has to come after")):
        with pytest.raises(ValueError, match=told):
            checked(bad)
    assert planned(Settings()) == ["rules", "schema", "conflicts"]


def test_a_site_registers_a_stage(spark):
    @stage("only_ids", needs=("rules",))
    def _(s):
        return s.__class__(**{**s.__dict__, "found": s.found.where("type = 'ID'")})

    try:
        docs = spark.createDataFrame([(1, json.dumps({"a": "PatNr 123 am 01.02.2012"}))], REPORT)
        spans = find_in_reports(docs, plan=["rules", "only_ids", "schema", "conflicts"])[1].collect()
        assert [(r["type"], r["subtype"]) for r in spans] == [("ID", "patient ID")]
    finally:
        del STAGES["only_ids"]


CONFIG = """
gate_version = "8"
// where it is
pipeline {
  finalAnnotationSetName = "phi"
  annotationTypes = ["Date", "Location", "ID", "Name"]
  tokenizerRules = "x;"${gate_version}"/y"
  gazetteer = ${config_file_dir}"lists/lists.def"
  annotationMapping = ${config_file_dir}"mapping.txt"
  structuredFieldMapping = ${config_file_dir}"structured.txt"
  annotationBlacklist = ${config_file_dir}"blacklist.txt"
  contextTriggerConfig = ${config_file_dir}"triggers.txt"
  specificTransducer = ${config_file_dir}"rules.json"
}
"""


def test_keys_drive_the_chain(spark, tmp_path):
    (tmp_path / "lists").mkdir()
    files = {
        "site.conf": CONFIG, "lists/lists.def": "city.lst:location:city:german\n", "lists/city.lst": "Bern\nSt. Gallen\n", "mapping.txt": "# kinds\nVerlauf//; Verlauf\n", "structured.txt": "Patient/Name; Name; type=patient\n",
        "blacklist.txt": "Labor//; Date, ID\n", "triggers.txt": "# word\nFall; Verlauf; 0; 3\n", "rules.json": json.dumps({"name": "Own", "pattern": "()(XX[0-9]+)", "emits": [{"group": 2, "type": "ID", "subtype": "other"}]}) + "\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    p = load(spark, f"file://{tmp_path}/site.conf")
    assert p.set_name == "phi" and p.types == ("Date", "Location", "ID", "Name")
    assert p.plan == ["rules", "field_rules", "structured", "words", "lookups", "lookup_rules", "propagate", "blacklist", "schema", "clean", "conflicts"]
    report = {"Patient": {"Name": "xora tulip"}, "Verlauf": {"Text": "# 1234567 in St. Gallen mit xora tulip, XX12"}, "Labor": {"Text": "01.02.2012 XX7"}, "Notiz": "Fall # 7654321 und # 7654322, mail a@b.ch"}
    docs = spark.createDataFrame([(1, json.dumps(report))], REPORT)
    leaves, spans = find_in_reports(docs, p.settings, p.phases, plan=p.plan, types=p.types)
    text = "".join((r["value"] or "") + "\n" for r in leaves.orderBy("field_id").collect())
    got = {(text[r["start"] : r["end"]], r["type"], r["subtype"]) for r in spans.collect()}
    assert got == {("xora tulip", "Name", "patient"), ("1234567", "ID", "patient ID"), ("St. Gallen", "Location", "city"), ("XX12", "ID", "other"), ("7654321", "ID", "patient ID")}
    for bad, told in (("pipeline.nokey = 1", "unknown"), ('gazetteer = ${nothing}"x"', "nothing is called"), ("what is this", "no key"), ('stages = ["rules", "conflicts"]', "needs schema")):
        (tmp_path / "bad.conf").write_text(bad)
        with pytest.raises(ValueError, match=told):
            load(spark, f"file://{tmp_path}/bad.conf")
    assert read_keys('a = "1"\nb = ["x", "y"${a}]', {}) == {"a": "1", "b": ["x", "y1"]}


def test_birth_dates_and_features_in_the_chain(spark):
    docs = spark.createDataFrame([(1, "geb. 03.04.1950, da vom 3. bis 5.6.2012, Sucher 1234, <ABC>")], "doc_id long, text string")
    spans = find(docs, clean=True).collect()
    text = docs.first()["text"]
    by = {text[r["start"] : r["end"]]: r for r in spans}
    assert by["03.04.1950"]["subtype"] == "DOB" and by["1234"]["type"] == "Contact" and by["ABC"]["type"] == "Name"
    assert by["3."]["features"]["month"] == "6" and by["3."]["features"]["year"] == "2012"
    policy = Policy(method=Policy().method.__class__("DateShift"), min_days=1, max_days=2, seed=1)
    report = spark.createDataFrame([(1, json.dumps({"a": "vom 3. bis 5.6.2012"}))], REPORT)
    assert json.loads(deidentify_reports(report, policy).first()["content"]) == {"a": "vom 02. bis 04.06.2012"}


def test_diagnoses_by_rules_and_without_paths(spark):
    docs = spark.createDataFrame([(1, "Verdacht auf Grippe. Diabetes - Sprechstunde. Diabetes."), (2, "Grippe")], "doc_id long, text string")
    leaves = spark.createDataFrame([(2, 0, ["Titel"], "Titel", "Grippe", False, 0, 6)], "doc_id long, field_id int, path array<string>, name string, value string, is_null boolean, start int, end int")
    none = spark.createDataFrame([], "token string, context string, left int, right int")
    words = {"G1": ["Grippe"], "D1": ["Diabetes"]}
    got = {tuple(r) for r in diagnoses(docs, words, none).collect()}
    assert got == {(1, "G1", "suspected", "Grippe"), (1, "D1", "confirmed", "Diabetes"), (2, "G1", "confirmed", "Grippe")}
    assert {tuple(r) for r in diagnoses(docs, words, none, leaves, ("Titel",)).collect()} == got - {(2, "G1", "confirmed", "Grippe")}
    with pytest.raises(ValueError, match="leaves"):
        diagnoses(docs, words, none, blacklist=("Titel",))


def test_the_chain_over_a_stream_restarts_without_repeats(spark, tmp_path):
    rows = [(k, "{broken" if k % 5 == 0 else json.dumps({"Patient": {"Name": f"xora{k} tulip"}, "Text": f"xora{k} tulip in Bern, PatNr {k}"})) for k in range(12)]
    docs = spark.createDataFrame(rows, REPORT).orderBy("doc_id")
    lexicon = spark.createDataFrame([("Bern", "location", "city", "de")], "term string, major string, minor string, language string")
    settings = Settings(lexicon, structured=(Mapping("Patient/Name", "Name"),))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs.where("doc_id < 6").coalesce(1).write.parquet(source)
    failing = Settings(lexicon, structured=settings.structured, stages=(lambda d: d.select(F.raise_error(F.lit("down")).cast("long").alias("doc_id"), F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit("Name").alias("type"), F.lit("").alias("subtype"), F.lit("x").alias("rule")),))
    run = lambda s: deidentify_stream(read_stream(spark, source, REPORT, 1), Policy(), s, out, state)
    with pytest.raises(Exception, match="down"):
        run(failing).awaitTermination()
    run(settings).awaitTermination()
    docs.where("doc_id >= 6").coalesce(1).write.mode("append").parquet(source)
    run(settings).awaitTermination()
    want = {r["doc_id"]: r["content"] for r in deidentify_reports(docs, Policy(), settings).collect()}
    got = [(r["doc_id"], r["content"]) for r in spark.read.parquet(f"{out}/reports").collect()]
    assert len(got) == len(set(got)) and dict(got) == want and "CITY" in want[1] and "xora" not in want[1]
    assert sorted(r["doc_id"] for r in spark.read.parquet(f"{out}/quarantine").collect()) == [0, 5, 10]


def test_sentence_numbers_go_on_through_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "doc_id long, piece long, text string"
    for k, rows in enumerate([[(1, 0, "Eins. Zwei."), (2, 0, "Nur.")], [(1, 2, "Vier!"), (1, 1, "Drei?")], [(2, 1, "ohne"), (1, 3, "Fünf.\n")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        write_stream(numbered_pieces(read_stream(spark, source, schema)), out, state).awaitTermination()
        assert k >= 0
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0, 0, 2), (1, 1, 2, 1), (1, 2, 3, 1), (1, 3, 4, 2), (2, 0, 0, 1), (2, 1, 1, 0)]


def test_late_events_are_left_out(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ts timestamp, event_type string"
    for stamps in (["2024-01-01 00:05:00"], ["2024-01-01 03:00:00"], ["2024-01-01 00:06:00"], ["2024-01-01 06:00:00"], ["2024-01-01 07:00:00"]):
        spark.createDataFrame([(s, "a") for s in stamps], "ts string, event_type string").select(F.to_timestamp("ts").alias("ts"), "event_type").coalesce(1).write.mode("append").parquet(source)
        write_stream(windowed_counts(read_stream(spark, source, schema, 1)), out, state).awaitTermination()
    got = sorted((str(r["window_start"])[11:16], r["n"]) for r in spark.read.parquet(out).collect())
    assert got[0] == ("00:00", 1) and ("03:00", 1) in got and sum(n for _, n in got) <= 3
    assert others.FIELDS
