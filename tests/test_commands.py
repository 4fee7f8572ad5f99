"""The commands, from folders to folders."""

import json
import os

import pytest

from spanloom.__main__ import main
from spanloom.sources.reports import read_json_folder


@pytest.fixture
def reports(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, report in {"a": {"Patient": {"Name": "xora tulip"}, "Text": "xora tulip, PatNr 77. Verdacht auf Grippe."}, "b": {"Titel": "Grippe", "Text": "geb. 01.02.1950"}}.items():
        (folder / f"{name}.json").write_text(json.dumps(report))
    (folder / "c.json").write_text("{no")
    (tmp_path / "structured.txt").write_text("Patient/Name; Name; type=patient\n")
    (tmp_path / "site.conf").write_text('pipeline {\n structuredFieldMapping = ${config_file_dir}"structured.txt"\n annotationTypes = ["Name", "Date"]\n}\n')
    return tmp_path


def test_substitute_writes_one_file_a_report_and_a_table(spark, reports):
    out, url, driver = str(reports / "out"), f"jdbc:derby:{reports}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(driver)
    jvm.java.sql.DriverManager.getConnection(url).createStatement().executeUpdate('create table clean ("reportnr" varchar(20), "content" clob)')
    for _ in range(2):
        main(["substitute", "-i", str(reports / "in"), "-o", out, "-c", f"file://{reports}/site.conf", "--output-jdbc", url, "--table", "clean", "--driver", driver])
    files = {r["name"]: json.loads(r["content"]) for r in read_json_folder(spark, out).collect()}
    assert files == {"a": {"Patient": {"Name": "NAME"}, "Text": "NAME, PatNr 77. Verdacht auf Grippe."}, "b": {"Titel": "Grippe", "Text": "geb. DATE"}}
    rows = spark.read.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "clean").load().collect()
    assert sorted(r["reportnr"] for r in rows) == ["a", "b"]
    assert [r["doc_id"] for r in spark.read.parquet(f"{out}_quarantine").collect()] == ["c"]


def test_annotate_and_xml(spark, reports):
    out = str(reports / "spans")
    main(["annotate", "-i", str(reports / "in"), "-o", out, "--structured", f"file://{reports}/structured.txt"])
    got = {(r["doc_id"], r["type"], r["subtype"]) for r in spark.read.parquet(out).collect()}
    assert {("a", "Name", "patient"), ("a", "ID", "patient ID"), ("b", "Date", "DOB")} <= got
    (reports / "xml").mkdir()
    (reports / "xml/r.xml").write_text("<r><p n='1'>PatNr <b>x</b> am 01.02.2012 da</p></r>")
    main(["substitute", "--xml", "-i", str(reports / "xml"), "-o", str(reports / "clean")])
    assert (reports / "clean/r.xml").read_text() == "<r><p n='1'>PatNr <b>x</b> am DATE da</p></r>" and os.listdir(reports / "clean") == ["r.xml"]


def test_diagnose(spark, reports):
    for name, text in {"words.txt": "J1;Grippe\n", "triggers.txt": "kein;ExclusionContext;0;3\n", "paths.txt": "Titel\n"}.items():
        (reports / name).write_text(text)
    out = str(reports / "found")
    main(["diagnose", "-i", str(reports / "in"), "-o", out, "--keywords", f"file://{reports}/words.txt", "--triggers", f"file://{reports}/triggers.txt", "--keyword-blacklist", f"file://{reports}/paths.txt"])
    assert [tuple(r) for r in spark.read.csv(out, sep=";", header=True).collect()] == [("a", "Grippe", "J1", "suspected")]
