import json

from spanloom.operators import fields
from spanloom.operators.substitute import Policy
from spanloom.plans.deidentify import deidentify
from spanloom.plans.deidentify import find as find_all
from spanloom.rulesets import others


IDS = {"IDs": others.IDS}


def find(docs, **stages):
    return find_all(docs, phases=IDS, **({"field_phases": IDS} if stages else {}), **stages)


def test_the_chain_uses_fields(spark):
    report = {"Patient": {"Name": "xora tulip"}, "Verlauf": {"Text": "# 1234567 und xora tulip, bodo BODO"}, "Labor": {"Text": "# 7654321", "Tel": "xora tulip"}}
    leaves = fields.flatten(spark.createDataFrame([(1, json.dumps(report))], "doc_id long, content string"))
    text = "xora tulip\n# 1234567 und xora tulip, bodo BODO\n# 7654321\nxora tulip\n"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    stages = {
        "leaves": leaves, "mappings": [fields.Mapping("Verlauf//", "Verlauf")], "structured": [fields.Mapping("Patient/Name", "Name", (("type", "patient"),))],
        "blacklist": {"Labor/Tel": ["Name"]}, "metadata": spark.createDataFrame([(1, "Name", "bodo")], "doc_id long, type string, value string"),
    }
    spans = find(docs, **stages)
    found = {(text[r["start"] : r["end"]], r["start"], r["type"], r["subtype"]) for r in spans.collect()}
    assert found == {("xora tulip", 0, "Name", "patient"), ("1234567", 13, "ID", "patient ID"), ("xora tulip", 25, "Name", "patient"), ("BODO", 42, "Name", None)}
    assert find(docs).isEmpty()
    clean = deidentify(docs, Policy(), phases=IDS, field_phases=IDS, **stages).first()["text"]
    assert "1234567" not in clean and "BODO" not in clean and clean.count("xora tulip") == 1 and "7654321" in clean
