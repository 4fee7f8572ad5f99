"""Reports of equal content go through the chain once."""

from pyspark.sql import functions as F

from spanloom.operators.fields import Mapping
from spanloom.operators.rules import Rule
from spanloom.operators.substitute import Method, Policy
from spanloom.plans import deidentify as d

RULES = {"p": [Rule("Year", "()([0-9]{4})", ((2, "Date", "other"),))]}


def test_equal_reports_are_worked_on_once(spark, monkeypatch):
    contents = ['{"a": "am 2012 da", "n": "Bodo"}', '{"a": "ohne"}', "kaputt", None, '{"n": "Bodo",  "a": "2011 Bodo"}']
    # two reports that differ share a key
    rows = [(k if k != 10 else 1, contents[k % 5], k) for k in range(40)]
    reports = spark.createDataFrame(rows, "doc_id long, content string, more int")
    settings = d.Settings(structured=(Mapping.parse("n; Name; type=patient"),))
    unique = reports.where("more != 10")
    seen = []
    chain = d.find_in_reports
    monkeypatch.setattr(d, "find_in_reports", lambda reports, *a: seen.append(reports.count()) or chain(reports, *a))
    rows_of = lambda df: sorted(map(str, df.collect()))
    names = ["doc_id", "start", "end", "type", "subtype", "rule"]
    want = chain(unique, settings, RULES)[1].select(names)
    assert rows_of(d.report_spans(unique, settings, RULES).select(names)) == rows_of(want) and want.count() == 30
    got = d.deidentify_reports(reports, Policy(), settings, RULES)
    # all 40 reports went through all stages
    assert seen == [4, 4] and got.columns == reports.columns
    assert rows_of(got.where("more != 10")) == rows_of(d._deidentified(unique, Policy(), settings, RULES, False, None, ()))
    assert got.where("more = 10").select("doc_id").first()[0] == 1 and got.count() == 24
    seen.clear()
    # the key says how far dates go back, so each report is by itself
    d.deidentify_reports(unique, Policy(Method.DATE_SHIFT, min_days=10, max_days=200, seed=7), settings, RULES)
    d.report_spans(unique, d.Settings(metadata=unique.select("doc_id", F.lit("Name").alias("type"), F.lit("Bodo").alias("value"))), RULES)
    assert seen == [39, 39]
