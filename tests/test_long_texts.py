"""Every rule on long runs of what it is made of: no overflow of the stack, and time in proportion."""

import time

import pytest

from spanloom.operators.rules import annotate, with_phase
from spanloom.rulesets import dates, lookups, names, others

TEXT_RULES = {
    "Occupations": others.OCCUPATIONS, "Dates": dates.RULES, "Names": others.NAMES, "Age": others.AGE, "Internet": others.INTERNET, "Contacts": others.CONTACTS, "Simple": others.SIMPLE_CONTACTS,
    "Locations": others.LOCATIONS, "Buildings": others.BUILDINGS, "IDs": others.IDS, "Fields": others.FIELDS, "Diagnosis": others.DIAGNOSIS,
}
PARTS = [
    "Abc ", "ABC ", "Abc-", "Abc - ", "Abc, ", "Abc und Abc ", "a", "a-", "a.b@", "www.", "A. ", "1", "1.", "1 ", "01.02.", "Dr. ", "als ", "& ", " ", "-Strasse",
    "Klinik für Abc ", ", Abc Abc", "Mai ", "am ", "Prof. Dr. med. ", "Abc-Abc ",
]
TIMES = 20_000


def opening(rules):
    """A text that holds what the rules need, so that every pattern is tried."""
    return " ".join(dict.fromkeys(x for r in rules for x in r.needs if len(x) > 1)) + " 1 @ "


@pytest.mark.parametrize("name", TEXT_RULES)
def test_rules_bear_long_runs(spark, name):
    rules = TEXT_RULES[name]
    kinds = sorted({r.context for r in rules if r.context})
    texts = [opening(rules) + part * TIMES for part in PARTS]
    docs = spark.createDataFrame([(k, t, kinds) for k, t in enumerate(texts)], "doc_id long, text string, kinds array<string>").repartition(len(texts))
    began = time.perf_counter()
    assert annotate(docs, {name: rules}, contexts_col="kinds").count() >= 0
    assert time.perf_counter() - began < 240


@pytest.mark.parametrize("rules", [names.RULES, lookups.OCCUPATIONS, lookups.OCCUPATION_STARTS, lookups.CITIES, lookups.ZIPS, lookups.STREETS, lookups.CANTONS, lookups.NAMES_IN_CONTEXT], ids=lambda r: r[0].name)
def test_rules_over_classes_bear_long_runs(spark, rules):
    parts = ["F", "B", "S", "C", "FB", "F-F", "B-", "S-C", "S,", "S/", "U-U", "Up", "pp", "I.", "I.-", "H.D.", "D.", "LF-F", "wS", "S&S,n", "Qbe", "O", "E", "a", "s", "(O", "Y", "Y,K", "Z,Y", "T", "Tn", "PTYK", "X", "N", "c-Z"]
    docs = spark.createDataFrame([(k, "F" + p * TIMES) for k, p in enumerate(parts)], "doc_id long, codes string").repartition(len(parts))
    began = time.perf_counter()
    assert with_phase(docs, rules, "found", "codes").select("doc_id").count() == len(parts)
    assert with_phase(docs, rules, "found", "codes").selectExpr("sum(size(found))").first()[0] >= 0
    assert time.perf_counter() - began < 120


def test_addresses_begin_at_their_run(spark):
    texts = ["Siehe www.ab.ch.", "x www.a-b.com/d_e.", "http://www.x.org/a", "-www.a.ch", "ein a._b@x.ch", "a.b-c@d-e.f.com.", "ä.b@c.de", "www.a.ch.Danach", "a" * 20_000, "Anna-Maria-Strasse 3", "Anna-Strauss-Strasse", "Prof. Drexler", "Dr.med.Müller", "Professor Abc"]
    rules = {"I": others.INTERNET, "L": others.LOCATIONS, "N": others.NAMES}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["type"], r["text"]) for r in annotate(docs, rules).where("type != 'Salutation'").collect())
    assert got == [
        (0, "Contact", "www.ab.ch"), (1, "Contact", "www.a-b.com/d_e"), (2, "Contact", "http://www.x.org/a"), (3, "Contact", "www.a.ch"), (4, "Contact", "b@x.ch"), (5, "Contact", "c@d-e.f.com"), (6, "Contact", "b@c.de"),
        (7, "Contact", "www.a.ch"), (9, "Location", "Anna-Maria-Strasse 3"), (10, "Location", "Anna-Strauss-Strasse"), (11, "Name", "Drexler"), (12, "Name", "Müller"), (13, "Name", "Abc"),
    ]
