"""Annotations from rules over lexicon labels, contexts and what was found before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import without_overlap
from spanloom.operators.rules import Rule, with_phase
from spanloom.rulesets import lookups as r

#: Words that announce an occupation, and those that lead to a workplace.
ANNOUNCE = r"^(?:[Aa]ls|[Zz]uvor|[Vv]orher|[Ww]ar|[Ee]hemalige[rn]?|[Ff]rühere[r]?|[Ee]hrenamtliche[r]?|[Aa]ktuell|[Gg]erade|früher|jährige[r]?)$"
LEADS, ARTICLES = ("bei", "im", "für", "in"), ("der", "einer", "einem", "eine")


def over_all(words: DataFrame, tables: list[tuple[DataFrame, dict[str, Column]]], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``words`` with a boolean column for each label of each table of spans: whether a span for which it holds is over the token.

    Spans are put out by the numbers of the tokens that they begin and end at, so
    tokens meet them by equality, not by comparing all with all: each span adds one
    where it begins and takes one away behind its end, and running sums say how
    many are open at a token. All tables go through one shuffle and one sort.
    """
    names = [n for _, labels in tables for n in labels]
    events = words.select(*keys, F.col("start").alias("at"), F.lit(1).alias("_tok"), *[F.lit(0).alias(n) for n in names], F.struct(*[c for c in words.columns if c not in keys]).alias("_w"))
    none = F.lit(None).cast(events.schema["_w"].dataType).alias("_w")
    for spans, labels in tables:
        marks = {n: F.coalesce(c, F.lit(False)).cast("int") for n, c in labels.items()}
        for at, sign in (("start", 1), ("end", -1)):
            events = events.unionByName(spans.select(*keys, F.col(at).alias("at"), F.lit(0).alias("_tok"), *[(marks[n] * sign if n in marks else F.lit(0)).alias(n) for n in names], none))
    before = Window.partitionBy(*keys).orderBy("at", "_tok").rowsBetween(Window.unboundedPreceding, 0)
    summed = events.select(*keys, "_tok", "_w", *[(F.sum(n).over(before) > 0).alias(n) for n in names])
    return summed.where("_tok = 1").select(*keys, "_w.*", *names)


def over(words: DataFrame, spans: DataFrame, labels: dict[str, Column], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``over_all`` with one table of spans."""
    return over_all(words, [(spans, labels)], keys)


def in_characters(words: DataFrame, codes: dict[str, Column], phases: list[tuple[str, list[Rule]]], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, type, subtype, rule)`` of phases over the tokens of a text as strings of class letters.

    ``phases`` say which of the strings each runs over. A text's tokens are put
    together once, and all phases run within its row.
    """
    row = F.array_sort(F.collect_list(F.struct("tok_idx", "start", "end", *[c.alias(n) for n, c in codes.items()])))
    texts = words.groupBy(*keys).agg(row.alias("r")).select(*keys, *[F.array_join(f"r.{n}", "").alias(n) for n in codes], F.col("r.start").alias("starts"), F.col("r.end").alias("ends"))
    for k, (name, rules) in enumerate(phases):
        texts = with_phase(texts, rules, f"_found{k}", name)
    found = texts.select(*keys, "starts", "ends", F.explode_outer(F.concat(*[F.col(f"_found{k}") for k in range(len(phases))])).alias("a")).where("a is not null")
    return found.select(*keys, F.get("starts", F.col("a.start")).alias("start"), F.get("ends", F.col("a.end") - 1).alias("end"), "a.type", "a.subtype", "a.rule")


def _flagged(words: DataFrame, hits: DataFrame, contexts: DataFrame | None, found: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    major, minor = F.col("major"), F.col("minor")
    labels = {
        "_occ": (major == "occupation") & (minor != "employer"), "_emp": (major == "occupation") & (minor == "employer"), "_city": (major == "location") & (minor == "city"), "_street": (major == "location") & (minor == "street"),
        "_canton": (major == "location") & (minor == "cantons_abbrevs"), "_first": minor.contains("firstname"), "_often": minor.contains("firstname") & (F.col("language") == "frequent"), "_stop": major == "stop", "_general": major == "general",
    }
    kinds = {n: F.col("context") == k for n, k in {"_anamnesis": "AnamnesisField", "_occupation": "OccupationContext", "_named": "NameContext"}.items()}
    types = {n: F.col("type") == k for n, k in {"_place": "Location", "_name": "Name"}.items()}
    given = [(spans, marks) for spans, marks in ((hits, labels), (contexts, kinds), (found, types)) if spans is not None]
    missing = [n for spans, marks in ((contexts, kinds), (found, types)) if spans is None for n in marks]
    return over_all(words, given, keys).withColumns(dict.fromkeys(missing, F.lit(False)))


def lookup_annotations(words: DataFrame, hits: DataFrame, contexts: DataFrame | None = None, found: DataFrame | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, type, subtype, rule)`` of all rules that combine lexicon labels.

    ``words`` are tokens without blanks, ``hits`` their lookups, ``contexts(keys,
    start, end, context)`` say where a field kind or a trigger's context is, and
    ``found`` are annotations made before.
    """
    t, s = _flagged(words, hits, contexts, found, keys), F.col("string")
    mark = F.when(F.col("kind") == "newline", "N").when(F.col("kind") == "punctuation", F.when(s.rlike(r"^[-.,/()!?]$"), s).otherwise("_"))
    anamnesis = F.when(F.col("_anamnesis"), F.when(F.col("_emp"), "E").when(F.col("_occ") & F.col("_occupation"), "Q").when(F.col("_occ"), "O"))
    work = F.coalesce(anamnesis, F.when(F.col("_occ") | F.col("_emp"), "o").when(s.rlike(ANNOUNCE), "a").when(s.rlike("^[Ss]eit$"), "s").when(s.isin(*LEADS), "b").when(s.isin(*ARTICLES), "e"), mark, F.when(F.col("orth") == "upperInitial", "C").otherwise("l"))
    place = F.coalesce(F.when(F.col("_canton"), "K").when(F.col("_city") & (s != "Gross"), "Y").when(F.col("_street"), "T").when(s.rlike("^[1-9][0-9]{3}$"), "Z").when(s.rlike("^[1-9][0-9]{0,2}$"), "n").when(s == "CH", "c").when(F.col("_place"), "P").when(F.col("_name"), "M").when(s.rlike("^[A-Za-z]$"), "i"), mark, F.lit("l"))
    name = F.when(F.col("_named") & F.col("_first") & ~F.col("_stop") & (F.col("_often") | ~F.col("_general")) & (s != "Enkel"), "X").otherwise("l")
    phases = {"work": (r.OCCUPATIONS, r.OCCUPATION_STARTS), "place": (r.CITIES, r.ZIPS, r.STREETS, r.CANTONS), "name": (r.NAMES_IN_CONTEXT,)}
    return in_characters(t, {"work": work, "place": place, "name": name}, [(code, rules) for code, of_code in phases.items() for rules in of_code], keys)


#: What a pseudonymised field can hold in place of a value, and words before Zug that don't make it a train.
RAW_NULL = "___raw_null___"
BEFORE_TOWN = ("in", "von", "nach")


def without_traps(annotations: DataFrame, words: DataFrame, hits: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``annotations`` without places and names on ``___raw_null___``, and without places on Zug behind a stop word."""
    w = Window.partitionBy(*keys).orderBy("tok_idx")
    t = over(words, hits, {"_stop": (F.col("major") == "stop") | (F.col("minor") == "stop")}, keys)
    around = F.array_join(F.array(*[F.coalesce(F.lead("string", k).over(w), F.lit(" ")) for k in range(10)]), "")
    seen = t.select(*keys, "start", "string", around.alias("run"), F.lag("_stop").over(w).alias("_after"), F.lag("string").over(w).alias("_before"))
    raw = seen.where(F.col("run").startswith(RAW_NULL)).select(*keys, F.col("start").alias("_from"), (F.col("start") + len(RAW_NULL)).alias("_to"), F.array(F.lit("Location"), F.lit("Name")).alias("_types"))
    train = seen.where((F.col("string") == "Zug") & F.col("_after") & ~F.col("_before").isin(*BEFORE_TOWN)).select(*keys, F.col("start").alias("_from"), (F.col("start") + 3).alias("_to"), F.array(F.lit("Location")).alias("_types"))
    bad = raw.unionByName(train).withColumnsRenamed({"_from": "start", "_to": "end", "_types": "types"})
    return without_overlap(annotations, bad, keys, F.array_contains("o_types", F.col("type")), ("start", "end", "type"))
