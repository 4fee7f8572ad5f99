"""What a rule makes of its match: named actions, from the texts of its groups to features, removals and merged spans.

A rule names its action, in code or in a rule table; without a name its type says
it. Feature actions are expressions over one span: ``text``, and ``other``, the
text of the other span of the same match (the far end of a range of dates, a
salutation before a name). Removing and merging look at the spans of a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.dates import date_features
from spanloom.functions.names import name_parts
from spanloom.functions.text import let
from spanloom.operators.intervals import without_overlap
from spanloom.operators.rules import Rule

FeatureAction = Callable[[Column, Column], Column]
FEATURES = "map<string,string>"
ACTIONS: dict[str, FeatureAction] = {}
#: What a type's spans get where their rule names no action.
BY_TYPE = {"Date": "emit_date", "Name": "emit_name"}
#: Actions over a document's spans: these go with all of their type that they overlap, those are joined where they follow each other.
DELETE, MERGE = "delete", "merge_sequence"
#: Spans of one rule with no more than so many characters between them follow each other.
GAP = 1


def action(name: str) -> Callable[[FeatureAction], FeatureAction]:
    """Registers a feature action; a site's own are named like these in its rules."""

    def add(f: FeatureAction) -> FeatureAction:
        ACTIONS[name] = f
        return f

    return add


def _present(**values: Column) -> Column:
    """A map of those values that are there."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != "")))


@action("emit")
def _(text: Column, other: Column) -> Column:
    return F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))


@action("emit_date")
def _(text: Column, other: Column) -> Column:
    return let(date_features(text, other), lambda parts: _present(day=parts["day"], month=parts["month"], year=parts["year"], format=parts["format"]))


@action("emit_name")
def _(text: Column, other: Column) -> Column:
    return let(name_parts(text), lambda parts: _present(salutation=F.coalesce(F.trim(other), parts["salutation"]), firstname=parts["firstname"], lastname=parts["lastname"], format=parts["format"]))


def with_features(spans: DataFrame) -> DataFrame:
    """``spans(type, subtype, rule, text, other, action)`` with ``features``: what their actions read off, and their rule and type.

    An action that nobody has registered raises when the plan is run.
    """
    named = F.when(F.coalesce("action", F.lit("")) != "", F.col("action")).otherwise(F.coalesce(*[F.when(F.col("type") == t, F.lit(a)) for t, a in BY_TYPE.items()], F.lit("emit")))
    made = F.when(named.isin(DELETE, MERGE), ACTIONS["emit"](F.col("text"), F.col("other")))
    for name, f in ACTIONS.items():
        made = made.when(named == name, f(F.col("text"), F.col("other")))
    made = made.otherwise(F.raise_error(F.concat(F.lit("no such action: "), named)).cast(FEATURES))
    return spans.withColumn("features", F.map_concat(made, _present(rule=F.col("rule"), type=F.col("subtype"))))


def acted(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",), rules: Iterable[Rule] | None = None) -> DataFrame:
    """``spans`` with features, after removals and merges; ``action`` and ``other`` are used up.

    ``rules``: those that the spans are from; if none of them removes or merges, nothing is compared.
    """
    featured = with_features(spans).drop("other")
    if rules is not None and not {r.action for r in rules} & {DELETE, MERGE}:
        return featured.drop("action")
    gone = F.coalesce(F.col("action") == DELETE, F.lit(False))
    bad = featured.where(gone).select(*keys, "start", "end", "type")
    kept = without_overlap(featured.where(~gone), bad, keys, F.col("type") == F.col("o_type"), ("start", "end", "type"))
    merged = F.coalesce(F.col("action") == MERGE, F.lit(False))
    return kept.where(~merged).unionByName(_merged(kept.where(merged), keys)).drop("action")


def _merged(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Spans of one rule and type that follow each other as one; its text has a blank where they were apart."""
    by = (*keys, "type", "subtype", "rule")
    rest = [c for c in spans.columns if c not in (*by, "start", "end", "text")]
    w = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.withColumn("_apart", F.col("start") - reach).withColumn("_new", F.coalesce(F.col("_apart") > GAP, F.lit(True)).cast("int"))
    numbered = cut.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.struct("start", F.when((F.col("_new") == 0) & (F.col("_apart") > 0), F.concat(F.lit(" "), "text")).otherwise(F.col("text")).alias("text"))
    whole = numbered.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"]), "").alias("text"), *[F.min_by(c, "start").alias(c) for c in rest])
    return whole.select(*spans.columns)
