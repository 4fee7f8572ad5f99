"""The stages of a plan: what each is called, what it needs before it, and what it does to the spans found so far."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.actions import acted
from spanloom.operators.contexts import metadata_annotations, propagate, trigger_contexts
from spanloom.operators.fields import Mapping, map_fields, structured_annotations, without_forbidden
from spanloom.operators.lexicon import direct_annotations, suffix_lookups, text_lookups, without_false_positives
from spanloom.operators.lookup_rules import lookup_annotations, without_traps
from spanloom.operators.names import name_annotations
from spanloom.operators.resolve import enforce_schema, merge_spans, of_types, remove_redundant, remove_weaker, split_overlaps
from spanloom.operators.rules import Rule, annotate
from spanloom.operators.tokens import dealt, token_table, work_tokens
from spanloom.rulesets import dates, others
from spanloom.sources.kept import settled, written

#: The phases that need nothing but a text, in order.
TEXT_PHASES: dict[str, list[Rule]] = {
    "Occupations": others.OCCUPATIONS, "Dates": dates.RULES, "Names": others.NAMES, "Age": others.AGE, "Internet": others.INTERNET,
    "Contacts": others.CONTACTS, "Locations": others.LOCATIONS, "Buildings": others.BUILDINGS, "IDs": others.IDS, "Various": [r for r in others.FIELDS if r.context is None],
}
#: What a text that is a field of a known kind gets beside the above: the rules of such kinds.
FIELD_PHASES: dict[str, list[Rule]] = {"Fields": [r for rules in (others.OCCUPATIONS, others.IDS, others.FIELDS) for r in rules if r.context is not None]}


FIRST_FIELD, STRUCTURED, LEXICON, LOOKUP_RULES, METADATA, PROPAGATED = range(100, 700, 100)
COLUMNS = ("doc_id", "stage", "start", "end", "type", "subtype", "rule", "text", "features")


@dataclass(frozen=True)
class Settings:
    """What a site brings along; every part is optional.

    ``lexicon`` and ``suffixes`` are term tables, ``triggers(token, context, left,
    right)`` open contexts, ``mappings`` say which kind a field is of, ``structured``
    which fields are a span as a whole, ``blacklist`` which types no span may have
    in a field, ``deleted`` which fields are emptied, and ``metadata(doc_id, type,
    value)`` what is known of a document. ``rules`` are a phase of their own, and
    each of ``stages`` is given the documents and gives back spans.
    """

    lexicon: DataFrame | None = None
    suffixes: DataFrame | None = None
    triggers: DataFrame | None = None
    mappings: tuple[Mapping, ...] = ()
    structured: tuple[Mapping, ...] = ()
    blacklist: dict[str, list[str]] = field(default_factory=dict)
    deleted: tuple[str, ...] = ()
    metadata: DataFrame | None = None
    rules: tuple[Rule, ...] = ()
    stages: tuple[Callable[[DataFrame], DataFrame], ...] = ()


def _staged(spans: DataFrame, stage: int | Column) -> DataFrame:
    texts = spans if "text" in spans.columns else spans.withColumn("text", F.lit(None).cast("string"))
    if "features" not in texts.columns:
        entries = F.array(F.struct(F.lit("rule").alias("key"), F.col("rule").alias("value")), F.struct(F.lit("type").alias("key"), F.col("subtype").alias("value")))
        texts = texts.withColumn("features", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != ""))))
    return texts.withColumn("stage", F.lit(stage) if isinstance(stage, int) else stage).select(*COLUMNS)


#: Equal texts are annotated together in groups of about so many rows.
GROUP = 200_000
#: Rows whose texts one task annotates.
TEXTS = 100_000


def annotated_alike(rows: DataFrame, phases: dict[str, list[Rule]], contexts_col: str | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``annotate``, for reports and fields: equal texts meet and are annotated together, and the spans are a written table.

    A text that very many rows hold is some groups of GROUP rows, by a hash of their
    keys. The rules, whose plan is long, are there once: no join or union lies by them.
    """
    total, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    by, row = ["text", *([contexts_col] if contexts_col else [])], F.struct(*keys)
    part = F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-total // GROUP))))
    dealt = rows.where("text is not null").withColumn("_part", part).repartition(max(cores, -(-total // TEXTS)), "text", "_part")
    alike = dealt.groupBy(*by, "_part").agg(F.collect_list(row).alias("_rows")).drop("_part")
    found = written(annotate(alike, phases, contexts_col=contexts_col, keys=("_rows",)))
    return found.select(F.explode("_rows").alias("_row"), *found.columns[1:]).select("_row.*", *found.columns[1:])


def _rules(phases: dict[str, list[Rule]]) -> list[Rule]:
    return [r for rules in phases.values() for r in rules]


def _of_phases(found: DataFrame, phases: dict[str, list[Rule]], first: int = 0) -> DataFrame:
    return _staged(found, F.coalesce(*[F.when(F.col("phase") == name, F.lit(first + k)) for k, name in enumerate(phases)]))


def _fields_of_kinds(leaves: DataFrame, mappings: tuple[Mapping, ...]) -> DataFrame:
    """``(doc_id, _from, text, kinds)``: the fields that the mappings give a kind."""
    kinds = map_fields(leaves.where("not is_null and end > start"), list(mappings))
    return kinds.where(F.size("types") > 0).select("doc_id", F.col("start").alias("_from"), F.col("value").alias("text"), F.transform("types", lambda t: t["type"]).alias("kinds"))


def _around_triggers(docs: DataFrame, triggers: DataFrame) -> DataFrame:
    """``(doc_id, _from, text, kinds)``: the stretches of text that triggers make a context of."""
    places = trigger_contexts(docs, triggers, keys=("doc_id", "text"))
    return places.select("doc_id", F.col("start").alias("_from"), F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start")).alias("text"), F.array("context").alias("kinds"))


def _in_contexts(rows: DataFrame, phases: dict[str, list[Rule]], alike: bool = False) -> DataFrame:
    """What the rules with a context find in each stretch of text by itself."""
    if all(r.context is not None for r in _rules(phases)):
        rows = rows.where(F.arrays_overlap("kinds", F.array(*[F.lit(c) for c in sorted({r.context for r in _rules(phases)})]).cast("array<string>")))
    spans = (annotated_alike if alike else annotate)(rows, phases, contexts_col="kinds", keys=("doc_id", "_from"))
    found = _of_phases(acted(spans, ("doc_id", "_from"), _rules(phases)).withColumn("start", F.col("_from") + F.col("start")).withColumn("end", F.col("_from") + F.col("end")), phases, FIRST_FIELD)
    return found


def _contexts(docs: DataFrame, leaves: DataFrame | None, mappings: tuple[Mapping, ...], triggers: DataFrame | None) -> DataFrame | None:
    """``(doc_id, start, end, context)``: around triggers, and fields of a kind."""
    out = trigger_contexts(docs, triggers) if triggers is not None else None
    if mappings and leaves is not None:
        kinds = map_fields(leaves.where("not is_null and end > start"), mappings).select("doc_id", "start", "end", F.explode("types.type").alias("context"))
        out = kinds if out is None else out.unionByName(kinds)
    return out



@dataclass(frozen=True)
class State:
    """What the stages hand on: the documents, the fields of their reports, what the site brings, and the spans found so far."""

    docs: DataFrame
    leaves: DataFrame | None
    settings: Settings
    phases: dict[str, list[Rule]]
    field_phases: dict[str, list[Rule]]
    types: tuple[str, ...] = ()
    found: DataFrame | None = None
    whole: DataFrame | None = None
    words: DataFrame | None = None
    hits: DataFrame | None = None

    def plus(self, spans: DataFrame, **more) -> State:
        """With more spans."""
        return replace(self, found=spans if self.found is None else self.found.unionByName(spans), **more)


@dataclass(frozen=True)
class Stage:
    """``needs``: stages that have to come before it. ``after``: stages that come before it if they are in the plan at all."""

    run: Callable[[State], State]
    needs: tuple[str, ...] = ()
    after: tuple[str, ...] = ()


STAGES: dict[str, Stage] = {}


def stage(name: str, needs: tuple[str, ...] = (), after: tuple[str, ...] = ()):
    """Registers a stage; a site's own are named in plans like these."""

    def add(f: Callable[[State], State]) -> Callable[[State], State]:
        STAGES[name] = Stage(f, needs, after)
        return f

    return add


@stage("rules")
def _(s: State) -> State:
    """The rules that need nothing but a text.

    Spans are read by many stages (conflicts read them twice), so they are worked
    out once, before features, in a plan of its own. Reports are many, short and
    often alike; other texts are dealt to tasks by their bytes.
    """
    found = written(annotate(dealt(s.docs, "text", ("doc_id", "text")), s.phases)) if s.leaves is None else annotated_alike(s.docs, s.phases)
    return s.plus(_of_phases(acted(found, rules=_rules(s.phases)), s.phases))


@stage("field_rules", after=("rules",))
def _(s: State) -> State:
    """The rules with a context, in fields of its kind and in what triggers make one of."""
    parts = [_fields_of_kinds(s.leaves, s.settings.mappings)] if s.settings.mappings else []
    parts += [_around_triggers(s.docs, s.settings.triggers)] if s.settings.triggers is not None else []
    for rows in parts:
        s = s.plus(_in_contexts(rows, s.field_phases, s.leaves is not None))
    return s


@stage("structured", after=("rules",))
def _(s: State) -> State:
    """Fields that are a span as a whole."""
    whole = structured_annotations(s.leaves, list(s.settings.structured)).withColumn("subtype", F.col("features")["type"])
    whole = whole if s.leaves is None else written(whole)
    return s.plus(_staged(whole, STRUCTURED), whole=whole)


@stage("words", after=("rules",))
def _(s: State) -> State:
    return replace(s, words=work_tokens(token_table(s.docs)))


@stage("lookups", needs=("rules", "words"), after=("field_rules", "structured"))
def _(s: State) -> State:
    """Entries of the lexicon, names by them, and what false positives take away.

    What was found so far is read several times from here on, so it is worked out once.
    """
    hits = text_lookups(s.docs, s.settings.lexicon)
    if s.settings.suffixes is not None:
        hits = hits.unionByName(suffix_lookups(s.words, s.settings.suffixes).select("doc_id", "start", "end", F.col("string").alias("term"), "major", "minor", F.lit("").alias("language")))
    hits = settled(hits)
    direct = direct_annotations(hits).withColumn("rule", F.lit("Lexicon"))
    found = s.found.unionByName(_staged(direct, LEXICON)).unionByName(_staged(name_annotations(s.words, hits), LEXICON))
    return replace(s, hits=hits, found=settled(without_traps(without_false_positives(settled(found), hits), s.words, hits)))


@stage("lookup_rules", needs=("lookups",))
def _(s: State) -> State:
    """Rules that combine labels of the lexicon with contexts and earlier spans."""
    around = _contexts(s.docs, s.leaves, s.settings.mappings, s.settings.triggers)
    return s.plus(_staged(lookup_annotations(s.words, s.hits, around, s.found), LOOKUP_RULES))


@stage("metadata", needs=("words",), after=("lookups",))
def _(s: State) -> State:
    """What is known of a document, among its words."""
    known = metadata_annotations(s.words, s.settings.metadata, s.hits).withColumns({"subtype": F.lit(None).cast("string"), "rule": F.lit("Metadata")})
    return s.plus(_staged(known, METADATA))


@stage("propagate", needs=("structured",), after=("lookup_rules",))
def _(s: State) -> State:
    """What structured fields hold, everywhere in their documents."""
    whole = s.whole.join(s.docs.select("doc_id", F.col("text").alias("_whole")), "doc_id")
    sure = whole.withColumns({"text": F.col("_whole").substr(F.col("start") + 1, F.col("end") - F.col("start")), "confidence": F.lit(None).cast("string")})
    again = propagate(s.docs, sure).join(sure.groupBy("doc_id", "text").agg(F.min_by("subtype", F.col("start")).alias("subtype")), ["doc_id", "text"])
    return s.plus(_staged(again, PROPAGATED))


@stage("site", needs=("rules",), after=("propagate",))
def _(s: State) -> State:
    """The site's own stages: functions of the documents."""
    for k, own in enumerate(s.settings.stages):
        s = s.plus(_staged(own(s.docs), PROPAGATED + 1 + k))
    return s


@stage("blacklist", needs=("rules",), after=("field_rules", "structured", "lookups", "lookup_rules", "metadata", "propagate", "site"))
def _(s: State) -> State:
    return replace(s, found=without_forbidden(s.found, s.leaves, s.settings.blacklist))


@stage("schema", needs=("rules",), after=("blacklist", "field_rules", "structured", "lookups", "lookup_rules", "metadata", "propagate", "site"))
def _(s: State) -> State:
    """Known types alone, numbered by stage, place and rule, so that of equals the later stage's stays."""
    order = Window.partitionBy("doc_id").orderBy("stage", "start", "end", "rule", "type", "subtype")
    known = enforce_schema(of_types(s.found, list(s.types)).dropDuplicates([c for c in COLUMNS if c != "features"]))
    return replace(s, found=known.withColumn("ann_id", F.row_number().over(order)).withColumn("confidence", F.lit(None).cast("string")))


@stage("clean", needs=("schema",))
def _(s: State) -> State:
    """Trimmed spans, and those of a type merged."""
    cut = F.length(F.regexp_extract("text", r"(?:\s|\\n|\\r)+$", 0))
    spans = settled(s.found.withColumn("end", F.col("end") - F.coalesce(cut, F.lit(0))).where("end > start"))
    return replace(s, found=merge_spans(spans, apart=True))


@stage("conflicts", needs=("schema",), after=("clean",))
def _(s: State) -> State:
    spans = s.found.select("doc_id", "ann_id", "start", "end", "type", "subtype", "rule", "confidence", "features")
    return replace(s, found=split_overlaps(remove_redundant(remove_weaker(spans))))


def checked(names: Iterable[str]) -> list[str]:
    """The plan as it is, if each of its stages is known, there once, and behind what it needs; otherwise this raises."""
    plan, seen = list(names), set()
    for name in plan:
        if name not in STAGES:
            raise ValueError(f"no such stage: {name}")
        if name in seen:
            raise ValueError(f"{name} is in the plan twice")
        if missing := [n for n in STAGES[name].needs if n not in seen]:
            raise ValueError(f"{name} needs {', '.join(missing)} before it")
        if late := [n for n in STAGES[name].after if n in plan and n not in seen]:
            raise ValueError(f"{name} has to come after {', '.join(late)}")
        seen.add(name)
    return plan


def planned(settings: Settings, clean: bool = False) -> list[str]:
    """The stages, in order, that what a site brings asks for."""
    wanted = {
        "rules": True, "field_rules": settings.mappings or settings.triggers is not None, "structured": settings.structured, "words": settings.lexicon is not None or settings.metadata is not None, "lookups": settings.lexicon is not None,
        "lookup_rules": settings.lexicon is not None, "metadata": settings.metadata is not None, "propagate": settings.structured, "site": settings.stages, "blacklist": settings.blacklist, "schema": True, "clean": clean, "conflicts": True,
    }
    return checked(name for name, use in wanted.items() if use)


def run_plan(plan: Iterable[str], state: State) -> DataFrame:
    """The spans that a plan leaves."""
    names = checked(plan)
    if state.leaves is None and (state.settings.mappings or state.settings.structured or state.settings.blacklist):
        raise ValueError("mappings, structured fields and a blacklist need the leaves")
    for name in names:
        state = STAGES[name].run(state)
    return state.found
