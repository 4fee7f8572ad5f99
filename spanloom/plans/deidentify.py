"""De-identification from documents to substituted text, and diagnosis extraction, as stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.actions import DELETE
from spanloom.operators.contexts import trigger_contexts
from spanloom.operators.diagnosis import certainty, consolidate, keyword_annotations
from spanloom.operators.fields import Mapping, delete_fields, flatten, json_leaves, rebuild, report_texts, without_forbidden, xml_leaves
from spanloom.operators.intervals import join_overlapping, without_overlap
from spanloom.operators.rules import Rule, annotate
from spanloom.operators.substitute import Method, Policy, substitute
from spanloom.plans.stages import FIELD_PHASES, TEXT_PHASES, Settings, State, planned, run_plan, written
from spanloom.rulesets import others


def find(
    docs: DataFrame, lexicon: DataFrame | None = None, phases: dict[str, list[Rule]] = TEXT_PHASES, leaves: DataFrame | None = None, mappings: list[Mapping] | None = None,
    structured: list[Mapping] | None = None, blacklist: dict[str, list[str]] | None = None, metadata: DataFrame | None = None, field_phases: dict[str, list[Rule]] = FIELD_PHASES,
    triggers: DataFrame | None = None, suffixes: DataFrame | None = None, clean: bool = False, stages: tuple[Callable[[DataFrame], DataFrame], ...] = (),
) -> DataFrame:
    """``(doc_id, ann_id, start, end, type, subtype, rule, confidence, features)``: the spans that are left after all conflicts.

    What is given asks for the stages of the plan (see ``stages.planned``). ``leaves``
    are the fields of the reports that ``docs`` are the texts of, as ``flatten`` gives
    them. ``mappings`` say which kind a field is of, and rules with that context run
    in it; ``triggers`` make contexts within a text; ``structured`` says which fields
    are a span as a whole, and what they hold is found everywhere in its document;
    ``blacklist`` says which types no span may have in a field. ``metadata(doc_id,
    type, value)`` is looked up among the tokens. ``stages`` are functions of the
    documents that give back ``(doc_id, start, end, type, subtype, rule)``. ``clean``:
    trim spans and merge those of a type. Spans are numbered by stage, place and
    rule, so of equals the later stage's stays.
    """
    settings = Settings(lexicon, suffixes, triggers, tuple(mappings or ()), tuple(structured or ()), blacklist or {}, (), metadata, (), stages)
    return run_plan(planned(settings, clean), State(docs, leaves, settings, phases, field_phases))


def deidentify(docs: DataFrame, policy: Policy, lexicon: DataFrame | None = None, phases: dict[str, list[Rule]] = TEXT_PHASES, **stages) -> DataFrame:
    """``docs`` with what identifies people replaced by the policy; ``stages`` as in ``find``."""
    spans = find(docs, lexicon, phases, **stages)
    if policy.method.value in ("DateShift", "ReplacementTags", "Identity") or policy.keep_dates or policy.keep_patient_ids or policy.keep_case_ids:
        spans = docs.select("doc_id", "text").join(spans, "doc_id").withColumn("text", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")))
    else:
        spans = spans.withColumn("text", F.lit(""))
    return substitute(docs, spans, policy)


def find_in_reports(reports: DataFrame, settings: Settings = Settings(), phases: dict[str, list[Rule]] = TEXT_PHASES, xml: bool = False, plan: list[str] | None = None, types: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The leaves of ``reports(doc_id, content)`` and the spans in their texts, through the stages of the plan (all that the settings ask for, if none is given)."""
    # parsed twice, for texts and for fields, and not again by each stage that reads them
    leaves, texts = written(flatten(reports, xml=xml)), written(report_texts(reports, xml=xml))
    phases = {**phases, "Site": list(settings.rules)} if settings.rules else phases
    own = [r for r in settings.rules if r.context is not None]
    state = State(texts, leaves, settings, phases, {**FIELD_PHASES, "SiteFields": own} if own else FIELD_PHASES, types)
    return leaves, run_plan(planned(settings, clean=True) if plan is None else plan, state)


def _once(reports: DataFrame, settings: Settings, plan: list[str] | None) -> DataFrame | None:
    """``(doc_id, content)``: each different report once, under a number of its own; None where more than its content decides what is found in it.

    That is so for metadata and a site's own stages, which see a report's key.
    """
    if settings.metadata is not None or settings.stages or plan is not None:
        return None
    # a number is drawn again with every run, so it has to be written
    return written(reports.where("content is not null").groupBy("content").agg(F.count(F.lit(1)).alias("n")).select(F.monotonically_increasing_id().alias("doc_id"), "content"))


def report_spans(reports: DataFrame, settings: Settings = Settings(), phases: dict[str, list[Rule]] = TEXT_PHASES, xml: bool = False, plan: list[str] | None = None, types: tuple[str, ...] = ()) -> DataFrame:
    """The spans of ``find_in_reports`` alone; reports of equal content go through the stages once."""
    once = _once(reports, settings, plan)
    if once is None:
        return find_in_reports(reports, settings, phases, xml, plan, types)[1]
    spans = find_in_reports(once, settings, phases, xml, plan, types)[1]
    of = reports.select("doc_id", "content").join(once.withColumnRenamed("doc_id", "_once"), "content").select("doc_id", "_once")
    return of.join(spans.withColumnRenamed("doc_id", "_once"), "_once").select(*spans.columns)


def deidentify_reports(reports: DataFrame, policy: Policy, settings: Settings = Settings(), phases: dict[str, list[Rule]] = TEXT_PHASES, xml: bool = False, plan: list[str] | None = None, types: tuple[str, ...] = ()) -> DataFrame:
    """``reports(doc_id, content, …)`` as JSON (or XML) again, with what identifies people replaced in their fields.

    Spans are cut at the borders of fields and replaced field by field; dates of one
    report move alike. Fields that the settings delete are emptied. Reports that
    can't be read are not in the result: see ``quarantine``. Reports of equal content
    go through all of it once, unless their keys decide more (see ``_once``), such as
    how far dates are shifted.
    """
    once = _once(reports, settings, plan) if policy.method is not Method.DATE_SHIFT else None
    if once is None:
        return _deidentified(reports, policy, settings, phases, xml, plan, types)
    done = _deidentified(once, policy, settings, phases, xml, plan, types).select("doc_id", F.col("content").alias("_new"))
    new = once.join(done, "doc_id").select("content", "_new")
    return reports.join(new, "content").withColumn("content", F.col("_new")).select(*reports.columns)


def _deidentified(reports: DataFrame, policy: Policy, settings: Settings, phases: dict[str, list[Rule]], xml: bool, plan: list[str] | None, types: tuple[str, ...]) -> DataFrame:
    """``deidentify_reports``, each report by itself."""
    readable = reports.where((xml_leaves if xml else json_leaves)("content").isNotNull())
    leaves, spans = find_in_reports(reports, settings, phases, xml, plan, types)
    leaves = delete_fields(leaves, list(settings.deleted)) if settings.deleted else leaves
    fields = leaves.where("end > start").select("doc_id", "field_id", "value", "start", "end")
    inside = join_overlapping(spans, fields, prefix="f_")
    cut = inside.withColumns({"start": F.greatest("start", "f_start") - F.col("f_start"), "end": F.least("end", "f_end") - F.col("f_start")})
    value = F.col("f_value")
    texts = cut.where(value != "").select(*spans.columns, F.col("f_field_id").alias("field_id"), F.coalesce(value.substr(F.col("start") + 1, F.col("end") - F.col("start")), F.lit("")).alias("text"))
    changed = substitute(leaves.select("doc_id", "field_id", "value"), texts, policy, "value", ("doc_id", "field_id"), ("doc_id",))
    return rebuild(readable, changed, xml=xml)


def diagnoses(docs: DataFrame, keywords: dict[str, list[str]], triggers: DataFrame, leaves: DataFrame | None = None, blacklist: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, code, reliability, text)``: coded findings with their certainty.

    A finding that a rule calls an enquiry (a clinic's hours, a check-up) goes, one
    that a rule calls suspected is. ``blacklist``: paths of ``leaves`` in which no
    keyword counts.
    """
    by_rule = annotate(docs, {"Diagnosis": others.DIAGNOSIS})
    found = without_overlap(keyword_annotations(docs, keywords), by_rule.where(F.col("action") == DELETE).select("doc_id", "start", "end"))
    if blacklist:
        if leaves is None:
            raise ValueError("a blacklist of paths needs the leaves")
        found = without_forbidden(found.withColumn("type", F.lit("Diagnosis")), leaves, {path: ["Diagnosis"] for path in blacklist}).drop("type")
    suspected = by_rule.where(F.col("rule") == "SuspectedDiagnosis").select("doc_id", "start", "end", F.lit("SuspectionContext").alias("context"))
    return consolidate(certainty(found, trigger_contexts(docs, triggers).unionByName(suspected)))
