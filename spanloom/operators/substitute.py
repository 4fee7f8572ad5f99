"""Replacing spans: policies, and the text that comes out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.dates import as_date, date_parts, format_date
from spanloom.functions.text import let


class Method(Enum):
    SCRUBBER = "Scrubber"
    DATE_SHIFT = "DateShift"
    REPLACEMENT_TAGS = "ReplacementTags"
    IDENTITY = "Identity"
    EXPLORATION = "Exploration"


# What stands for each kind of span.
PLAIN = {"Date": "DATE", "Name": "NAME", "Address": "ADDRESS", "Occupation": "OCCUPATION", "Age": "AGE", "Location": "LOCATION", "ID": "ID", "Contact": "CONTACT_INFO"}
BY_SUBTYPE = {
    ("Location", "organisation"): "ORGANISATION",
    ("Location", "organisational unit"): "ORGANISATIONAL UNIT",
    ("Location", "street"): "STREET",
    ("Location", "zip"): "PLZ",
    ("Location", "city"): "CITY",
    ("Location", "canton"): "ZH",
    ("Location", "country"): "COUNTRY",
    ("ID", "patient ID"): "PATIENT_ID",
    ("ID", "case ID"): "CASE_ID",
    ("ID", "social security number"): "SOCIAL_SECURITY_ID",
    ("ID", "insurance ID"): "INSURANCE_ID",
    ("Contact", "phone number"): "PHONE",
    ("Contact", "fax"): "FAX",
    ("Contact", "email"): "EMAIL",
    ("Contact", "website"): "WEBSITE",
}
OPEN, CLOSE = "[&[", "]&]"
SOME_DATE = "31.01.1850"


@dataclass(frozen=True)
class Policy:
    """How spans are replaced; options that contradict each other raise when it is made."""

    method: Method = Method.SCRUBBER
    keep_dates: bool = False
    keep_patient_ids: bool = False
    keep_case_ids: bool = False
    whole_address: bool = True
    all_features: bool = False
    min_days: int | None = None
    max_days: int | None = None
    seed: int | None = None

    def __post_init__(self) -> None:
        if self.method is Method.DATE_SHIFT and (self.keep_dates or None in (self.min_days, self.max_days, self.seed) or self.min_days >= self.max_days):
            raise ValueError("shifting dates needs bounds and a seed, and can't keep dates")
        if self.method is Method.REPLACEMENT_TAGS and (self.keep_dates or self.keep_patient_ids or self.keep_case_ids):
            raise ValueError("replacement tags keep nothing")


def scrubbed(policy: Policy) -> Column:
    """The label of a span by its ``type`` and ``subtype``, or its own ``text`` where that is kept."""
    kind, subtype, text = F.col("type"), F.coalesce(F.col("subtype"), F.lit("")), F.col("text")
    keep = F.lit(False)
    if policy.keep_dates:
        keep = keep | (kind == "Date")
    if policy.keep_patient_ids:
        keep = keep | ((kind == "ID") & (subtype == "patient ID"))
    if policy.keep_case_ids:
        keep = keep | ((kind == "ID") & (subtype == "case ID"))
    table = F.create_map(*[F.lit(x) for (t, s), label in BY_SUBTYPE.items() for x in (f"{t}/{s}", label)])
    plain = F.create_map(*[F.lit(x) for kv in PLAIN.items() for x in kv])
    return F.when(keep, text).otherwise(F.coalesce(F.try_element_at(table, F.concat_ws("/", kind, subtype)), F.try_element_at(plain, kind), text))


def shift_days(policy: Policy, key: Column) -> Column:
    """How far a document's dates go back: the same for all its dates, from its key and the seed."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(policy.seed)), F.lit(policy.max_days - policy.min_days)) + policy.min_days


def with_shifted(spans: DataFrame, policy: Policy, keys: tuple[str, ...]) -> DataFrame:
    """``spans`` with ``_date``: a date's text, moved back and written in its own format.

    What can't be read is DATE. A missing year is the latest of the document's.
    Parts, date and text follow in projections of their own, so each is worked out once.
    """
    parts = date_parts(F.col("text"))
    if "features" in spans.columns:
        # what its rule read off, so that the near end of a range has the month and year of the far one
        told = lambda k: F.try_element_at("features", F.lit(k)).alias(k)
        parts = F.when(told("format").isNotNull(), F.struct(*[told(k) for k in ("day", "month", "year", "format")])).otherwise(parts)
    parsed = spans.withColumn("_parts", F.when(F.col("type") == "Date", parts))
    years = parsed.where("type = 'Date'").groupBy(*keys).agg(F.max(F.col("_parts.year").try_cast("int")).alias("_year"))
    dated = parsed.join(years, list(keys), "left").withColumn("_day", as_date(F.col("_parts"), F.coalesce("_year", F.lit(0))))
    moved = dated.withColumn("_moved", F.date_sub("_day", shift_days(policy, F.concat_ws("|", *keys)).cast("int")))
    return moved.withColumn("_date", F.coalesce(format_date(F.col("_moved"), F.col("_parts.format")), F.lit("DATE")))


def tagged(keys: tuple[str, ...] = ("subtype", "rule"), features: bool = False) -> Column:
    """``[&[type;text;key=value…]&]`` with keys in order; missing ones are empty. ``features``: those of the span instead of the keys."""
    safe = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit(";"), F.lit("SEMICOL"))
    pairs = [F.concat(F.lit(f"{k}="), safe(F.col(k).cast("string"))) for k in sorted(keys)]
    if features:
        pairs = [F.transform(F.array_sort(F.map_entries("features")), lambda e: F.concat(e["key"], F.lit("="), safe(e["value"])))]
    return F.concat(F.lit(OPEN), F.concat_ws(";", F.col("type"), safe(F.col("text")), *pairs), F.lit(CLOSE))


def tags_valid(text: Column) -> Column:
    """Whether opening and closing tags alternate and none is left open."""
    marks = F.regexp_replace(F.replace(F.replace(F.regexp_replace(text, "[\x01\x02]", ""), F.lit(OPEN), F.lit("\x01")), F.lit(CLOSE), F.lit("\x02")), "[^\x01\x02]", "")
    return F.regexp_replace(marks, "\x01\x02", "") == ""


def replacement(policy: Policy) -> Column:
    """What a policy puts in place of the span in the row; shifted dates are in ``_date``."""
    if policy.method is Method.IDENTITY:
        return F.col("text")
    if policy.method is Method.EXPLORATION:
        return F.when(F.col("type") == "Date", SOME_DATE).otherwise(F.col("text"))
    if policy.method is Method.REPLACEMENT_TAGS:
        return tagged(features=policy.all_features)
    if policy.method is Method.DATE_SHIFT:
        return F.when(F.col("type") == "Date", F.col("_date")).otherwise(scrubbed(policy))
    return scrubbed(policy)


def rebuild_text(text: Column, spans: Column) -> Column:
    """``text`` with each span's ``new`` in its place; spans don't overlap.

    ``spans`` is an array of ``(start, end, new)``. Each part is a gap and the
    replacement behind it; parts are joined once, so nothing is copied again.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["new"].alias("new"))))
    part = lambda s, at: F.when(s.isNotNull(), F.concat(F.substring(text, at + 1, s["start"] - at), F.coalesce(s["new"], F.lit("")))).otherwise(F.substring(text, at + 1, F.length(text)))
    return let(ordered, lambda o: F.array_join(F.zip_with(o, F.concat(F.array(F.lit(0)), F.transform(o, lambda s: s["end"])), part), ""))


def substitute(docs: DataFrame, spans: DataFrame, policy: Policy, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",), owner: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` with their spans replaced. ``spans(keys, start, end, type, subtype, rule, text)`` must not overlap.

    The text is joined with its spans once; a document without a span stays.
    ``owner``: the keys whose dates are shifted alike, if not ``keys``.
    """
    chosen = spans if policy.whole_address else spans.where("type != 'Address'")
    if policy.method is Method.DATE_SHIFT:
        chosen = with_shifted(chosen, policy, owner or keys)
    new = replacement(policy)
    rows = chosen.select(*keys, F.struct("start", "end", new.alias("new")).alias("s")).groupBy(*keys).agg(F.collect_list("s").alias("_spans"))
    return docs.join(rows, list(keys), "left").withColumn(text_col, F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(rebuild_text(F.col(text_col), F.col("_spans")))).drop("_spans")


Sink = Callable[[DataFrame], None]


def substitute_and_write(docs: DataFrame, spans: DataFrame, policy: Policy, sinks: list[Sink], **kwargs) -> DataFrame:
    """One substitution, several sinks; it is computed once for all of them."""
    out = substitute(docs, spans, policy, **kwargs).persist()
    try:
        for sink in sinks:
            sink(out)
    finally:
        out.unpersist()
    return out
