"""Nested reports as field tables: flattening, mapping, deletion, and the way back."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import markup
from spanloom.functions.paths import path_matches
from spanloom.functions.text import running
from spanloom.operators.intervals import join_within

LEAVES = "array<struct<path:array<string>,steps:array<string>,value:string,is_null:boolean>>"
LEAVES_TYPE = pa.list_(pa.struct([("path", pa.list_(pa.string())), ("steps", pa.list_(pa.string())), ("value", pa.string()), ("is_null", pa.bool_())]))
ITEM = "LISTELEMENT"


def _walk(node, path: tuple, steps: tuple):
    if isinstance(node, dict) and node:
        for name, child in node.items():
            yield from _walk(child, (*path, name), (*steps, name))
    elif isinstance(node, list) and node:
        for k, child in enumerate(node):
            yield from _walk(child, (*path, ITEM), (*steps, str(k)))
    else:
        text = node if isinstance(node, str) else None if node is None else json.dumps(node, ensure_ascii=False)
        yield path, steps, text, node is None


#: Reports that are read and put into columns at once.
READ = 500


def _leaves(reports: pa.Array, read: Callable[[str], list[tuple] | None]) -> pa.Array:
    """The leaves of a batch of reports, column by column; null where ``read`` gives None. Few reports are held as Python values at a time."""
    parts = []
    for first in range(0, len(reports), READ):
        rows = [None if text is None else read(text) for text in reports.slice(first, READ).to_pylist()]
        flat = [leaf for row in rows if row for leaf in row]
        columns = [pa.array([leaf[k] for leaf in flat], kind) for k, kind in enumerate((pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.bool_()))]
        leaves = pa.StructArray.from_arrays(columns, ["path", "steps", "value", "is_null"])
        offsets = np.concatenate([[0], np.cumsum([len(row or ()) for row in rows])]).astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(offsets), leaves, mask=pa.array([row is None for row in rows])))
    return pa.concat_arrays(parts) if parts else pa.array([], LEAVES_TYPE)


def json_leaves(report: Column | str) -> Column:
    """All leaves of a JSON report in order; null if it isn't valid JSON."""

    def one(text: str) -> list[tuple] | None:
        try:
            return list(_walk(json.loads(text), (), ()))
        except ValueError:
            return None

    return F.arrow_udf(lambda reports: _leaves(reports, one), LEAVES)(report)


def xml_leaves(report: Column | str) -> Column:
    """All texts of an XML report in order, under the names of their elements: attributes as ``@name``, and runs beside elements too.

    Null if it isn't well-formed. Document type declarations, and so entities of
    one's own, make a report unreadable.
    """

    def one(text: str) -> list[tuple] | None:
        return [(s.path, s.steps, s.value, False) for s in markup.slots(text)] if markup.readable(text) else None

    return F.arrow_udf(lambda reports: _leaves(reports, one), LEAVES)(report)


def flatten(reports: DataFrame, json_col: str = "content", keys: tuple[str, ...] = ("doc_id",), xml: bool = False) -> DataFrame:
    """``(keys, field_id, path, name, value, is_null, start, end)``: the leaves of each report.

    The report's text is its values, each on a line of its own; ``start`` and ``end``
    are a value's place there. Items of a list are called LISTELEMENT. Numbers and
    booleans keep their text. Reports that aren't JSON have no row here: see
    ``quarantine``.
    """
    leaves = reports.select(*keys, (xml_leaves if xml else json_leaves)(json_col).alias("leaves"))
    lengths = F.transform("leaves", lambda f: F.length(F.coalesce(f["value"], F.lit(""))) + 1)
    starts = running(lengths)
    # posexplode alone would make Spark push a test of the array's size, and so the reading of every report, below the UDF once more
    rows = leaves.withColumn("starts", starts).select(*keys, "starts", F.posexplode_outer("leaves").alias("field_id", "f")).where("field_id is not null")
    start = F.get("starts", F.col("field_id"))
    return rows.select(*keys, "field_id", "f.path", F.try_element_at("f.path", F.lit(-1)).alias("name"), "f.value", "f.is_null", start.alias("start"), (start + F.length(F.coalesce("f.value", F.lit("")))).alias("end"), "f.steps")


def report_texts(reports: DataFrame, json_col: str = "content", keys: tuple[str, ...] = ("doc_id",), xml: bool = False) -> DataFrame:
    """``(keys, text)``: each report's values, a line each, as ``flatten`` counts them; put together within the row."""
    leaves = reports.select(*keys, (xml_leaves if xml else json_leaves)(json_col).alias("leaves")).where("leaves is not null")
    lines = F.transform("leaves", lambda f: F.concat(F.coalesce(f["value"], F.lit("")), F.lit("\n")))
    return leaves.select(*keys, F.array_join(lines, "").alias("text"))


def quarantine(reports: DataFrame, json_col: str = "content", xml: bool = False) -> DataFrame:
    """Reports that can't be read: they are kept apart and never pass on unannotated."""
    return reports.where((xml_leaves if xml else json_leaves)(json_col).isNull())


def _put(node, rest):
    if isinstance(node, dict) and node:
        return {k: _put(v, rest) for k, v in node.items()}
    if isinstance(node, list) and node:
        return [_put(v, rest) for v in node]
    new = next(rest)
    return new if isinstance(node, str) else node


def _put_in(one: Callable[[str, list], str | None]):
    """A UDF of reports and lists of values; null where either is. Few of them are held as Python values at a time."""

    def put(reports: pa.Array, lists: pa.Array) -> pa.Array:
        parts = [pa.array([one(r, v) if r is not None and v is not None else None for r, v in zip(reports.slice(k, READ).to_pylist(), lists.slice(k, READ).to_pylist(), strict=True)], pa.string()) for k in range(0, len(reports), READ)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.arrow_udf(put, "string")


def with_values(report: Column | str, values: Column | str) -> Column:
    """The reports with the values of their leaves, in order, put in; null leaves stay null, and so does what isn't JSON."""

    def one(report: str, values) -> str | None:
        try:
            return json.dumps(_put(json.loads(report), iter(values)), ensure_ascii=False)
        except ValueError:
            return None

    return _put_in(one)(report, values)


def with_texts(report: Column | str, values: Column | str) -> Column:
    """XML reports with other texts in their slots, in order; all else stays byte for byte."""

    return _put_in(lambda r, v: markup.with_slots(r, v) if markup.readable(r) else None)(report, values)


def rebuild(reports: DataFrame, fields: DataFrame, json_col: str = "content", keys: tuple[str, ...] = ("doc_id",), xml: bool = False) -> DataFrame:
    """Reports with the (changed) values of ``fields`` in the places they came from."""
    values = fields.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("field_id", "value"))), lambda f: f["value"]).alias("_values"))
    return reports.join(values, list(keys), "left").withColumn(json_col, F.coalesce((with_texts if xml else with_values)(json_col, "_values"), F.col(json_col))).drop("_values")


@dataclass(frozen=True)
class Mapping:
    """A field of this path, whose kind isn't under one of the forbidden parents, is annotated as ``type``."""

    path: str
    type: str
    features: tuple[tuple[str, str], ...] = ()
    forbidden: tuple[str, ...] = ()

    @classmethod
    def parse(cls, line: str) -> Mapping | None:
        """``path; type; key=value,key=value; parent,parent``; None for comments and empty lines."""
        if not line.strip() or line.lstrip().startswith("#"):
            return None
        path, kind, features, forbidden = ([p.strip() for p in line.split(";")] + ["", "", ""])[:4]
        return cls(path, kind, tuple(tuple(f.split("=", 1)) for f in features.split(",") if "=" in f), tuple(p.strip() for p in forbidden.split(",") if p.strip()))


def map_fields(fields: DataFrame, mappings: list[Mapping]) -> DataFrame:
    """``fields`` with ``types``: what each field is by its path; several mappings can fire."""
    hits = []
    for m in mappings:
        bad = F.lit(False)
        for f in m.forbidden:
            bad = bad | F.array_contains("path", f)
        features = F.create_map(*[F.lit(x) for kv in m.features for x in kv]) if m.features else F.create_map().cast("map<string,string>")
        hit = F.struct(F.lit(m.type).alias("type"), features.alias("features"), F.lit(f"FieldMapping-{m.path}").alias("rule"))
        hits.append(F.when(path_matches(F.col("path"), m.path) & ~bad, hit))
    return fields.withColumn("types", F.filter(F.array(*hits), lambda h: h.isNotNull()) if hits else F.array())


def structured_annotations(fields: DataFrame, mappings: list[Mapping], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """An annotation over the whole of each leaf that a mapping names; empty leaves have none."""
    mapped = map_fields(fields.where("not is_null and end > start"), mappings)
    return mapped.select(*keys, "start", "end", F.explode("types").alias("t")).select(*keys, "start", "end", "t.*")


def delete_fields(fields: DataFrame, paths: list[str]) -> DataFrame:
    """``fields`` with the values under any of the paths emptied."""
    gone = F.lit(False)
    for p in paths:
        gone = gone | path_matches(F.col("path"), p)
    return fields.withColumn("value", F.when(gone & ~F.col("is_null"), "").otherwise(F.col("value")))


def without_forbidden(annotations: DataFrame, fields: DataFrame, blacklist: dict[str, list[str]], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Annotations whose type isn't forbidden in the field they lie in."""
    rules = [F.when(path_matches(F.col("path"), p), F.array(*[F.lit(t) for t in types])) for p, types in blacklist.items()]
    none = F.array().cast("array<string>")
    banned = F.flatten(F.array(*[F.coalesce(r, none) for r in rules])) if rules else none
    f = fields.select(*keys, "start", "end", F.explode(banned).alias("type"))
    return join_within(annotations, f, keys, "left_anti", F.col("type") == F.col("f_type"), prefix="f_")


def token_fields(tokens: DataFrame, fields: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Tokens with the name and path of the innermost field over them."""
    f = fields.select(*keys, "start", "end", F.struct(F.size("path").alias("depth"), F.col("name"), F.array_join("path", "/").alias("path")).alias("field"))
    inner = join_within(tokens, f, keys, "left", prefix="f_").groupBy(*tokens.columns).agg(F.max("f_field").alias("f"))
    return inner.select(*tokens.columns, F.col("f.name").alias("field_name"), F.col("f.path").alias("field_path"))


def escape_name(name: str) -> str:
    """A field name as an element name: empty ones, leading digits and marks are spelt out."""
    if not name:
        return "EMPTY"
    marked = "".join(c if c.isalnum() else f"___{ord(c)}---" for c in name)
    return f"NUMBER_{marked}" if marked[0].isdigit() else marked


def unescape_name(name: str) -> str:
    import re

    if name == "EMPTY":
        return ""
    return re.sub(r"___(\d+)---", lambda m: chr(int(m[1])), name.removeprefix("NUMBER_") if re.match(r"NUMBER_\d", name) else name)
