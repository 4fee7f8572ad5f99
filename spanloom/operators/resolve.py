"""Conflicts among spans: cleaning, merging, ranking, islands, redundancy, splitting."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import join_overlapping, join_within

#: Which type wins when all else is equal.
RANK = {"Name": 0, "Age": 1, "Date": 2, "Contact": 3}
DEFAULT_CONFIDENCE = 50.0


def of_types(spans: DataFrame, types: list[str]) -> DataFrame:
    """Spans of these types alone; an empty list lets all through."""
    return spans.where(F.col("type").isin(*types)) if types else spans


def trim_spans(spans: DataFrame) -> DataFrame:
    """Spans without white space, or newlines spelt out, at their end; empty ones go."""
    cut = F.regexp_replace("text", r"(?:\s|\\n|\\r)+$", "")
    return spans.withColumn("end", F.col("start") + F.length(cut)).withColumn("text", cut).where("end > start")


def _weak(subtype: str | None) -> bool:
    return subtype in (None, "", "other")


def merged_features(later: dict[str, str], earlier: dict[str, str]) -> dict[str, str]:
    """Both spans' features; where they differ both values, the later span's first, and of several types ``other`` goes."""
    out = {}
    for key in sorted(later.keys() | earlier.keys()):
        values = list(dict.fromkeys(v for v in (later.get(key), earlier.get(key)) if v))
        if key == "type":
            values = list(dict.fromkeys(t for v in values for t in v.split(",")))
            values = [t for t in values if t != "other"] or values
        out[key] = ",".join(values)
    return out


def _fold(rows: Iterator[dict], apart: bool) -> Iterator[dict]:
    """The ordered fold over the spans of each group: one is held, and given out when one comes that neither merges with it nor lies in it."""
    held: dict | None = None
    for row in rows:
        if held is not None and held["_group"] == row["_group"]:
            agree = _weak(held["subtype"]) or _weak(row["subtype"]) or held["subtype"] == row["subtype"]
            if agree and (held["start"], held["end"]) == (row["start"], row["end"]):
                if _weak(held["subtype"]):
                    held["subtype"] = next((s for s in (row["subtype"], held["subtype"]) if not _weak(s)), held["subtype"] if held["subtype"] is not None else row["subtype"])
                if "features" in held:
                    held["features"] = list(merged_features(dict(held["features"] or ()), dict(row["features"] or ())).items())
                continue
            if (agree or not apart and (held["start"], held["end"]) != (row["start"], row["end"])) and row["end"] <= held["end"]:
                continue
        if held is not None:
            yield held
        held = row
    if held is not None:
        yield held


def merge_spans(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",), apart: bool = False) -> DataFrame:
    """One pass over a document's spans of a type, in order: contained ones go, coextensive ones merge.

    ``spans(keys, ann_id, start, end, type, subtype)``, perhaps ``features``, and
    other columns, which go along. Coextensive spans merge if their subtypes agree:
    they are equal, or one is missing or ``other``, which then gives way. Their
    features merge, the later id's values first. ``apart``: a span inside one
    of another subtype stays. Rows are sorted by document, type and
    place and read as a stream that holds one span, so a group of any size is
    neither collected nor copied.
    """
    group = F.to_json(F.struct(*keys, "type"))
    rows = spans.withColumn("_group", group).repartition("_group").sortWithinPartitions("_group", "start", F.desc("end"), F.desc("ann_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = None, []
        for row in _fold((r for batch in batches for r in _rows(batch)), apart):
            schema = row.pop("_schema")
            held.append(row)
            if len(held) == 4096:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return rows.mapInArrow(run, rows.schema).drop("_group")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for row in batch.to_pylist():
        yield row | {"_schema": batch.schema}


def remove_weaker(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Spans that lie in a stronger one go; all are judged on the input.

    Stronger is the higher confidence, then the longer span, then the type of
    lower rank, then the higher id. Addresses neither go nor make others go;
    partial overlaps stay.
    """
    rank = F.coalesce(*[F.when(F.col("type") == t, F.lit(k)) for t, k in RANK.items()], F.lit(99))
    power = F.struct(F.coalesce(F.col("confidence").try_cast("double"), F.lit(DEFAULT_CONFIDENCE)).alias("c"), (F.col("end") - F.col("start")).alias("l"), (-rank).alias("t"), F.col("ann_id").alias("i"))
    ranked = spans.withColumn("_power", power)
    c = ranked.where("type != 'Address'").select(*keys, "start", "end", F.col("_power").alias("power"), F.col("ann_id").alias("id"))
    beaten = (F.col("ann_id") != F.col("c_id")) & (F.col("c_power") > F.col("_power")) & (F.col("type") != "Address")
    return join_within(ranked, c, keys, "left_anti", beaten, prefix="c_").drop("_power")


def remove_redundant(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Spans inside a longer one go, and of coextensive ones all but the highest id.

    Sorted by start and falling end, a span is inside an earlier one exactly if
    some end before it reaches as far as its own: one window, no self-join.
    """
    w = Window.partitionBy(*keys).orderBy("start", F.desc("end"), F.desc("ann_id"))
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("_reach", reach).where("_reach is null or _reach < end").drop("_reach")


def islands(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",), gap: int = 0) -> DataFrame:
    """``(keys, start, end, n)``: the union of spans that touch, overlap or lie ``gap`` apart at most."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") > reach + gap).cast("int"), F.lit(1))
    numbered = spans.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("_island")


def same_coverage(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> bool:
    """Whether two sets of spans cover the same text."""
    x, y = islands(a, keys).drop("n"), islands(b, keys).drop("n")
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def overlapping(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, overlaps)``: whether any two spans of a document overlap."""
    w = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_reach", F.max("end").over(w)).groupBy(*keys).agg(F.coalesce(F.bool_or(F.col("_reach") > F.col("start")), F.lit(False)).alias("overlaps"))


def split_at_fields(spans: DataFrame, leaves: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each span's intersections with the leaf fields it overlaps."""
    pairs = join_overlapping(spans, leaves.select(*keys, "start", "end"), keys, prefix="f_")
    return pairs.withColumns({"start": F.greatest("start", "f_start"), "end": F.least("end", "f_end")}).select(*spans.columns)


def split_overlaps(spans: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Spans cut so that none overlap and the same text stays covered.

    In order of (start, falling end, id), a span keeps what no span before it has
    covered; one that is covered whole goes. A running maximum decides it.
    """
    w = Window.partitionBy(*keys).orderBy("start", F.desc("end"), "ann_id").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(w)
    return spans.withColumn("start", F.greatest("start", F.coalesce(reach, F.lit(0)))).where("end > start")


def leaf_spans(fields: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Fields that hold no other field; of coextensive ones the highest id."""
    held, holders = fields.select(*keys, "start", "end", "ann_id"), fields.select(*keys, "start", "end", "ann_id")
    same = (F.col("start") == F.col("o_start")) & (F.col("end") == F.col("o_end"))
    hold = (F.col("ann_id") != F.col("o_ann_id")) & (~same | (F.col("ann_id") > F.col("o_ann_id")))
    found = join_within(held, holders, keys, also=hold).select(*[F.col(f"o_{c}").alias(c) for c in (*keys, "ann_id")]).distinct()
    return fields.join(found, [*keys, "ann_id"], "left_anti")


#: The subtypes that each type may have.
SCHEMA = {
    "Address": ("patient", "other", "organisation", "medical staff"),
    "Contact": ("phone number", "fax", "email", "website", "other"),
    "Date": ("DOB", "DOD", "other"),
    "ID": ("patient ID", "case ID", "social security number", "insurance ID", "other"),
    "Location": ("organisation", "organisational unit", "street", "zip", "city", "region", "country", "geographical adjective", "room", "other"),
    "Name": ("patient", "doctor", "medical staff", "relative", "other"),
    "Age": (),
    "Occupation": (),
}


def enforce_schema(spans: DataFrame) -> DataFrame:
    """Spans of the known types; a subtype that its type doesn't have becomes null."""
    allowed = F.lit(False)
    for kind, subtypes in SCHEMA.items():
        if subtypes:
            allowed = allowed | ((F.col("type") == kind) & F.col("subtype").isin(*subtypes))
    return spans.where(F.col("type").isin(*SCHEMA)).withColumn("subtype", F.when(allowed, F.col("subtype")))
