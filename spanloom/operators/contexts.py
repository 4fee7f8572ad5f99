"""Contexts around trigger words, and what a document's metadata says about its text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.arrows import Words
from spanloom.functions.text import kind, let, running
from spanloom.functions.text import tokens as tokens_of
from spanloom.operators.intervals import without_overlap
from spanloom.operators.automaton import MOST_BYTES, Automaton, found_in_rows, phrase_bytes, phrase_tokens
from spanloom.operators.tokens import dealt


def trigger_contexts(docs: DataFrame, triggers: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, start, end, context)``: from ``left`` + 1 tokens before a trigger to ``right`` + 1 after it.

    ``triggers(token, context, left, right)``, tokens without blanks; a trigger of
    several words is matched as a run of tokens. Contexts end at the borders of the
    text. All triggers are looked for in one pass within the row, no shuffle; a
    table of more than ``MOST_BYTES`` raises.
    """
    known = triggers.where("token is not null").select(phrase_tokens("token").alias("words"), "token", "context", "left", "right")
    if phrase_bytes(known, "token", "context") > MOST_BYTES:
        raise ValueError(f"more than {MOST_BYTES} bytes of triggers")
    rows = known.collect()
    shared = docs.sparkSession.sparkContext.broadcast((Automaton.of(r["words"] for r in rows), [(r["context"], r["left"], r["right"]) for r in rows]))

    def find(words: Words) -> tuple[np.ndarray, dict[str, pa.Array]]:
        automaton, around = shared.value
        hits = [(at, k, *around[entry]) for at, k, entry in automaton.hits(words)]
        at, behind, names, left, right = zip(*hits, strict=True) if hits else ((),) * 5
        at = np.array(at, dtype=np.int64)
        row = words.row[at]
        first = np.maximum(at - 1 - np.array(left, dtype=np.int64), words.first[row])
        last = np.minimum(np.array(behind, dtype=np.int64) + np.array(right, dtype=np.int64), words.last[row] - 1)
        return row, {"start": pa.array(words.start[first], pa.int32()), "end": pa.array(words.end[last], pa.int32()), "context": pa.array(names, pa.string())}

    return found_in_rows(docs, text_col, keys, find, "start:int,end:int,context:string")


def metadata_annotations(words: DataFrame, metadata: DataFrame, hits: DataFrame | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Tokens that equal a metadata value of their document, in capitals or capitalised.

    ``metadata(keys, type, value)``. Dashes, and tokens that a medical or
    false-positive hit overlaps, are passed over.
    """
    found = words.join(metadata_forms(metadata, keys), [*keys, "string"]).select(*keys, "start", "end", "string", "type")
    return not_passed_over(found, hits, keys)


def metadata_forms(metadata: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``(keys, type, string)``: what tokens may equal."""
    return metadata.select(*keys, "type", F.explode(F.array_distinct(F.array(F.upper("value"), F.initcap("value")))).alias("string")).where("string != '-'").distinct()


def not_passed_over(found: DataFrame, hits: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    if hits is None:
        return found
    return without_overlap(found, hits.where("major = 'medical' or minor = 'false_positives'").select(*keys, "start", "end"), keys)


def text_metadata_annotations(docs: DataFrame, metadata: DataFrame, hits: DataFrame | None = None, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``metadata_annotations`` for the texts themselves: a text meets its values once, and its tokens stay in the row.

    Only a text that holds a value somewhere is cut into tokens, and offsets are added
    up only where a token equals one.
    """
    forms = metadata_forms(metadata, keys).where(kind("string") != "space")
    known = forms.groupBy(*keys).agg(F.collect_list(F.struct("string", "type")).alias("_forms"), F.collect_set("string").alias("_values"))
    placed = dealt(docs, text_col, keys).join(known, list(keys))

    def found(strings: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(strings) - 1), lambda k: F.array_contains("_values", F.get(strings, k)))
        span = lambda sums, k, form: F.struct(F.get(sums, k).alias("start"), F.get(sums, k + 1).alias("end"), form["string"].alias("string"), form["type"].alias("type"))
        spans = lambda sums: F.flatten(F.transform(at, lambda k: F.transform(F.filter("_forms", lambda form: form["string"] == F.get(strings, k)), lambda form: span(sums, k, form))))
        return F.when(F.exists("_values", lambda value: F.array_contains(strings, value)), let(running(F.transform(strings, F.length)), spans))

    # explode alone would make Spark push a test of the array's size, and with it all that makes the array, below once more
    held = F.exists("_values", lambda value: F.contains(text_col, value))
    spans = placed.select(*keys, F.explode_outer(F.when(held, let(tokens_of(text_col), found))).alias("_t")).where("_t is not null")
    return not_passed_over(spans.select(*keys, "_t.*"), hits, keys)


def propagate(docs: DataFrame, annotations: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every occurrence of a sure annotation's text in its document gets its type.

    Sure are structured annotations and those above a confidence of 80, if their
    text has a space; each text counts once a document. Places are those where the
    text is cut by it, so they don't overlap and the work is one pass.
    """
    sure = annotations.where("text like '% %' and (rule like 'FieldMapping%' or coalesce(try_cast(confidence as double), 50) > 80)")
    texts = sure.groupBy(*keys, "text").agg(F.min_by(F.struct("type", "rule"), F.col("start")).alias("a"))
    both = docs.select(*keys, F.col(text_col).alias("_whole")).join(texts, list(keys))
    quoted = F.concat(F.lit(r"\Q"), F.replace("text", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    before = F.transform(F.split("_whole", quoted, -1), lambda part: F.length(part) + F.length("text"))
    places = F.transform(let(running(before), lambda ends: F.slice(ends, 2, F.size(ends) - 2)), lambda end: end - F.length("text") + 1)
    return both.select(*keys, "text", "a", F.explode(places).alias("at")).select(*keys, (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.length("text")).alias("end"), "a.type", F.concat(F.lit("HighConfidence-"), "a.rule").alias("rule"), "text")
