"""Token rows for learning: labels, lookups and flags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.arrows import Words, expanded, in_stretches, list_of
from spanloom.functions.text import kind, orth
from spanloom.functions.text import tokens as tokens_of
from spanloom.operators.automaton import MOST_TOKENS
from spanloom.operators.intervals import join_within
from spanloom.operators.tokens import dealt, in_sentences, tasks_of, with_spans


def _joined(tokens: DataFrame, spans: DataFrame, value: str, name: str, keys: tuple[str, ...], sep: str) -> DataFrame:
    """``(keys, tok_idx, name)``: the values of the spans over each token, longest first."""
    found = join_within(tokens.select(*keys, "tok_idx", "start", "end"), spans.select(*keys, "start", "end", F.col(value).alias("v")), keys, prefix="s_")
    row = F.struct((F.col("s_start") - F.col("s_end")).alias("l"), F.col("s_v").alias("_v"))
    return found.groupBy(*keys, "tok_idx").agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["_v"])), sep).alias(name))


def token_features(tokens: DataFrame, annotations: DataFrame, hits: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``tokens`` with ``label`` (types, longest first, O if none) and ``lookup_tags`` (lexicon labels)."""
    labels = _joined(tokens, annotations, "type", "label", keys, ",")
    tags = _joined(tokens, hits.withColumn("_tag", F.concat_ws("_", "major", "minor")), "_tag", "lookup_tags", keys, ";")
    return tokens.join(labels, [*keys, "tok_idx"], "left").join(tags, [*keys, "tok_idx"], "left").withColumns({"label": F.coalesce("label", F.lit("O")), "lookup_tags": F.coalesce("lookup_tags", F.lit("O"))})


def _values(words: Words, spans: pa.Array, sep: str, nth: int = 2, none: str = "O") -> pa.Array:
    """For each token the values of the spans over it, longest first, each once; ``none`` if there are none. ``spans``: lists of ``(start, end, values)``, of which the ``nth`` field counts."""
    first, behind = words.within(spans)
    token, of = expanded(first, behind)
    flat = spans.flatten()
    known = sorted(v for v in pc.unique(flat.field(nth)).to_pylist() if v is not None)
    code = pc.fill_null(pc.index_in(flat.field(nth), value_set=pa.array(known, pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    length = (pc.subtract(flat.field(1), flat.field(0))).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((code[of], -length[of], token))
    token, code = token[order], code[of[order]]
    # texts by number: none, no value, one value, and what several make
    texts, number = [none, "", *known], np.zeros(len(words.row), dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate([np.ones(min(len(token), 1), dtype=bool), token[1:] != token[:-1]]))
    sizes = np.diff(np.concatenate([cuts, [len(token)]]))
    number[token[cuts]] = code[cuts] + 2
    made: dict[tuple[int, ...], int] = {}
    codes = code.tolist()
    for at, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        several = tuple(dict.fromkeys(codes[at : at + size]))
        if several not in made:
            made[several] = len(texts)
            texts.append(sep.join(known[c] for c in several if c >= 0))
        number[token[at]] = made[several]
    return pa.array(texts, pa.string()).take(pa.array(number))


def _innermost(words: Words, leaves: pa.Array) -> tuple[pa.Array, pa.Array]:
    """For each token the name and path of the innermost field over it; null if there is none. ``leaves``: lists of ``(start, end, depth, name, path)``."""
    token, of = expanded(*words.within(leaves))
    fields = [pc.take(leaves.flatten().field(k), pa.array(of)) for k in (2, 3, 4)]
    rows = list(zip(*[f.to_pylist() for f in fields], strict=True))
    known = sorted(set(rows), key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    code = {row: k for k, row in enumerate(known)}
    best = np.full(len(words.row), -1, dtype=np.int64)
    np.maximum.at(best, token, np.array([code[row] for row in rows], dtype=np.int64))
    chosen = pa.array(best, pa.int64(), mask=best < 0)
    return tuple(pa.array([row[k] for row in known], pa.string()).take(chosen) for k in (1, 2))


def text_features(docs: DataFrame, annotations: DataFrame, hits: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``token_features`` of the texts' tokens without blanks: texts meet their spans once, and tokens stay in the row."""
    labelled = with_spans(dealt(docs, text_col, keys), annotations, ("type",), "_labels", keys)
    placed = with_spans(labelled, hits.withColumn("_tag", F.concat_ws("_", "major", "minor")), ("_tag",), "_tags", keys)

    def few(strings: pa.Array, labels: pa.Array, tags: pa.Array) -> pa.Array:
        words = Words.of(strings)
        columns = {"tok_idx": pa.array(np.arange(len(words.row)) - words.first[words.row], pa.int32()), "start": pa.array(words.start, pa.int32()), "end": pa.array(words.end, pa.int32()), "string": words.values, "label": _values(words, labels, ","), "lookup_tags": _values(words, tags, ";")}
        return list_of(pa.StructArray.from_arrays(list(columns.values()), list(columns)), words.last - words.first)

    def run(strings: pa.Array, labels: pa.Array, tags: pa.Array) -> pa.Array:
        return pa.concat_arrays([few(part, labels.slice(at, len(part)), tags.slice(at, len(part))) for at, part in in_stretches(strings, MOST_TOKENS)])

    rows = F.arrow_udf(run, "array<struct<tok_idx:int,start:int,end:int,string:string,label:string,lookup_tags:string>>")
    found = placed.select(*keys, rows(tokens_of(text_col), "_labels", "_tags").alias("_rows")).select(*keys, F.explode_outer("_rows").alias("r")).where("r is not null")
    return found.select(*keys, "r.tok_idx", "r.start", "r.end", "r.string", kind("r.string").alias("kind"), orth("r.string").alias("orth"), F.length("r.string").alias("length"), "r.label", "r.lookup_tags")


def ml_table(docs: DataFrame, annotations: DataFrame, hits: DataFrame | None = None, gold: DataFrame | None = None, leaves: DataFrame | None = None) -> DataFrame:
    """A row for each token without blanks, with all that a learner of labels needs.

    ``docs(doc_id, text[, doc_type])``, ``annotations`` and ``gold(doc_id, start,
    end, type, subtype, rule)``, ``hits`` of a lexicon, ``leaves`` of the reports.
    The columns: doc_id, sentence_nr, token_nr (in its sentence), token_text,
    pos_tag (empty), token_kind, field_name, field_path, doc_type, label,
    label_extended (type and subtype), lookup_tags, sentence_beginning,
    triggered_rule, manual_label, manual_label_extended. Labels are O where there is
    none. Texts meet their spans once, and tokens stay in the row.
    """
    extended = lambda spans: spans.withColumn("_x", F.concat_ws("_", "type", F.when(F.col("subtype") != "", F.col("subtype"))))
    # tables of spans, and for each what its values are called and how several are parted
    parts = [(extended(annotations), {"type": "label", "_x": "label_extended", "rule": "triggered_rule"}, ",")]
    parts += [(extended(gold), {"type": "manual_label", "_x": "manual_label_extended"}, ",")] if gold is not None else []
    parts += [(hits.withColumn("_x", F.concat_ws("_", "major", "minor")), {"_x": "lookup_tags"}, ";")] if hits is not None else []
    kept = ["doc_id", "doc_type"] if "doc_type" in docs.columns else ["doc_id"]
    tasks = tasks_of(docs, "text")
    placed = docs.select(*kept, "text").repartition(tasks, "doc_id")
    for k, (spans, named, _) in enumerate(parts):
        placed = with_spans(placed, spans, tuple(named), f"_spans{k}", tasks=tasks)
    if leaves is not None:
        placed = with_spans(placed, leaves.select("doc_id", "start", "end", F.size("path").alias("depth"), "name", F.array_join("path", "/").alias("path")), ("depth", "name", "path"), "_leaves", tasks=tasks)
    values, in_fields = [(tuple(named.values()), sep) for _, named, sep in parts], leaves is not None
    names = ["sentence_nr", "token_nr", "string", *[name for of, _ in values for name in of], *(["field_name", "field_path"] if in_fields else [])]
    lists = [c for c in placed.columns if c.startswith("_")]

    def few(strings: pa.Array, lists: list[pa.Array]) -> tuple[np.ndarray, list[pa.Array]]:
        words, number, cuts = in_sentences(Words.of(strings, blanks=True))
        first = np.repeat(cuts, np.diff(np.concatenate([cuts, [len(number)]])) if len(cuts) else 0)
        columns = [pa.array(number, pa.int64()), pa.array(np.arange(len(number)) - first, pa.int32()), words.values]
        for (of, sep), spans in zip(values, lists, strict=False):
            columns += [_values(words, spans, sep, 2 + k, "" if name == "triggered_rule" else "O") for k, name in enumerate(of)]
        return words.row, [*columns, *(_innermost(words, lists[-1]) if in_fields else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows leave Python by stretches, so it holds no more than those of one beside a batch of texts
        for batch in batches:
            for at, strings in in_stretches(batch["_strings"], MOST_TOKENS):
                row, columns = few(strings, [batch[c].slice(at, len(strings)) for c in lists])
                yield pa.RecordBatch.from_arrays([batch[c].take(pa.array(row + at)) for c in kept] + columns, names=[*kept, *names])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, {"sentence_nr": T.LongType(), "token_nr": T.IntegerType()}.get(c, T.StringType())) for c in names])
    out = placed.select(*kept, tokens_of("text").alias("_strings"), *lists).mapInArrow(run, schema).withColumn("kind", kind("string"))
    missing = {"label": "O", "label_extended": "O", "triggered_rule": "", "manual_label": "O", "manual_label_extended": "O", "lookup_tags": "O", "field_name": "", "field_path": "", "doc_type": ""}
    out = out.withColumns({name: F.lit(value) for name, value in missing.items() if name not in out.columns})
    return out.select(
        "doc_id", "sentence_nr", "token_nr", F.col("string").alias("token_text"), F.lit("").alias("pos_tag"), F.col("kind").alias("token_kind"), F.coalesce("field_name", F.lit("")).alias("field_name"), F.coalesce("field_path", F.lit("")).alias("field_path"), "doc_type",
        "label", "label_extended", "lookup_tags", (F.col("token_nr") == 0).alias("sentence_beginning"), "triggered_rule", "manual_label", "manual_label_extended",
    )


def with_flags(features: DataFrame) -> DataFrame:
    """Boolean columns read off the token, its lookups and its label."""
    tag, label = F.col("lookup_tags"), F.col("label")
    return features.withColumns({
        "is_capitalized": F.col("string").rlike(r"^\p{Lu}"),
        "location_lookup": tag.contains("location"), "name_lookup": tag.contains("name"), "general_lookup": tag.contains("general"), "medical_lookup": tag.contains("medical"),
        "location_label": label.contains("Location"), "name_label": label.contains("Name"), "date_label": label.contains("Date"),
    })
