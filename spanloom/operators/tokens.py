"""Token, sentence and token-window tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.arrows import Words, expanded, in_stretches, list_of
from spanloom.functions.text import kind, orth, with_tokens
from spanloom.functions.text import tokens as tokens_of
from spanloom.operators.intervals import join_overlapping, join_within


def token_table(docs: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, tok_idx, start, end, string, kind, orth, length)``: every token, spaces included.

    Offsets are worked out within the row, so there is no shuffle, and rows that
    repeat an id, or have none, each have their own. A null text has no token.
    """
    placed = with_tokens(docs.select(*dict.fromkeys([*keys, text_col])), text_col, "_tokens")
    # posexplode alone would make Spark push a test of the array's size, and with it all that makes the array, below the UDF once more
    words = placed.select(*keys, F.posexplode_outer("_tokens").alias("tok_idx", "_t")).where("tok_idx is not null").select(*keys, "tok_idx", "_t.*")
    return words.select(*keys, "tok_idx", (F.col("end") - F.length("string")).alias("start"), "end", "string", kind("string").alias("kind"), orth("string").alias("orth"), F.length("string").alias("length"))


def work_tokens(table: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Tokens without blanks, numbered anew: what rules see."""
    number = (F.row_number().over(Window.partitionBy(*keys).orderBy("tok_idx")) - 1).cast("int")
    return table.where("kind != 'space'").withColumn("tok_idx", number)


#: Words behind which a full stop doesn't end a sentence.
ABBREVIATIONS = ("bzw", "ca", "Dr", "Prof", "St", "Nr", "Tel", "vgl")


def ends_sentence(token: Column, last: Column, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> Column:
    """Whether a sentence ends with ``token``, of which ``last`` is the one before (null: none)."""
    return token.isin("!", "?") | ((token == ".") & ~F.coalesce(last.isin(*abbreviations) | last.rlike(r"^(\p{L}|\p{N}+)$"), F.lit(False))) | token.contains("\n")


def with_sentence_nr(table: DataFrame, keys: tuple[str, ...] = ("doc_id",), abbreviations: tuple[str, ...] = ABBREVIATIONS) -> DataFrame:
    """``table`` with ``sentence_nr``: cut after ``.``, ``!``, ``?`` and at newlines.

    A full stop behind an abbreviation, a single letter or a number doesn't end one.
    """
    w = Window.partitionBy(*keys).orderBy("tok_idx")
    stops = ends_sentence(F.col("string"), F.lag("string").over(w), abbreviations)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn("_stop", stops).withColumn("sentence_nr", F.coalesce(F.sum(F.col("_stop").cast("int")).over(before), F.lit(0))).drop("_stop")


def sentences(table: DataFrame, keys: tuple[str, ...] = ("doc_id",), abbreviations: tuple[str, ...] = ABBREVIATIONS) -> DataFrame:
    """``(keys, sentence_nr, start, end, token_count)`` of the sentences that hold more than blanks."""
    seen = with_sentence_nr(table, keys, abbreviations).where("kind not in ('space', 'newline')")
    return seen.groupBy(*keys, "sentence_nr").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("token_count"))


def sentence_numbers(words: Words, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> np.ndarray:
    """As ``with_sentence_nr`` for the tokens of a batch, blanks included: the number of each one's sentence in its text."""
    values, alone = words.values, np.zeros(len(words.row), dtype=bool)
    dots = np.flatnonzero(pc.equal(values, ".").to_numpy(zero_copy_only=False))
    dots = dots[dots > words.first[words.row[dots]]]
    last = values.take(pa.array(dots - 1))
    alone[dots] = pc.or_(pc.is_in(last, value_set=pa.array(abbreviations, pa.string())), pc.match_substring_regex(last, r"^(\p{L}|\p{N}+)$")).to_numpy(zero_copy_only=False)
    ends = pc.or_(pc.is_in(values, value_set=pa.array(["!", "?", "."])), pc.match_substring(values, "\n")).to_numpy(zero_copy_only=False) & ~alone
    before = np.concatenate([[0], np.cumsum(ends)])
    return before[:-1] - before[words.first[words.row]]


def in_sentences(words: Words, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> tuple[Words, np.ndarray, np.ndarray]:
    """The tokens that are neither blank nor newline, the number of each one's sentence, and the places where sentences begin among them."""
    kept = np.flatnonzero(~pc.ascii_is_space(words.values).to_numpy(zero_copy_only=False).astype(bool))
    work, number = words.at(kept), sentence_numbers(words, abbreviations)[kept]
    begins = (work.row[1:] != work.row[:-1]) | (number[1:] != number[:-1])
    return work, number, np.flatnonzero(np.concatenate([np.ones(min(len(kept), 1), dtype=bool), begins]))


def text_sentences(docs: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",), abbreviations: tuple[str, ...] = ABBREVIATIONS) -> DataFrame:
    """As ``sentences`` for the texts themselves: tokens stay in the row, so there is no shuffle, and rows that repeat an id each have their own."""

    def few(strings: pa.Array) -> pa.Array:
        words = Words.of(strings, blanks=True)
        work, number, cuts = in_sentences(words, abbreviations)
        behind = np.concatenate([cuts[1:], [len(work.row)]])[: len(cuts)]
        columns = {"sentence_nr": pa.array(number[cuts], pa.int64()), "start": pa.array(work.start[cuts], pa.int32()), "end": pa.array(work.end[behind - 1], pa.int32()), "token_count": pa.array(behind - cuts, pa.int64())}
        return list_of(pa.StructArray.from_arrays(list(columns.values()), list(columns)), np.bincount(work.row[cuts], minlength=len(strings)))

    runs = F.arrow_udf(lambda strings: pa.concat_arrays([few(part) for _, part in in_stretches(strings, MOST_PLACED)]), "array<struct<sentence_nr:bigint,start:int,end:int,token_count:bigint>>")
    found = docs.select(*dict.fromkeys([*keys, text_col])).select(*keys, runs(tokens_of(text_col)).alias("_runs"))
    return found.select(*keys, F.explode_outer("_runs").alias("r")).where("r is not null").select(*keys, "r.*")


def adjust_sentences(found: DataFrame, leaves: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Sentences cut at the borders of the leaf fields that they overlap."""
    pairs = join_overlapping(found.select(*keys, "start", "end"), leaves.select(*keys, "start", "end"), keys, prefix="f_")
    return pairs.select(*keys, F.greatest("start", "f_start").alias("start"), F.least("end", "f_end").alias("end"))


def field_sentences(table: DataFrame, leaves: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(keys, sentence_nr, field_id, start, end, token_count, work_token_count)``: sentences cut at fields, with their tokens counted, blanks and without.

    ``table`` has a ``sentence_nr``, so newlines cut too. Tokens outside of fields are
    a sentence of their own, whose ``field_id`` is null; what holds only blanks is none.
    """
    placed = join_within(table, leaves.select(*keys, "field_id", "start", "end"), keys, "left", prefix="f_")
    work = ~F.col("kind").isin("space", "newline")
    found = placed.groupBy(*keys, "sentence_nr", F.col("f_field_id").alias("field_id")).agg(F.min(F.when(work, F.col("start"))).alias("start"), F.max(F.when(work, F.col("end"))).alias("end"), F.count(F.lit(1)).alias("token_count"), F.count_if(work).alias("work_token_count"))
    return found.where("work_token_count > 0")


#: Bytes of text that a task works on at a time.
TEXT_BYTES = 32 << 20


def tasks_of(docs: DataFrame, text_col: str) -> int:
    """How many tasks texts are dealt to, of some TEXT_BYTES each."""
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // TEXT_BYTES))


def dealt(docs: DataFrame, text_col: str, keys: tuple[str, ...]) -> DataFrame:
    """Texts dealt by their keys to tasks of some TEXT_BYTES: a shuffle's own size says little of the work that its texts make."""
    rows = docs.select(*dict.fromkeys([*keys, text_col]))
    return rows.repartition(tasks_of(rows, text_col), *keys)


def with_spans(docs: DataFrame, spans: DataFrame, columns: tuple[str, ...], out: str, keys: tuple[str, ...] = ("doc_id",), tasks: int | None = None) -> DataFrame:
    """``docs`` with the spans of each as an array of ``(start, end, columns)`` in ``out``: a document meets its spans once.

    ``tasks``: what ``docs`` are dealt to by their keys; spans go to as many, or the
    join would deal both to the session's number.
    """
    spans = spans if tasks is None else spans.repartition(tasks, *keys)
    rows = spans.groupBy(*keys).agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), *columns)).alias(out))
    return docs.join(rows, list(keys), "left")


#: Tokens that are placed in fields at once.
MOST_PLACED = 1 << 17


def text_field_sentences(docs: DataFrame, leaves: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",), abbreviations: tuple[str, ...] = ABBREVIATIONS) -> DataFrame:
    """As ``field_sentences`` for the texts themselves: texts meet their fields once, and tokens stay in the row.

    Rows that repeat an id each have their own sentences; those of one number and
    field count together.
    """
    field = leaves.schema["field_id"].dataType.simpleString()
    placed = with_spans(dealt(docs, text_col, keys), leaves, ("field_id",), "_leaves", keys).withColumn("_strings", tokens_of(text_col))

    def few(strings: pa.Array, stops: pa.Array, fields: pa.Array) -> pa.Array:
        words = Words.of(strings, blanks=True)
        stop = stops.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(stop)])
        number = before[:-1] - before[words.first[words.row]]
        work = ~pc.ascii_is_space(words.values).to_numpy(zero_copy_only=False).astype(bool)
        first, behind = words.within(fields)
        token, of = expanded(first, behind)
        lone = np.ones(len(work), dtype=bool)
        lone[token] = False
        token, of = np.concatenate([token, np.flatnonzero(lone)]), np.concatenate([of, np.full(lone.sum(), -1)])
        marks = np.stack([words.row[token], of, number[token]])
        cuts = np.flatnonzero(np.concatenate([np.ones(min(len(token), 1), dtype=bool), (marks[:, 1:] != marks[:, :-1]).any(axis=0)]))
        if not len(cuts):
            return list_of(pa.array([], pa.struct([("sentence_nr", pa.int64()), ("field_id", fields.type.value_type.field(2).type), *((k, pa.int32()) for k in ("start", "end", "n", "m"))])), np.zeros(len(strings), np.int64))
        most = np.int64(1) << 40
        start = np.minimum.reduceat(np.where(work, words.start, most)[token], cuts)
        end = np.maximum.reduceat(np.where(work, words.end, -1)[token], cuts)
        n, m = np.diff(np.concatenate([cuts, [len(token)]])), np.add.reduceat(work[token].astype(np.int64), cuts)
        order = np.argsort(marks[0, cuts], kind="stable")
        leaf, none = of[cuts][order], m[order] == 0
        columns = {"sentence_nr": pa.array(number[token][cuts][order]), "field_id": fields.flatten().field(2).take(pa.array(leaf, pa.int64(), mask=leaf < 0))}
        columns |= {"start": pa.array(start[order], mask=none).cast("int32"), "end": pa.array(end[order], mask=none).cast("int32"), "n": pa.array(n[order].astype("i4")), "m": pa.array(m[order].astype("i4"))}
        return list_of(pa.StructArray.from_arrays(list(columns.values()), list(columns)), np.bincount(marks[0, cuts], minlength=len(strings)))

    def run(strings: pa.Array, stops: pa.Array, fields: pa.Array) -> pa.Array:
        return pa.concat_arrays([few(part, stops.slice(at, len(part)), fields.slice(at, len(part))) for at, part in in_stretches(strings, MOST_PLACED)])

    stops = F.transform("_strings", lambda s, k: F.coalesce(ends_sentence(s, F.when(k > 0, F.get("_strings", k - 1)), abbreviations), F.lit(False)))
    runs = F.arrow_udf(run, f"array<struct<sentence_nr:bigint,field_id:{field},start:int,end:int,n:int,m:int>>")
    found = placed.select(*keys, runs("_strings", stops, "_leaves").alias("_runs")).select(*keys, F.explode_outer("_runs").alias("r")).where("r is not null").select(*keys, "r.*")
    whole = found.groupBy(*keys, "sentence_nr", "field_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("token_count"), F.sum("m").alias("work_token_count"))
    return whole.where("work_token_count > 0")


def window_flag(table: DataFrame, flag: str, size: int, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``near_<flag>``: whether a token within ``size`` tokens has the flag."""
    return table.withColumn(f"near_{flag}", F.max(F.col(flag)).over(Window.partitionBy(*keys).orderBy("tok_idx").rowsBetween(-size, size)))
