"""Tokens and pattern matches with exact offsets, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.arrows import running_sums

#: Words, numbers, newlines, other white space and single marks: together they cover any text.
TOKEN = r"\p{L}+|\p{N}+|\r?\n|[ \t\f\r]+|[^\p{L}\p{N}\s]|\s"

MATCH = "array<struct<start:int,end:int,text:string>>"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses more than once and that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Folds that append copy what they have so far, so they go by blocks of this many items: then none gets long.
BLOCK = 64


def in_blocks(items: Column) -> Column:
    """An array as an array of arrays of up to BLOCK items."""
    firsts = lambda x: F.sequence(F.lit(0), F.greatest(F.ceil(F.size(x) / BLOCK).cast("int") - 1, F.lit(0)))
    return let(items, lambda x: F.when(F.size(x) <= BLOCK, F.array(x)).otherwise(F.transform(firsts(x), lambda b: F.slice(x, b * BLOCK + 1, F.lit(BLOCK)))))


def _sums(lengths: Column, start: Column) -> Column:
    return F.aggregate(lengths, F.array(start), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))


def running(lengths: Column) -> Column:
    """The sums of an array of lengths before each place (from 0 on), and of all at the end."""

    def of(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, n: acc + n))
        inner = lambda b, at: F.when(b.isNotNull(), F.slice(_sums(b, at), 1, F.size(b))).otherwise(F.array(at))
        return F.flatten(F.zip_with(blocks, _sums(totals, F.lit(0)), inner))

    return let(in_blocks(lengths), of)


def tokens(text: Column | str) -> Column:
    """All tokens of a text in order; their texts joined give the text again."""
    return F.regexp_extract_all(_column(text), F.lit(TOKEN), F.lit(0))


def with_tokens(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with the tokens of a text as structs ``(string, end)``: what each is and where it ends.

    Three projections of the row: the tokens, the running sums of their lengths
    (arrays have any length, so all of an Arrow batch at once), and both side by side.
    """
    ends = F.arrow_udf(running_sums, "array<int>")
    found = docs.withColumn("_strings", tokens(text_col))
    placed = found.withColumn("_ends", ends(F.transform("_strings", F.length)))
    return placed.withColumn(out, F.arrays_zip(F.col("_strings").alias("string"), F.col("_ends").alias("end"))).drop("_strings", "_ends")


def kind(token: Column | str) -> Column:
    """word, number, newline, space or punctuation."""
    t = _column(token)
    first = F.substring(t, 1, 1)
    common = F.when(first.between("a", "z") | first.between("A", "Z"), "word").when(first == " ", "space").when(first.between("0", "9"), "number").when(first.isin(".", ","), "punctuation")
    return common.when(t.rlike(r"^\p{L}"), "word").when(t.rlike(r"^\p{N}"), "number").when(t.rlike(r"\n"), "newline").when(t.rlike(r"^\s"), "space").otherwise("punctuation")


def orth(token: Column | str) -> Column:
    """How a word is written: upperInitial, allCaps, lowercase or mixedCaps; null for other tokens."""
    t = _column(token)
    return F.when(t.rlike(r"^\p{Lu}\p{Ll}*$") & ((F.length(t) > 1) | t.rlike(r"^\p{Lu}$")), F.when(F.length(t) == 1, "allCaps").otherwise("upperInitial")).when(t.rlike(r"^\p{Lu}+$"), "allCaps").when(t.rlike(r"^\p{Ll}+$"), "lowercase").when(t.rlike(r"^\p{L}+$"), "mixedCaps")


def match_groups(text: Column, pattern: str, groups: int, whole: Column | None = None) -> Column:
    """Every match of ``pattern`` as a struct: ``start`` and the texts ``g0`` (whole) to ``g<groups>``.

    A text is what lies between the matches and the matches in turn, so the
    offsets are running sums of lengths. The pattern must not match nothing.
    ``whole`` is a column that already holds the matches, if there is one.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) if whole is None else whole
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in range(1, groups + 1)]
    before = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), F.concat(F.array(F.lit("")), whole), lambda b, m: F.length(F.coalesce(b, F.lit(""))) + F.length(F.coalesce(m, F.lit(""))))
    starts = F.slice(running(before), 2, F.size(whole))
    zipped = F.arrays_zip(starts.alias("start"), *[c.alias(f"g{k}") for k, c in enumerate([whole, *parts])])
    return F.filter(zipped, lambda m: m["g0"].isNotNull() & m["start"].isNotNull())


def matches(text: Column | str, pattern: str) -> Column:
    """Every match of ``pattern`` with its half-open place, in characters."""
    return F.transform(match_groups(_column(text), pattern, 0), lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["g0"])).alias("end"), m["g0"].alias("text")))


def context(text: Column | str, start: Column, end: Column, width: int) -> tuple[Column, Column]:
    """The ``width`` characters before and after a span."""
    t = _column(text)
    low = F.greatest(start - width, F.lit(0))
    return F.substring(t, low + 1, start - low), F.substring(t, end + 1, F.lit(width))


def xml_escape(text: Column | str) -> Column:
    t = F.replace(_column(text), F.lit("&"), F.lit("&amp;"))
    t = F.replace(F.replace(t, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.replace(F.replace(t, F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&apos;"))
