"""Parts and formats of person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_parts(text: Column) -> Column:
    """``struct<salutation, firstname, lastname, format>`` of a name's text.

    In the format, f is an initial, ff a first name, ll a last name; upper-case
    letters stand for a part in capitals.
    """
    plain = r"^(?:(Herrn?|Frau|Hr\.?|Fr\.?)\s+)?(?:Dr\.?(?:\s*med\.?)?\s+|Prof\.?\s+|PD\s+)*((?:\p{Lu}\p{Ll}?\.\s*)+)?(\p{L}[\p{L}-]*)?(?:\s+(\p{L}[\p{L}-]*))?$"
    g = lambda k: F.regexp_extract(text, plain, k)
    two = g(4) != ""
    first = F.when(g(2) != "", F.trim(g(2))).when(two, g(3))
    last = F.when(two, g(4)).when(g(3) != "", g(3))
    caps = lambda c, f: F.when(c.rlike(r"^[\p{Lu}-]{2,}$"), F.upper(F.lit(f))).otherwise(F.lit(f))
    fmt = F.concat_ws(" ", F.when(g(2) != "", F.lit("f.")).when(two, caps(g(3), "ff")), F.when(last.isNotNull(), caps(last, "ll")))
    return F.struct(F.when(g(1) != "", g(1)).alias("salutation"), first.alias("firstname"), last.alias("lastname"), fmt.alias("format"))


def clean_formats(formats: Column, value: Column) -> Column:
    """A list of formats without repeats and without those that another contains; upper-case if the value is."""
    cased = F.transform(formats, lambda f: F.when(value.rlike(r"^[^\p{Ll}]+$"), F.upper(f)).otherwise(f))
    once = F.array_distinct(cased)
    return F.filter(once, lambda f: ~F.exists(once, lambda g: (g != f) & F.contains(g, f)))
