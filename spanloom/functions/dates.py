"""Dates out of text: parts, formats, and what to do with missing ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions.text import let
from spanloom.rulesets.patterns import MONTHS_DE, MONTHS_EN, MONTHS_SHORT

# Formats that a date's text is tried with.
FORMATS = ("dd.MM.yyyy", "d.M.yyyy", "dd.MM.yy", "d.M.yy", "dd/MM/yyyy", "dd/MM/yy", "yyyy-MM-dd", "MM/yyyy", "M/yyyy", "MM.yyyy", "MM/yy", "M/yy", "dd.MM.", "d.M.", "dd.MM", "yyyy")


def month_number(name: Column) -> Column:
    """1 to 12 for a German or English month name, long or short, in any case; null for anything else."""
    plain = F.lower(F.rtrim(F.regexp_replace(name, r"\.$", "")))
    pairs = {n.lower(): k for names in (MONTHS_DE, MONTHS_EN) for k, n in enumerate(names, 1)}
    pairs |= {n.lower(): pairs[next(m for m in map(str.lower, MONTHS_DE) if m.startswith(n.lower()[:3]))] for n in MONTHS_SHORT}
    table = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(table, plain)


def month_format(month: Column) -> Column:
    """MMMM for a long name, MMM for a short one, MM for a number."""
    longs = [m.lower() for m in MONTHS_DE + MONTHS_EN]
    return F.when(month.rlike(r"^[0-9]{1,2}$"), "MM").when(F.lower(month).isin(longs), "MMMM").when(month_number(month).isNotNull(), "MMM")


def year_format(year: Column) -> Column:
    return F.when(F.length(year) == 2, "yy").when(F.length(year) == 4, "yyyy")


def full_year(year: Column) -> Column:
    """A two-digit year below 50 is in this century, others in the last one."""
    n = year.try_cast("int")
    return F.when(F.length(year) > 2, n).when(n < 50, 2000 + n).otherwise(1900 + n)


def is_slash_date(month: Column, year: Column) -> Column:
    """``m/yy`` is a date, not a score: a leading zero, a two-digit month, or a month above the year."""
    return month.startswith("0") | year.startswith("0") | (F.length(month) == 2) | F.coalesce(month.try_cast("int") > year.try_cast("int"), F.lit(False))


def best_format(text: Column) -> Column:
    """The longest of FORMATS that reads the text and writes it again unchanged; null if none does."""
    ordered = sorted(FORMATS, key=lambda f: (-len(f), FORMATS.index(f)))
    return F.coalesce(*[F.when(F.date_format(F.try_to_timestamp(text, F.lit(f)), f) == text, F.lit(f)) for f in ordered])


def date_parts(text: Column) -> Column:
    """``struct<day, month, year, format>`` of a date's text, as strings; leading zeros go, two-digit years grow.

    The format is put together from the parts in order and what separates them.
    """
    num = r"^([0-9]{1,2})\s*([./])\s*([0-9]{1,2})\s*([./])\s*([0-9]{2,4})$"
    iso = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$"
    short = r"^([0-9]{1,2})\.([0-9]{1,2})(\.?)$"
    my = r"^([0-9]{1,2})\s*([./])\s*([0-9]{2,4})$"
    named = r"^([0-9]{1,2})(\.\s*)(\p{L}+\.?)(\s*)([0-9]{2,4})?$"
    named_my = r"^(\p{L}+\.?)(\s*/?\s*)([0-9]{2,4})?$"
    english = r"^(\p{L}+)(\s+)([0-9]{1,2})(,?\s*)([0-9]{4})$"
    g = lambda p, k: F.regexp_extract(text, p, k)
    strip = lambda c: F.regexp_replace(c, r"^0(?=[0-9])", "")
    year = lambda c: F.when(c != "", full_year(c).cast("string"))
    none = F.lit(None).cast("string")

    def out(day: Column, month: Column, y: Column, fmt: Column) -> Column:
        return F.struct(day.alias("day"), month.alias("month"), y.alias("year"), fmt.alias("format"))

    mark = lambda c: F.rtrim(c, F.lit(".")).alias("m")
    year_only, day_only = r"^[0-9]{4}$", r"^([0-9]{1,2})(\.)$"
    return (
        F.when(text.rlike(num), out(strip(g(num, 1)), strip(g(num, 3)), year(g(num, 5)), F.concat(F.lit("dd"), g(num, 2), F.lit("MM"), g(num, 4), year_format(g(num, 5)))))
        .when(text.rlike(iso), out(strip(g(iso, 3)), strip(g(iso, 2)), g(iso, 1), F.lit("yyyy-MM-dd")))
        .when(text.rlike(short) & (F.length(g(short, 2)) <= 2) & (g(short, 2).try_cast("int") <= 12), out(strip(g(short, 1)), strip(g(short, 2)), none, F.concat(F.lit("dd.MM"), g(short, 3))))
        .when(text.rlike(my), out(none, strip(g(my, 1)), year(g(my, 3)), F.concat(F.lit("MM"), g(my, 2), year_format(g(my, 3)))))
        .when(text.rlike(named), out(strip(g(named, 1)), mark(g(named, 3)), year(g(named, 5)), F.rtrim(F.concat(F.lit("dd"), g(named, 2), month_format(g(named, 3)), F.when(g(named, 3).endswith("."), ".").otherwise(""), g(named, 4), F.coalesce(year_format(g(named, 5)), F.lit(""))))))
        .when(text.rlike(english), out(strip(g(english, 3)), g(english, 1), g(english, 5), F.concat(month_format(g(english, 1)), g(english, 2), F.lit("dd"), g(english, 4), F.lit("yyyy"))))
        .when(text.rlike(named_my), out(none, mark(g(named_my, 1)), year(g(named_my, 3)), F.rtrim(F.concat(month_format(g(named_my, 1)), F.when(g(named_my, 1).endswith("."), ".").otherwise(""), g(named_my, 2), F.coalesce(year_format(g(named_my, 3)), F.lit(""))))))
        .when(text.rlike(year_only), out(none, none, text, F.lit("yyyy")))
        .when(text.rlike(day_only), out(strip(g(day_only, 1)), none, none, F.lit("dd.")))
    )


def date_features(text: Column, other: Column) -> Column:
    """``struct<day, month, year, format>`` of a date that may be one end of a range, ``other`` being the far end.

    A number alone is a month beside a month and year, and a year beside a year;
    a month or year that a date lacks is that of the far end.
    """
    bare, plain = text.rlike(r"^[0-9]{1,2}$"), F.regexp_replace(text, r"^0(?=[0-9])", "")
    none = F.lit(None).cast("string")
    month = F.struct(none.alias("day"), plain.alias("month"), none.alias("year"), F.lit("MM").alias("format"))
    year = F.struct(none.alias("day"), none.alias("month"), full_year(text).cast("string").alias("year"), year_format(text).alias("format"))
    own = F.when(bare & other.rlike(r"^[0-9]{1,2}\s*[./]\s*[0-9]{2,4}$"), month).when(bare & other.rlike("^[0-9]{4}$"), year).otherwise(date_parts(text))

    def joined(both: Column) -> Column:
        near, far = both["near"], both["far"]
        filled = lambda name: F.coalesce(near[name], F.when(near["format"].isNotNull(), far[name])).alias(name)
        return F.struct(near["day"].alias("day"), filled("month"), filled("year"), near["format"].alias("format"))

    return let(F.struct(own.alias("near"), F.when(other.isNotNull(), date_parts(other)).alias("far")), joined)


def as_date(parts: Column, default_year: Column) -> Column:
    """A date of the parts; a missing year is the given one, a missing month or day the first."""
    month = F.coalesce(parts["month"].try_cast("int"), month_number(parts["month"]), F.when(parts["month"].isNull(), F.lit(1)))
    year, day = F.coalesce(parts["year"].try_cast("int"), default_year), F.coalesce(parts["day"].try_cast("int"), F.when(parts["day"].isNull(), F.lit(1)))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def format_date(date: Column, fmt: Column) -> Column:
    """``date`` in a format that may differ by row; month names are German."""
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS_DE]), F.month(date))
    short = F.element_at(F.array(*[F.lit(m[:3]) for m in MONTHS_DE]), F.month(date))
    out = F.replace(fmt, F.lit("yyyy"), F.date_format(date, "yyyy"))
    out = F.replace(out, F.lit("yy"), F.date_format(date, "yy"))
    out = F.replace(out, F.lit("dd"), F.date_format(date, "dd"))
    # names last: they would otherwise be read as parts of a format
    return F.when(F.contains(out, F.lit("MMMM")), F.replace(out, F.lit("MMMM"), name)).when(F.contains(out, F.lit("MMM")), F.replace(out, F.lit("MMM"), short)).otherwise(F.replace(out, F.lit("MM"), F.date_format(date, "MM")))
