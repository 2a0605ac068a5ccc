"""Column expressions shared by the pipelines. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"

# Meteorological season of each month.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}


def blank_to_null(column: Column) -> Column:
    """Trim spaces; an empty text is a missing value."""
    return F.nullif(F.trim(column), F.lit(""))


def money(column: Column) -> Column:
    """Round half away from zero to cents and fix the type."""
    return F.round(column, 2).cast(MONEY)


def date_key(column: Column) -> Column:
    """A date as the number yyyymmdd, by arithmetic rather than text formatting."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("bigint")


def week_start(column: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(column, "week")


def month_start(column: Column) -> Column:
    return F.trunc(column, "month")


def month_diff(later: Column, earlier: Column) -> Column:
    """Number of month boundaries between two dates."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def season(column: Column) -> Column:
    month = F.month(column)
    result = None
    for name, months in SEASON_MONTHS.items():
        test = month.isin(*months)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def strip(column: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def title_case(column: Column) -> Column:
    """Capital after every non-letter, the rest in lower case.

    ``initcap`` treats white space as the only separator and is the fast path; texts with other
    separators (hyphens, apostrophes) are cut before each letter that follows a non-letter.
    """
    pieces = F.split(F.lower(column), r"(?<=\P{L})(?=\p{L})")
    by_letter = F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))),
        "",
    )
    return F.when(column.rlike(r"[^\p{L}\s]"), by_letter).otherwise(F.initcap(column))


def number_or_null(column: Column) -> Column:
    """Text to double; NULL for anything that is not a plain decimal number."""
    plain = column.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    return F.when(plain, column.try_cast("double"))


def timestamp_or_null(column: Column) -> Column:
    return F.trim(column).try_cast("timestamp_ntz")


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Literal map for a small fixed vocabulary; NULL for unknown keys."""
    pairs = [F.lit(text) for item in mapping.items() for text in item]
    return F.create_map(*pairs)[key]
