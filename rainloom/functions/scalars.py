"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values ----
#: cell texts that mean "missing" in the observation files
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
#: compass points clockwise from north, 22.5 degrees apart
COMPASS_POINTS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
]
# ---- end of fixed values ----


def blank_to_null(column: Column) -> Column:
    """Text cell with the missing-value tokens turned into NULL."""
    return F.when(~column.isin(MISSING_TOKENS), column)


def nan_to_null(column: Column) -> Column:
    """Floating-point column where NaN becomes NULL (NaN compares greater than any number)."""
    return F.when(~F.isnan(column), column)


#: a number as text files write it; the cast alone would also accept endings such as in ``1d``
_PLAIN_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+|inf|infinity)(?:e[+-]?\d+)?\s*$"


def to_double(column: Column, text: bool = True) -> Column:
    """Number from text (or, without ``text``, from any numeric type); the rest becomes NULL."""
    number = nan_to_null(column.try_cast("double"))
    return F.when(F.lower(column.cast("string")).rlike(_PLAIN_NUMBER), number) if text else number


def yes_no_flag(column: Column) -> Column:
    """Yes -> 1, No -> 0, anything else NULL."""
    return F.when(column == "Yes", 1).when(column == "No", 0)


def compass_degrees(column: Column) -> Column:
    """Degrees clockwise from north; unknown points give NULL."""
    step = 360.0 / len(COMPASS_POINTS)
    entries = [F.lit(v) for i, p in enumerate(COMPASS_POINTS) for v in (p, i * step)]
    return F.try_element_at(F.create_map(*entries), column)


def digest(*columns: Column | str, seed: int = 0) -> Column:
    """Hex digest of the key columns: a reproducible shuffle order that no engine detail changes.

    Keys should be integers, dates or strings; NULL reads as an empty text.
    """
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(""))
             for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def digest_fraction(digest_column: Column) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of a digest."""
    return F.conv(F.substring(digest_column, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
