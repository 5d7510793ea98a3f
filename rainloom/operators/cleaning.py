"""Schema checks, target cleaning, date parsing and column selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rainloom.functions.scalars import blank_to_null, nan_to_null, to_double, yes_no_flag
from rainloom.schema import (
    DATE, LOOKUP_FEATURES, NUMERIC_COLUMNS, OBSERVATION_COLUMNS, RAIN_TODAY, RAW_TO_OBSERVATION,
    TARGET, TECHNICAL_COLUMNS,
)


def validate_schema(df: DataFrame, required_columns: Sequence[str] | None = None) -> None:
    """Raise ``ValueError`` naming the required columns that are absent. Runs no job."""
    required = OBSERVATION_COLUMNS if required_columns is None else required_columns
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")


def clean_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Drop rows without a target and code No/Yes as 0/1.

    Any other text fails the job that first reads such a row. The check is part of the
    projection, so it costs no extra pass over the table.
    """
    text = F.col(target)
    problem = F.concat(F.lit(f"unexpected value in {target}: "), text)
    # NULL in, NULL out: later filters on the label may be evaluated before the one below
    coded = F.when(text.isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(yes_no_flag(text), F.raise_error(problem).cast("int")))
    return df.where(text.isNotNull()).withColumn(target, coded)


def encode_rain_today(df: DataFrame, column: str = RAIN_TODAY) -> DataFrame:
    """Yes/No to 1/0; everything else becomes NULL."""
    return df.withColumn(column, yes_no_flag(F.col(column)).cast("double"))


#: a padded ISO date, alone or with a time of day and an offset
_ISO_DATE = r"^\s*(\d{4}-\d{2}-\d{2})(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
_UNPADDED_DATE = _ISO_DATE.replace("-\\d{2}-\\d{2})", "-\\d{1,2}-\\d{1,2})")


def parse_date_column(
    df: DataFrame, date_col: str = DATE, pattern: str | None = None, unpadded: bool = False,
) -> DataFrame:
    """Turn text into a date and drop the rows where that fails."""
    return coerce_date_column(df, date_col, pattern, unpadded).where(F.col(date_col).isNotNull())


def coerce_date_column(
    df: DataFrame, date_col: str = DATE, pattern: str | None = None, unpadded: bool = False,
) -> DataFrame:
    """Turn text into a date; what cannot be read becomes NULL and the row stays.

    Without a ``pattern`` ISO dates are read, alone or followed by a time of day, which is dropped
    as written. ``unpadded`` also reads months and days of one digit.
    """
    kind = df.schema[date_col].dataType
    if isinstance(kind, T.DateType):
        return df
    if isinstance(kind, T.StringType):
        if pattern:
            return df.withColumn(date_col, F.try_to_date(F.col(date_col), pattern))
        day = F.regexp_extract(F.col(date_col), _UNPADDED_DATE if unpadded else _ISO_DATE, 1)
        return df.withColumn(date_col, F.try_to_date(day, "yyyy-M-d" if unpadded else "yyyy-MM-dd"))
    return df.withColumn(date_col, F.col(date_col).cast("date"))


def coerce_numeric(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS)) -> DataFrame:
    """Read the listed columns as numbers where present; unreadable cells become NULL."""
    present = {
        c: to_double(F.col(c), text=isinstance(df.schema[c].dataType, T.StringType)) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def normalise_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn missing-value tokens (text) and NaN (floating point) into NULL, once, at the border."""
    chosen = set(df.columns if columns is None else columns)
    changed = {}
    for field in df.schema.fields:
        if field.name not in chosen:
            continue
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = blank_to_null(F.col(field.name))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = nan_to_null(F.col(field.name))
    return df.withColumns(changed) if changed else df


def raw_to_observations(
    df: DataFrame,
    mapping: dict[str, str] | None = None,
    numeric: Sequence[str] = tuple(NUMERIC_COLUMNS),
    date_col: str = DATE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw text table -> typed observations: project, rename, normalise missing values, cast.

    Dates that cannot be read stay as NULL rows; ``parse_date_column`` drops them later.
    """
    names = RAW_TO_OBSERVATION if mapping is None else mapping
    chosen = df.select(*[c for c in names if c in df.columns], *keep)
    named = chosen.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    clean = normalise_missing(named, [c for c in named.columns if c not in keep])
    typed = coerce_numeric(clean, numeric)
    return coerce_date_column(typed, date_col) if date_col in typed.columns else typed


def drop_high_missing_columns(
    df: DataFrame, high_missing_columns: Sequence[str], protected: Sequence[str] = (TARGET, DATE)
) -> DataFrame:
    """Drop the listed columns except protected ones."""
    return df.drop(*[c for c in high_missing_columns if c not in protected])


def drop_unused_columns(
    df: DataFrame, date_col: str = DATE, technical: Sequence[str] = tuple(TECHNICAL_COLUMNS),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Drop the date and the audit columns, except those in ``keep``."""
    return df.drop(*[c for c in (date_col, *technical) if c not in keep])


def split_features_target(
    df: DataFrame, target: str = TARGET, technical: Sequence[str] = tuple(TECHNICAL_COLUMNS)
) -> tuple[DataFrame, DataFrame]:
    """Features without target and audit columns, and the target alone.

    Joins between the two are never needed: the modelling operators keep both in one row.
    """
    return df.drop(target, *technical), df.select(target)


def identify_feature_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical column names, from the schema alone."""
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, (T.StringType, T.BooleanType)):
            categorical.append(field.name)
    return numeric, categorical


def lookup_features() -> list[str]:
    """Sorted names of the columns a single-value lookup may return."""
    return sorted(LOOKUP_FEATURES)


def check_lookup(feature: str, date: str) -> None:
    """Refuse unknown column names and dates not written as yyyy-MM-dd."""
    if feature not in LOOKUP_FEATURES:
        raise ValueError(f"{feature!r} is not available; choose from {lookup_features()}")
    check_date(date)


def check_date(date: str) -> None:
    """Refuse dates not written as yyyy-MM-dd."""
    try:
        datetime.strptime(date, "%Y-%m-%d")
    except ValueError as problem:
        raise ValueError(f"{date!r} is not a date of the form yyyy-MM-dd") from problem


def threshold_label(
    df: DataFrame, probability: str = "probability", cutoff: float = 0.5,
    label_col: str = "rain_tomorrow", as_text: bool = True, digits: int | None = 4,
) -> DataFrame:
    """Label from a probability; rounding happens after the comparison."""
    positive = F.col(probability) >= cutoff
    label: Column = (F.when(positive, "Yes").otherwise("No") if as_text
                     else F.when(positive, 1).otherwise(0))
    labelled = df.withColumn(label_col, label)
    if digits is None:
        return labelled
    return labelled.withColumn(probability, F.round(probability, digits))
