"""The two stateless chains: training features and scoring features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rainloom.functions.features import (
    add_cyclical_features, add_temporal_features, add_weather_features, encode_wind_directions,
)
from rainloom.operators.cleaning import (
    clean_target, coerce_numeric, drop_high_missing_columns, drop_unused_columns, encode_rain_today,
    parse_date_column, validate_schema,
)
from rainloom.schema import DATE, TARGET, TECHNICAL_COLUMNS


def _row_features(df: DataFrame) -> DataFrame:
    return (
        df.transform(encode_rain_today)
        .transform(parse_date_column)
        .transform(add_temporal_features)
        .transform(add_cyclical_features)
        .transform(encode_wind_directions)
        .transform(add_weather_features)
    )


def prepare_features(
    df: DataFrame, high_missing_columns: Sequence[str] = (), drop_high_missing: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Observations -> features and 0/1 target in one row; nothing is learnt from the data.

    The whole chain is projections and filters: one stage, no shuffle. ``keep`` names date or
    audit columns that stay as keys.
    """
    validate_schema(df)
    ready = _row_features(clean_target(df))
    if drop_high_missing:
        ready = drop_high_missing_columns(ready, high_missing_columns, (TARGET, DATE, *keep))
    return drop_unused_columns(ready, keep=keep)


def featurize(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """New observations -> features: numbers coerced, target and audit columns removed."""
    ready = _row_features(coerce_numeric(df))
    return drop_unused_columns(ready, keep=keep).drop(
        *[c for c in (TARGET, *TECHNICAL_COLUMNS) if c not in keep])
