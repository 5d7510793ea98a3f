"""Feature expressions over one row. Each function maps a DataFrame to a DataFrame and adds
only projections, so a chain of them is a single narrow stage."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rainloom.functions.scalars import compass_degrees
from rainloom.schema import DATE, WIND_COLUMNS

# ---- fixed values: derived measurements and their inputs ----
#: new column -> (minuend, subtrahend)
DIFFERENCES = {
    "TempRange": ("MaxTemp", "MinTemp"),
    "TempChange": ("Temp3pm", "Temp9am"),
    "HumidityDrop": ("Humidity9am", "Humidity3pm"),
    "PressureDrop": ("Pressure9am", "Pressure3pm"),
    "WindSpeedChange": ("WindSpeed3pm", "WindSpeed9am"),
}
#: new column -> amount whose log1p is taken, negatives counted as 0
LOG_AMOUNTS = {"RainfallLog1p": "Rainfall"}
#: new column -> (input, test, threshold)
FLAGS = {
    "HasRainfall": ("Rainfall", "above", 0.0),
    "HighHumidity3pm": ("Humidity3pm", "at least", 70.0),
    "StrongWindGust": ("WindGustSpeed", "at least", 50.0),
}
MONTHS_PER_CYCLE = 12
#: day 366 runs past the end of the cycle on purpose
DAYS_PER_CYCLE = 365
# ---- end of fixed values ----

TEMPORAL_FEATURES = ["Year", "Month", "Day", "DayOfYear"]
CYCLICAL_FEATURES = ["Month_sin", "Month_cos", "DayOfYear_sin", "DayOfYear_cos"]
WEATHER_FEATURES = [*DIFFERENCES, *LOG_AMOUNTS, *FLAGS]


def add_temporal_features(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """Year, month, day and day of year as integers."""
    return df.withColumns({
        "Year": F.year(date_col),
        "Month": F.month(date_col),
        "Day": F.dayofmonth(date_col),
        "DayOfYear": F.dayofyear(date_col),
    })


def add_cyclical_features(df: DataFrame, month_col: str = "Month", day_col: str = "DayOfYear") -> DataFrame:
    """Position in the year as points on a circle."""
    added = {}
    for name, length in ((month_col, MONTHS_PER_CYCLE), (day_col, DAYS_PER_CYCLE)):
        angle = F.col(name) * F.lit(2 * math.pi) / F.lit(length)
        added[f"{name}_sin"] = F.sin(angle)
        added[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(added)


def encode_wind_directions(df: DataFrame, columns: Sequence[str] = tuple(WIND_COLUMNS)) -> DataFrame:
    """Replace each compass column by its sine and cosine; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    added = {}
    for name in present:
        angle = F.radians(compass_degrees(F.col(name)))
        added[f"{name}_sin"] = F.sin(angle)
        added[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(added).drop(*present) if present else df


def add_weather_features(
    df: DataFrame,
    differences: Mapping[str, tuple[str, str]] = DIFFERENCES,
    log_amounts: Mapping[str, str] = LOG_AMOUNTS,
    flags: Mapping[str, tuple[str, str, float]] = FLAGS,
) -> DataFrame:
    """Differences, log amount and threshold flags; a NULL input gives a NULL result."""
    added = {name: F.col(a) - F.col(b) for name, (a, b) in differences.items()}
    for name, source in log_amounts.items():
        amount = F.col(source)
        added[name] = F.log1p(F.when(amount < 0, F.lit(0.0)).otherwise(amount))
    for name, (source, test, threshold) in flags.items():
        value = F.col(source)
        holds = value > threshold if test == "above" else value >= threshold
        added[name] = holds.cast("double")
    return df.withColumns(added)
