"""Column names and types of the station-observation tables.

Every operator takes column names as parameters; these are the defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: column names of the observation format, in file order ----
DATE = "Date"
LOCATION = "Location"
RAIN_TODAY = "RainToday"
TARGET = "RainTomorrow"

OBSERVATION_COLUMNS = [
    "Date", "Location", "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine",
    "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm", "WindSpeed9am",
    "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure9am", "Pressure3pm",
    "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm", "RainToday", "RainTomorrow",
]
WIND_COLUMNS = ["WindGustDir", "WindDir9am", "WindDir3pm"]
NUMERIC_COLUMNS = [
    "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine", "WindGustSpeed",
    "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure9am",
    "Pressure3pm", "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm",
]
# columns the single-value lookup may return
LOOKUP_FEATURES = [
    "Rainfall", "Evaporation", "Sunshine", "WindGustSpeed", "Humidity9am", "Humidity3pm",
    "Pressure9am", "Pressure3pm", "Temp9am", "Temp3pm", "RainToday", "RainTomorrow",
]
HIGH_MISSING_THRESHOLD = 0.30
# ---- end of fixed values ----

IMPORT_DATE = "import_date"
IMPORT_RUN_ID = "import_run_id"
SOURCE_FILE = "source_file"
AUDIT_COLUMNS = [IMPORT_DATE, IMPORT_RUN_ID, SOURCE_FILE]
#: audit columns by other names that observation tables carry
OTHER_AUDIT_COLUMNS = ["date_import", "data_source", "run_id"]
TECHNICAL_COLUMNS = ["id", *AUDIT_COLUMNS, *OTHER_AUDIT_COLUMNS]

#: lower-case table name of each column -> name used by the analytics
RAW_TO_OBSERVATION = {name.lower(): name for name in OBSERVATION_COLUMNS}


def text_schema(columns: list[str] | None = None) -> T.StructType:
    """All-text schema: what a file holds before any interpretation."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns or OBSERVATION_COLUMNS])


def observation_schema(with_target: bool = True) -> T.StructType:
    """Typed schema of the cleaned observation table."""
    fields = []
    for name in OBSERVATION_COLUMNS:
        if name == TARGET and not with_target:
            continue
        kind: T.DataType = T.StringType()
        if name == DATE:
            kind = T.DateType()
        elif name in NUMERIC_COLUMNS:
            kind = T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


RAW_TABLE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_TO_OBSERVATION]
    + [
        T.StructField(IMPORT_DATE, T.TimestampType()),
        T.StructField(IMPORT_RUN_ID, T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
    ]
)
