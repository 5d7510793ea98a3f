"""Observation rows derived from ``lineitem``, one per line item.

The expressions are plain SQL with one meaning in Spark and in the checking engine. They give every
observation column a realistic range and a pattern of missing values; nothing is rounded here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainloom.functions.scalars import COMPASS_POINTS


def _compass(expression: str) -> str:
    """Compass point by index; index 16 is unknown and gives NULL."""
    cases = " ".join(f"when {i} then '{p}'" for i, p in enumerate(COMPASS_POINTS))
    return f"case {expression} {cases} end"


def _unless(test: str, value: str) -> str:
    return f"case when {test} then null else {value} end"


#: (column, expression over lineitem)
COLUMNS = [
    ("Date", "cast(l_shipdate as date)"),
    ("Location", "concat('S', cast(l_suppkey % 49 as string))"),
    ("MinTemp", _unless("l_orderkey % 25 < 1", "l_extendedprice / 3137.0 - l_discount * 100")),
    ("MaxTemp", _unless("l_orderkey % 20 < 1", "l_extendedprice / 3137.0")),
    ("Rainfall", _unless("l_linenumber = 7", "l_quantity * 0.5 - 12.5")),
    ("Evaporation", _unless("l_partkey % 9 < 4", "l_tax * 50 + l_quantity / 10")),
    ("Sunshine", _unless("l_orderkey % 10 < 4", "l_discount * 140")),
    ("WindGustDir", _compass("l_partkey % 17")),
    ("WindGustSpeed", _unless("l_orderkey % 16 = 5", "20 + l_quantity * 0.8")),
    ("WindDir9am", _compass("l_orderkey % 17")),
    ("WindDir3pm", _compass("(l_partkey + l_linenumber) % 17")),
    ("WindSpeed9am", _unless("l_partkey % 40 = 7", "l_quantity * 0.4 + l_tax * 50")),
    ("WindSpeed3pm", _unless("l_partkey % 50 = 9", "l_quantity * 0.5 + l_discount * 30")),
    ("Humidity9am", _unless("l_partkey % 45 = 2", "30 + l_discount * 500")),
    ("Humidity3pm", _unless("l_partkey % 15 < 1", "20 + l_tax * 1000")),
    ("Pressure9am", _unless("l_orderkey % 11 = 3", "1000 + l_tax * 200 + l_discount * 50")),
    ("Pressure3pm", _unless("l_orderkey % 11 = 4", "998 + l_tax * 210 + l_quantity * 0.1")),
    ("Cloud9am", _unless("l_partkey % 8 < 3", "cast(l_partkey % 9 as double)")),
    ("Cloud3pm", _unless("l_partkey % 8 < 3", "cast((l_partkey + l_linenumber) % 9 as double)")),
    ("Temp9am", _unless("l_orderkey % 90 = 1", "l_extendedprice / 3517.0 + l_tax * 20")),
    ("Temp3pm", _unless("l_orderkey % 80 = 1", "l_extendedprice / 3109.0 - l_discount * 15")),
    ("RainToday", _unless("l_orderkey % 30 = 7", "case when l_returnflag = 'R' then 'Yes' else 'No' end")),
    ("RainTomorrow", _unless("l_orderkey % 40 = 9",
                             "case when l_quantity + l_tax * 100 > 38 then 'Yes' else 'No' end")),
    ("order_key", "cast(l_orderkey as bigint)"),
    ("line_no", "cast(l_linenumber as int)"),
    ("part_key", "cast(l_partkey as bigint)"),
]
#: columns that identify a row
KEYS = ["Date", "Location", "order_key", "line_no", "part_key"]
ID = ["order_key", "line_no", "part_key"]

#: further columns some queries need
EXTRA = {
    "date_text": "case when l_orderkey % 50 = 3 then '2020-13-01' when l_orderkey % 50 = 4 then 'NA'"
                 " else cast(cast(l_shipdate as date) as string) end",
    "rain_text": "case when l_linenumber = 7 then 'NA' when l_linenumber = 6 then ''"
                 " else cast(cast(l_quantity as int) as string) end",
    "import_day": "cast(l_linenumber as int)",
    "status": "l_linestatus",
    "score": "l_extendedprice / 105019.0",
}


def observations(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """All observation columns, the row keys and the named extra columns."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.selectExpr(*[f"{e} as {n}" for n, e in COLUMNS], *[f"{EXTRA[n]} as {n}" for n in extra])


def observations_sql(*extra: str) -> str:
    """The same rows as a subquery."""
    parts = [f"{e} as {n}" for n, e in COLUMNS] + [f"{EXTRA[n]} as {n}" for n in extra]
    return f"select {', '.join(parts)} from lineitem"
