"""Sinks for reports, splits, predictions and run metrics."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from rainloom.session import plain_planning, unsorted_partitions


def write_report(report: DataFrame, path: str) -> None:
    """CSV of a per-column report (a row per column, so one file)."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Feature table partitioned by split, so each side is read without the other."""
    with plain_planning(df.sparkSession), unsorted_partitions(df.sparkSession):
        df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_predictions(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Scored rows with their keys, as parquet or CSV."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def append_metrics(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict) -> None:
    """One row of parameters and figures per run."""
    row = {"run_id": run_id, "logged_at": datetime.now(timezone.utc).isoformat(), "params": params, **metrics}
    spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("append").text(path)
