"""The raw table: text columns as imported, plus audit columns, partitioned by import run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rainloom.schema import IMPORT_DATE, IMPORT_RUN_ID, SOURCE_FILE
from rainloom.session import unsorted_partitions


def with_audit_columns(
    df: DataFrame, import_date: datetime | Column, run_id: str | Column, source_file: str | Column | None = None,
) -> DataFrame:
    """Add the import instant, the run id and the source file (default: the file each row came from)."""
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return df.withColumns({
        IMPORT_DATE: column(import_date).cast("timestamp"),
        IMPORT_RUN_ID: column(run_id),
        SOURCE_FILE: F.col("_metadata.file_path") if source_file is None else column(source_file),
    })


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names stripped, in lower case, blanks as underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def append_raw(df: DataFrame, path: str) -> None:
    """Append the rows of one run to the raw table; no version is replaced."""
    with unsorted_partitions(df.sparkSession):
        df.write.mode("append").partitionBy(IMPORT_RUN_ID).parquet(path)


def replace_run(df: DataFrame, path: str) -> None:
    """Write the rows of one run; rows that an earlier attempt of the same run left are replaced."""
    with unsorted_partitions(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(IMPORT_RUN_ID).parquet(path)


def read_raw_table(spark: SparkSession, path: str, log_path: str | None = None) -> DataFrame:
    """The raw table, of batch and stream imports alike. With ``log_path`` only rows of runs logged as
    successful are visible, so a run that failed half way never shows; the log prunes the run
    partitions at run time."""
    raw = spark.read.option("basePath", path).parquet(path)
    if log_path is None:
        return raw
    done = read_import_log(spark, log_path).where(F.col("status") == "success").select(F.col("run_id").alias(IMPORT_RUN_ID))
    return raw.join(done, IMPORT_RUN_ID, "left_semi")


def read_import_log(spark: SparkSession, log_path: str) -> DataFrame:
    """One row per run and status; a repeated attempt of a stream batch logs the same row again."""
    log = spark.read.json(log_path)
    return log.dropDuplicates(["run_id", "status"])
