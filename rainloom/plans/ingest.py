"""Import of text files into the raw table, with an import log.

A run is visible to readers only once its log row says ``success``: data first, then the source files
are archived, then the log row. A run that fails on the way, in the archive too, puts the files back,
removes its rows and is logged as failed, so it can simply be repeated. A run that dies on the way
leaves no visible row. Rows with a wrong number of cells go to a table of their own and are counted.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rainloom.schema import IMPORT_RUN_ID
from rainloom.sources.readers import REJECTED, read_raw_text
from rainloom.sources.tables import append_raw, normalize_columns, replace_run, with_audit_columns


def ingest_files(
    spark: SparkSession, path: str, table_path: str, log_path: str, archive_dir: str | None = None,
    columns: Sequence[str] | None = None, multi_line: bool = False,
) -> dict:
    """Import all files at ``path`` and return the result record, which is also logged."""
    return import_run(spark, path, table_path, log_path, str(uuid.uuid4()), archive_dir, columns, multi_line)


def import_run(
    spark: SparkSession, paths: str | Sequence[str], table_path: str, log_path: str, run_id: str,
    archive_dir: str | None = None, columns: Sequence[str] | None = None, multi_line: bool = False,
) -> dict:
    """Import files as the run ``run_id``; a further attempt replaces the rows of an earlier one."""
    started = datetime.now(timezone.utc)
    record = {"run_id": run_id, "import_date": started.isoformat(), "source": paths if isinstance(paths, str) else ", ".join(paths),
              "status": "failed", "rows_imported": 0, "rows_rejected": 0, "archive_path": [], "error": ""}
    try:
        raw = read_raw_text(spark, paths, columns, multi_line, ragged="keep")
        files = raw.inputFiles()
        # the file name must be read at the scan, below any later operator
        audited = normalize_columns(with_audit_columns(raw, started, run_id, F.input_file_name()))
        record["rows_imported"], record["rows_rejected"] = _publish(audited, table_path)
        if archive_dir:
            record["archive_path"] = archive_files(spark, files, archive_dir, started)
        record["status"] = "success"
    except Exception as problem:      # every failure becomes a logged record, as for a missing file
        record["error"] = str(problem).splitlines()[0] if str(problem) else type(problem).__name__
        if isinstance(problem, FileNotFoundError):
            record["error"] = f"file not found: {problem}"
        record["rows_imported"] = record["rows_rejected"] = 0
        discard_run(spark, table_path, run_id)
        discard_run(spark, rejects_path(table_path), run_id)
    _log(spark, log_path, record)
    return record


def rejects_path(table_path: str) -> str:
    """Where rows with a wrong number of cells go: the cells found and the text of the row."""
    return f"{table_path.rstrip('/')}_rejects"


def _publish(audited: DataFrame, table_path: str) -> tuple[int, int]:
    """Write the rows of a run; rows imported and rejected are counted during the write."""
    seen, bad = Observation(), F.col(REJECTED).isNotNull()
    counted = audited.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    replace_run(counted.where(~bad).drop(REJECTED), table_path)
    counts = seen.get
    if counts["bad"]:
        replace_run(audited.where(bad), rejects_path(table_path))
    return counts["good"], counts["bad"]


def ingest_frame(df: DataFrame, table_path: str) -> int:
    """Append audited rows to the raw table and return how many, counted during the write."""
    seen = Observation()
    append_raw(df.observe(seen, F.count(F.lit(1)).alias("rows")), table_path)
    return seen.get["rows"]


def discard_run(spark: SparkSession, table_path: str, run_id: str) -> None:
    """Remove the files of a failed run."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/{IMPORT_RUN_ID}={run_id}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def archive_files(spark: SparkSession, files: Sequence[str], archive_dir: str, moment: datetime) -> list[str]:
    """Move source files to the archive; if one cannot be moved, those moved before go back."""
    moved: list[tuple[str, str]] = []
    try:
        for file in files:
            moved.append((file, archive_file(spark, file, archive_dir, moment)))
    except Exception:
        for old, new in reversed(moved):
            _move(spark, new, old)
        raise
    return [new for _, new in moved]


def archive_file(spark: SparkSession, source: str, archive_dir: str, moment: datetime) -> str:
    """Move a file to the archive under its name, a time stamp and a digest of its whole path."""
    stem, dot, ending = source.rpartition("/")[2].rpartition(".")
    mark = f"{moment.strftime('%Y%m%d_%H%M%S')}_{hashlib.md5(source.encode()).hexdigest()[:10]}"
    name = f"{stem}_{mark}.{ending}" if dot else f"{ending}_{mark}"
    return _move(spark, source, f"{archive_dir.rstrip('/')}/{name}")


def _move(spark: SparkSession, source: str, target: str) -> str:
    jvm = spark._jvm
    old = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(source) if "://" in source or source.startswith("file:") else source)
    new = jvm.org.apache.hadoop.fs.Path(target)
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    if system.exists(new) or not system.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")
    return new.toString()


def _log(spark: SparkSession, log_path: str, record: dict) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("append").text(log_path)
