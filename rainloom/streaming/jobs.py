"""Streams: files into the raw table as they land, and scoring of newly arrived observations."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rainloom.operators.modeling import RainModel, batch_predict
from rainloom.plans.ingest import import_run
from rainloom.schema import DATE, LOCATION


#: what a file stream tells of a file; the content is not read here
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(
    spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str, log_path: str,
    archive_dir: str | None = None, columns: Sequence[str] | None = None, run_id: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Import the files waiting in ``landing_dir`` and stop; run again for later files.

    Every batch is a run of the raw table, ``<run_id>-<batch number>``, with its own log row and
    counts, exactly as a batch import writes them; both share one table. A batch that is repeated
    after a crash replaces its own rows. ``run_id`` defaults to a name made from the checkpoint path,
    so it stays the same between starts. A file whose header does not fit stops the query. Spark
    moves a finished file to ``archive_dir`` during a following run, never before its rows are
    committed.
    """
    name = run_id or str(uuid.uuid5(uuid.NAMESPACE_URL, checkpoint))
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def land(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").distinct().collect())      # names of files only
        if paths:
            record = import_run(batch.sparkSession, paths, table_path, log_path, f"{name}-{number:06d}", columns=columns)
            if record["status"] != "success":
                raise RuntimeError(record["error"])

    files = reader.load(landing_dir).select("path")
    return files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_score(
    observations: DataFrame, model: RainModel, output_path: str, checkpoint: str,
    keys: Sequence[str] = (DATE, LOCATION),
) -> StreamingQuery:
    """Score arriving observations. Stateless: each row is scored once, as in a batch."""
    return append_stream(batch_predict(observations, model, keys), output_path, checkpoint)


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Exactly-once append of everything available now to a parquet table."""
    writer = df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()
