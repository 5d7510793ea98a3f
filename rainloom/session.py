"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: above 8000 bytes of bytecode the JVM never compiles a generated method, and wide feature
#: projections exceed that; beyond this limit Spark generates many small methods instead
_RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
#: options of tables whose rows are large blocks: writer and reader hold a whole row group in memory, and
#: the writer looks at its size after 100 rows only, unless told otherwise
SMALL_GROUPS = {
    "parquet.block.size": str(4 << 20),
    **{f"parquet.{part}.size.row.check.{end}": "1" for part in ("block", "page") for end in ("min", "max")},
}
_local_scratch: dict[str, str] = {}
_scopes = threading.local()


def build_session(app: str = "rainloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; the cluster supplies the rest."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **_RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Apply the settings a running session can still take, unless the user chose other values:
    at the start, or since then (the value is no longer Spark's own default)."""
    chosen = dict(spark.sparkContext.getConf().getAll())
    defaults = {
        "spark.sql.codegen.hugeMethodLimit": "65535",
        "spark.sql.session.timeZone": spark._jvm.java.util.TimeZone.getDefault().getID(),
    }
    for key, value in _RUNTIME_SETTINGS.items():
        if key not in chosen and spark.conf.get(key) == defaults[key]:
            spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        key = context.applicationId
        if key not in _local_scratch:
            _local_scratch[key] = tempfile.mkdtemp(prefix="rainloom-")
        base = _local_scratch[key]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, everything: bool = False) -> Iterator[None]:
    """Remove what ``materialize`` writes inside the block when it ends, for good or bad.

    Tables written with ``keep`` outlive the block (they belong to an enclosing one, if any), unless
    it removes ``everything``.
    """
    mine: list[tuple[str, bool]] = []
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append(mine)
    try:
        yield
    finally:
        scopes.pop()
        for path, keep in mine:
            if keep and not everything:
                if scopes:
                    scopes[-1].append((path, keep))
            else:
                remove_path(spark, path)


@contextmanager
def plain_planning(spark: SparkSession) -> Iterator[None]:
    """Plan what is written inside the block without inferring filters from other columns.

    Over a table of derived features every column carries its derivation, and the inference takes
    longer than the work (a table of 240 rows read from text did not end in minutes; 3 s without).
    """
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def unsorted_partitions(spark: SparkSession, open_files: int = 32) -> Iterator[None]:
    """Partitioned writes inside the block keep up to so many files open per task instead of sorting all
    rows by partition first, which spills the whole table; beyond that Spark sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    if int(before) > 0:
        yield
        return
    spark.conf.set(key, str(open_files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """Write ``df`` once to shared scratch space (with the writer's ``options``) and read it back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation of everything before. The
    enclosing ``scratch_scope`` of the thread removes it, unless it is marked ``keep``.
    """
    path = scratch_dir(df.sparkSession, name)
    scopes = _scopes.__dict__.get("open")
    if scopes:
        scopes[-1].append((path, keep))
    df.write.options(**options).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def drop_written(table: DataFrame) -> None:
    """Remove a table of ``materialize`` before its scope ends; it cannot be read any more."""
    remove_path(table.sparkSession, table._scratch_path)
