"""Readers: text files, JSON documents, SQL tables and saved tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rainloom.functions.scalars import to_double
from rainloom.operators.cleaning import coerce_date_column, coerce_numeric, normalise_missing, raw_to_observations
from rainloom.schema import DATE, NUMERIC_COLUMNS, OBSERVATION_COLUMNS, RAW_TO_OBSERVATION, text_schema

#: double quotes inside a quoted cell are doubled, as in the observation files
CSV_OPTIONS = {"header": True, "sep": ",", "quote": '"', "escape": '"'}
#: column that holds a row with too few or too many cells, or a document that is no JSON
REJECTED = "_rejected"
RAGGED = ("raise", "keep", "pad")


def _require(spark: SparkSession, path: str) -> None:
    """Raise ``FileNotFoundError`` when nothing lies at ``path`` (any file system Spark can reach)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    if not found:
        raise FileNotFoundError(path)


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Cells of a file's first line; no cells for an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()


def _refuse(df: DataFrame, what: str) -> DataFrame:
    """``df`` without the column of rejected texts; reading a row that has one raises an error."""
    problem = F.raise_error(F.concat(F.lit(f"{what}: "), F.col(REJECTED))).cast("boolean")
    # all columns take part, because a scan of the rejected texts alone is not allowed
    always = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns if c != REJECTED]) >= ""
    return df.where(F.when(F.col(REJECTED).isNotNull(), problem).otherwise(always)).drop(REJECTED)


def read_raw_text(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
    multi_line: bool = False, ragged: str = "raise",
) -> DataFrame:
    """Header CSV with every cell as text and empty cells as ``""``: no interpretation at all.

    Cells are matched by header name, so files may order their columns differently; every file must
    have the names of ``columns`` (default: those of the first file). Rows with too few or too many
    cells raise an error, are kept with their text in the column ``_rejected`` (``ragged="keep"``),
    or are cut and filled (``"pad"``). Spark splits large files by itself; only cells that contain
    line breaks need ``multi_line``, which reads each file whole. One short read per file on the
    driver fetches the headers.
    """
    if ragged not in RAGGED:
        raise ValueError(f"ragged must be one of {', '.join(RAGGED)}")
    paths = [path] if isinstance(path, str) else list(path)
    for one in paths:
        _require(spark, one)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(paths).inputFiles()):
        by_header.setdefault(_header(spark, file), []).append(unquote(file))
    by_header.pop((), None)
    if not by_header:
        raise ValueError(f"no header in {', '.join(paths)}")
    names = list(columns or next(iter(by_header)))
    whole = None
    for header, files in by_header.items():
        if sorted(header) != sorted(names):
            raise ValueError(f"{files[0]} has the columns {', '.join(header)}, not {', '.join(names)}")
        schema = T.StructType([*text_schema(list(header)).fields, T.StructField(REJECTED, T.StringType())])
        # without pruning, so that the cells of every row are counted
        part = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, columnPruning=False, columnNameOfCorruptRecord=REJECTED).schema(schema).csv(files)
        part = part.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names], REJECTED)
        whole = part if whole is None else whole.unionByName(part)
    if ragged == "keep":
        return whole
    return _refuse(whole, "wrong number of cells") if ragged == "raise" else whole.drop(REJECTED)


def read_csv(
    spark: SparkSession, path: str, numeric: Sequence[str] = tuple(NUMERIC_COLUMNS),
    date_col: str | None = DATE, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Header CSV -> typed observations: missing-value tokens to NULL, numbers and dates read.

    A date that cannot be read becomes NULL and the row stays.
    """
    df = coerce_numeric(normalise_missing(read_raw_text(spark, path, columns)), numeric)
    return coerce_date_column(df, date_col) if date_col and date_col in df.columns else df


def read_json(
    spark: SparkSession, path: str, record: T.StructType | None = None, multi_line: bool = True,
    broken: str = "raise",
) -> DataFrame:
    """JSON documents, each a list of records, one record, or an object with a ``data`` list.

    ``record`` is the schema of one record (default: observations). Numbers may be written as text;
    what cannot be read as the wanted type becomes NULL. Documents that are no JSON raise an error,
    or are kept as a row with their text in ``_rejected`` (``broken="keep"``). ``multi_line=False``
    reads one document per line and splits large files.
    """
    _require(spark, path)
    record = record or _json_record()
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in record.fields])
    envelope = T.StructType([*text.fields, T.StructField("data", T.ArrayType(text)), T.StructField(REJECTED, T.StringType())])
    raw = spark.read.schema(envelope).option("multiLine", multi_line).option("columnNameOfCorruptRecord", REJECTED).json(path)
    own = F.struct(*[F.col(f.name) for f in record.fields])
    records = F.when(F.col("data").isNull(), F.array(own)).otherwise(F.col("data"))
    rows = raw.select(F.explode(records).alias("r"), REJECTED).select("r.*", REJECTED)
    rows = rows if broken == "keep" else _refuse(rows, "no JSON document")
    cells = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in record.fields]
    return rows.select(*cells, *([REJECTED] if broken == "keep" else []))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    return to_double(text) if isinstance(kind, T.DoubleType) else text.try_cast(kind)


def _json_record() -> T.StructType:
    return T.StructType([
        T.StructField(c, T.DoubleType() if c in NUMERIC_COLUMNS else T.StringType()) for c in OBSERVATION_COLUMNS
    ])


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, lower: Any = None, upper: Any = None,
    partitions: int = 16, fetch_size: int = 10_000, **credentials: str,
) -> dict[str, str]:
    """Options of a parallel SQL read. ``partition_column`` must be numeric, date or timestamp."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **credentials}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(
    spark: SparkSession, table: str | None = None, path: str | None = None, jdbc: dict[str, str] | None = None,
    mapping: dict[str, str] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Raw text table (catalog name, path or SQL server) -> typed observations."""
    if jdbc:
        raw = spark.read.format("jdbc").options(**jdbc).load()
    elif path:
        raw = spark.read.parquet(path)
    else:
        raw = spark.table(table)
    return raw_to_observations(raw, mapping or RAW_TO_OBSERVATION, keep=keep)


def read_observations(spark: SparkSession, source: str = "csv", **options: Any) -> DataFrame:
    """Observations from ``csv`` (path), ``json`` (path), ``table`` (table or path) or ``postgres``
    (url, table and credentials)."""
    if source == "csv":
        _need(source, options, "path")
        return read_csv(spark, **options)
    if source == "json":
        _need(source, options, "path")
        df = read_json(spark, **options)
        return coerce_date_column(normalise_missing(df), DATE) if DATE in df.columns else df
    if source == "table":
        if not (options.get("table") or options.get("path")):
            raise ValueError("source 'table' needs table or path")
        return read_table(spark, **options)
    if source == "postgres":
        _need(source, options, "url", "table")
        return read_table(spark, jdbc=jdbc_options(**options))
    raise ValueError(f"unknown source {source!r}; choose csv, json, table or postgres")


def _need(source: str, options: dict, *names: str) -> None:
    absent = [n for n in names if not options.get(n)]
    if absent:
        raise ValueError(f"source {source!r} needs {', '.join(absent)}")


def read_series(
    spark: SparkSession, path: str, value_cols: Sequence[str] = ("temperature", "precipitation"),
    date_col: str = "date",
) -> DataFrame:
    """Date-keyed measures for exploration; unreadable dates become NULL. Order is left to the user
    of the series, because every operator on it orders by date itself."""
    return read_csv(spark, path, value_cols, date_col)


def read_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """Run metrics written by ``append_metrics``, or nothing when there are none yet."""
    try:
        _require(spark, path)
    except FileNotFoundError:
        return None
    return spark.read.json(path)
