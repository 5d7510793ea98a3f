"""Missing values, counts and key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rainloom.functions.scalars import digest
from rainloom.schema import (
    DATE, HIGH_MISSING_THRESHOLD, IMPORT_DATE, LOCATION, SOURCE_FILE, TARGET,
)

_SLOTS = {"num": "double", "txt": "string", "int": "bigint"}


def _typed_value(field: T.StructField) -> tuple[str, Column]:
    """Slot and value of a column, so that nothing is turned into text to be counted."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return "num", F.when(~F.isnan(column), column)
    if isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
        return "int", column
    if isinstance(field.dataType, T.DateType):
        return "int", F.unix_date(column)
    if isinstance(field.dataType, T.TimestampType):
        return "int", F.unix_micros(column)
    return "txt", column


def _column_stats(df: DataFrame, slot: str, fields: dict[int, Column], approximate: float | None) -> DataFrame:
    """Rows, missing count and distinct count of the columns that share a slot."""
    values = df.select(F.array(*[v.cast(_SLOTS[slot]) for v in fields.values()]).alias("a"))
    places = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).alias("i")) for i, c in enumerate(fields)])
    long = values.select("a", F.explode(places).alias("p")).select("p.c", F.get("a", F.col("p.i")).alias("v"))
    if approximate is None:
        long = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        distinct = F.count("v")
    else:
        long = long.withColumn("n", F.lit(1))
        distinct = F.approx_count_distinct("v", approximate)
    return long.groupBy("c").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing_count"),
        distinct.alias("unique_values"))


_REPORT_SCHEMA = (
    "column string, dtype string, missing_count bigint, missing_rate double, missing_rate_pct double, unique_values bigint")


def missing_report(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: float | None = None,
) -> DataFrame:
    """One row per column: type, missing count, rate, rate in percent and distinct values.

    A table without rows has counts of 0 and NULL rates.

    Each column is read once, in a group with the others of its kind. Equal values are merged
    before the shuffle, which is on (column, value), so a constant or mostly empty column costs
    nothing extra. ``approximate`` is the relative error allowed for the distinct counts; it
    removes the shuffle of distinct values.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    by_slot: dict[str, dict[int, Column]] = {}
    for i, f in enumerate(fields):
        slot, value = _typed_value(f)
        by_slot.setdefault(slot, {})[i] = value
    if not fields:
        return df.sparkSession.createDataFrame([], _REPORT_SCHEMA)
    stats, *more = [_column_stats(df, slot, values, approximate) for slot, values in by_slot.items()]
    for part in more:
        stats = stats.unionByName(part)
    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    rate = F.try_divide("missing_count", "rows")          # NULL without rows
    every = df.sparkSession.createDataFrame([(i,) for i in range(len(fields))], "c int")
    stats = every.join(stats, "c", "left").fillna(0, ["rows", "missing_count", "unique_values"])
    return stats.select(
        names[F.col("c")].alias("column"),
        types[F.col("c")].alias("dtype"),
        F.col("missing_count").cast("bigint"),
        rate.alias("missing_rate"),
        F.round(rate * 100, 2).alias("missing_rate_pct"),
        F.col("unique_values").cast("bigint"),
    ).orderBy(F.desc("missing_rate"), "column")


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column and missing rate only: a single global aggregate, no distinct counts."""
    chosen = [c for c in df.columns if columns is None or c in columns]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rates = []
    for c in chosen:
        absent = F.col(c).isNull()
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            absent = absent | F.isnan(c)
        rates.append(F.avg(absent.cast("double")).alias(c))
    return df.agg(*rates).unpivot([], chosen, "column", "missing_rate")


def high_missing_columns(
    df: DataFrame, threshold: float = HIGH_MISSING_THRESHOLD, exclude: Sequence[str] = (),
) -> DataFrame:
    """Columns whose missing rate is strictly above the threshold, in name order."""
    rates = missing_rates(df, [c for c in df.columns if c not in exclude])
    return rates.where(F.col("missing_rate") > threshold).orderBy("column")


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing percentage of the columns that have any missing value, highest first."""
    return (
        missing_rates(df, columns).where(F.col("missing_rate") > 0)
        .select("column", (F.col("missing_rate") * 100).alias("missing_pct"))
        .orderBy(F.desc("missing_pct"), "column")
    )


def last_import(df: DataFrame, date_col: str = IMPORT_DATE, file_col: str = SOURCE_FILE) -> DataFrame:
    """Row count of the most recent import; of several files at that instant, the first by name.

    Grouping first needs one scan, and the groups are as few as the imports.
    """
    return (
        df.where(F.col(date_col).isNotNull()).groupBy(date_col, file_col)
        .agg(F.count(F.lit(1)).alias("rows_imported"))
        .orderBy(F.desc(date_col), F.asc_nulls_first(file_col)).limit(1)
    )


def overview_kpis(
    df: DataFrame, location_col: str = LOCATION, target: str = TARGET, date_col: str = DATE,
    positive: str = "Yes",
) -> DataFrame:
    """Rows, distinct stations, share of positive targets in percent (NULL counts as not positive)
    and first and last year."""
    hit = F.coalesce(F.col(target) == positive, F.lit(False)).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("observations"),
        F.countDistinct(location_col).alias("stations"),
        (F.avg(hit) * 100).alias("rain_pct"),
        F.min(F.year(date_col)).alias("first_year"),
        F.max(F.year(date_col)).alias("last_year"),
    )


def rain_rate_topk(
    df: DataFrame, k: int = 15, location_col: str = LOCATION, target: str = TARGET, positive: str = "Yes",
) -> DataFrame:
    """Stations with the highest share of positive targets."""
    hit = F.coalesce(F.col(target) == positive, F.lit(False)).cast("double")
    return (
        df.where(F.col(location_col).isNotNull()).groupBy(location_col)
        .agg(F.avg(hit).alias("rain_rate")).orderBy(F.desc("rain_rate"), location_col).limit(k)
    )


def value_counts(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Rows per value; NULL is a value of its own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def class_distribution(
    df: DataFrame, label_col: str = TARGET, split_col: str = "split",
    splits: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Share of each class within each split, 0 where a class is absent."""
    counts = (
        df.where(F.col(split_col).isin(*splits)).groupBy(label_col, split_col)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy(split_col).agg(F.sum("n").alias("total"))     # one row per split
    shares = counts.join(F.broadcast(totals), split_col)
    return shares.groupBy(label_col).agg(*[
        F.coalesce(F.max(F.when(F.col(split_col) == s, F.col("n") / F.col("total"))), F.lit(0.0)).alias(s)
        for s in splits
    ])


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))


def import_stats(df: DataFrame, keys: Sequence[str] = ("import_run_id", "source_file")) -> DataFrame:
    """Rows per import run and file."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_imported"))


def station_list(df: DataFrame, location_col: str = LOCATION) -> DataFrame:
    """Distinct stations in name order."""
    return df.where(F.col(location_col).isNotNull()).select(location_col).distinct().orderBy(location_col)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 50) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, key_cols: Sequence[str], n: int = 1, seed: int = 42,
                not_null: str | None = LOCATION) -> DataFrame:
    """``n`` reproducibly chosen rows among those where ``not_null`` is known."""
    known = df.where(F.col(not_null).isNotNull()) if not_null else df
    return known.orderBy(digest(*key_cols, seed=seed), *key_cols).limit(n)
