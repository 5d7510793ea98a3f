"""Tables behind the exploration figures: correlation, histogram, density, box statistics,
pivots and monthly series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.functions.scalars import nan_to_null
from rainloom.operators.order_stats import series_quantiles
from rainloom.schema import DATE, LOCATION, NUMERIC_COLUMNS


def corr_matrix(
    df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS), lower_triangle: bool = False,
) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are known.

    Two scans: means, then masked cross products of the centred values, one matrix product per Arrow
    batch; each task sends four small matrices to the shuffle. ``lower_triangle`` returns the pairs
    below the diagonal only. The correlation with a constant column is NULL.
    """
    columns = list(columns)
    values = [nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    packed = df.select(*values)
    means = packed.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in packed.columns]).first()
    centre = np.array([float(m) for m in means])
    size = len(columns)

    def products(batches):
        sums = np.zeros((4, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            mask = known.astype(float)
            sums += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array([part.ravel()]) for part in sums], names=list("nspq"))

    # n: rows where both are known; s and p: sums of the first and of its square over them; q: of the product
    tasks = packed.mapInArrow(products, "n array<double>, s array<double>, p array<double>, q array<double>")
    cells = tasks.select(F.posexplode(F.arrays_zip("n", "s", "p", "q")).alias("at", "m")).groupBy("at").agg(
        *[F.sum(f"m.{c}").alias(c) for c in "nspq"])
    both = cells.withColumns({"i": F.floor(F.col("at") / size).cast("int"), "j": (F.col("at") % size).cast("int")})
    other = both.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("t"), F.col("p").alias("u"))
    shared = F.col("q") - F.try_divide(F.col("s") * F.col("t"), F.col("n"))
    spread = (F.col("p") - F.try_divide(F.col("s") * F.col("s"), F.col("n"))) * (F.col("u") - F.try_divide(F.col("t") * F.col("t"), F.col("n")))
    whole = both.join(other, ["i", "j"])
    below = F.col("i") < F.col("j") if lower_triangle else F.col("i") <= F.col("j")
    # rounding leaves a trace of spread in a constant column
    trace = F.lit(1e-24) * F.col("p") * F.col("u")
    found = whole.where(below).select("i", "j", F.when(spread > trace, shared / F.sqrt(spread)).alias("correlation"))
    names = F.array(*[F.lit(c) for c in columns])
    # exactly 1 on the diagonal of any column that varies
    value = F.when((F.col("i") == F.col("j")) & F.col("correlation").isNotNull(), F.lit(1.0)).otherwise(
        F.col("correlation"))
    below = found.select(F.col("j").alias("r"), F.col("i").alias("c"), value.alias("correlation"))
    if not lower_triangle:
        mirrored = F.explode(F.when(F.col("r") == F.col("c"), F.array(F.struct("r", "c"))).otherwise(
            F.array(F.struct("r", "c"), F.struct(F.col("c").alias("r"), F.col("r").alias("c"))))).alias("k")
        below = below.select(mirrored, "correlation").select("k.r", "k.c", "correlation")
    return below.select(names[F.col("r")].alias("variable"), names[F.col("c")].alias("other"), "correlation")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """Counts in ``bins`` equal intervals between minimum and maximum of each column, empty bins
    included. The last bin holds the maximum; a constant column spans a unit interval around it."""
    long = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    long = long.unpivot([], list(columns), "variable", "value").where(F.col("value").isNotNull())
    spans = long.groupBy("variable").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    flat = F.col("low") == F.col("high")
    spans = spans.select(
        "variable",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    spans = F.broadcast(spans)          # one row per chosen column
    width = F.col("high") - F.col("low")
    place = F.floor((F.col("value") - F.col("low")) / width * bins)
    counts = (
        long.join(spans, "variable")
        .select("variable", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["variable", "bin"], "left").select(
        "variable", "bin",
        (F.col("low") + width * F.col("bin") / bins).alias("bin_start"),
        (F.col("low") + width * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def kde(df: DataFrame, column: str, grid_points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, Scott bandwidth.

    Exact: equal values are merged first, then every distinct value adds its weight to each grid
    point by map-side partial sums, so only ``grid_points`` rows per task are shuffled.
    """
    known = df.select(nan_to_null(F.col(column).cast("double")).alias("x")).where(F.col("x").isNotNull())
    stats = known.agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("deviation"),
        F.min("x").alias("low"), F.max("x").alias("high"),
    ).first()
    if stats["n"] < 2 or stats["low"] == stats["high"]:
        return df.sparkSession.createDataFrame([], "grid int, x double, density double")
    bandwidth = stats["deviation"] * stats["n"] ** -0.2
    weights = known.groupBy("x").agg(F.count(F.lit(1)).alias("w"))
    step = (stats["high"] - stats["low"]) / (grid_points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("grid")
    at: Column = F.lit(stats["low"]) + F.col("grid") * F.lit(step)
    distance = (at - F.col("x")) / F.lit(bandwidth)
    scale = 1.0 / (stats["n"] * bandwidth * math.sqrt(2 * math.pi))
    return (
        weights.select("x", "w", grid)
        .groupBy("grid").agg((F.sum(F.col("w") * F.exp(-0.5 * distance * distance)) * scale).alias("density"))
        .select("grid", at.alias("x"), "density")
    )


def kde_columns(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS), grid_points: int = 200) -> DataFrame:
    """``kde`` of several columns from one scan each for ranges and densities, with their names.

    Columns with fewer than two distinct values have no density and give no rows.
    """
    names = F.array(*[F.lit(c) for c in columns])
    packed = df.select(F.array(*[nan_to_null(F.col(c).cast("double")) for c in columns]).alias("a"))
    known = packed.select(F.posexplode("a").alias("k", "x")).where(F.col("x").isNotNull())
    stats = known.groupBy("k").agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("deviation"), F.min("x").alias("low"), F.max("x").alias("high"),
    ).where("n > 1 and low < high").select(
        "k", "n", "low", (F.col("deviation") * F.pow("n", F.lit(-0.2))).alias("width"), ((F.col("high") - F.col("low")) / (grid_points - 1)).alias("step"))
    weights = known.groupBy("k", "x").agg(F.count(F.lit(1)).alias("w"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("grid")
    # one row per column on the right
    spread = weights.join(F.broadcast(stats), "k").select("k", "x", "w", "n", "low", "width", "step", grid)
    distance = (F.col("low") + F.col("grid") * F.col("step") - F.col("x")) / F.col("width")
    scale = F.col("n") * F.col("width") * math.sqrt(2 * math.pi)
    summed = spread.groupBy("k", "grid").agg(
        F.sum(F.col("w") * F.exp(-0.5 * distance * distance) / scale).alias("density"), F.first(F.col("low") + F.col("grid") * F.col("step")).alias("x"))
    return summed.select(names[F.col("k")].alias("column"), "grid", "x", "density")


def monthly_box_stats(df: DataFrame, column: str = "MaxTemp", date_col: str = DATE) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count per calendar month.

    Quartiles are exact, and a busy month is spread over all tasks.
    """
    value = nan_to_null(F.col(column).cast("double"))
    months = df.select(F.month(date_col).alias("month"), value.alias("value")).where(
        F.col("value").isNotNull() & F.col("month").isNotNull())
    tall = months.select((F.col("month") - 1).alias("k"), F.col("value").alias("v"))
    rows = []
    for m, (q1, median, q3) in enumerate(series_quantiles(tall, 12, [0.25, 0.5, 0.75]), start=1):
        if median is None:
            continue
        reach = 1.5 * (q3 - q1)
        rows.append((m, q1, median, q3, q1 - reach, q3 + reach))
    boxes = df.sparkSession.createDataFrame(
        rows, "month int, q1 double, median double, q3 double, low_fence double, high_fence double")
    within = (F.col("value") >= F.col("low_fence")) & (F.col("value") <= F.col("high_fence"))
    return (
        months.join(F.broadcast(boxes), "month")            # twelve rows
        .groupBy("month").agg(
            *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(within, F.col("value"))).alias("whisker_low"),
            F.max(F.when(within, F.col("value"))).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def year_month_pivot(df: DataFrame, column: str = "MaxTemp", date_col: str = DATE) -> DataFrame:
    """Mean per year (rows) and month (always twelve columns ``m1`` .. ``m12``)."""
    return (
        df.select(F.year(date_col).alias("year"), F.month(date_col).alias("month"), nan_to_null(F.col(column).cast("double")).alias("v"))
        .where(F.col("year").isNotNull())
        .groupBy("year").pivot("month", list(range(1, 13))).agg(F.avg("v"))
        .withColumnsRenamed({str(m): f"m{m}" for m in range(1, 13)})
    )


def monthly_resample(
    df: DataFrame, columns: Sequence[str] = ("MaxTemp", "MinTemp", "Rainfall"),
    location_col: str = LOCATION, date_col: str = DATE,
) -> DataFrame:
    """Calendar-month means per station, labelled by month end; months in a gap appear with NULLs."""
    known = df.where(F.col(location_col).isNotNull() & F.col(date_col).isNotNull())
    means = known.groupBy(location_col, F.last_day(date_col).alias("month_end")).agg(
        *[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in columns])
    # stations x months rows from here on; the span reuses the aggregate above
    span = means.groupBy(location_col).agg(F.min("month_end").alias("a"), F.max("month_end").alias("b"))
    months = F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))
    spine = span.select(location_col, F.explode(months).alias("m")).select(
        location_col, F.last_day("m").alias("month_end"))
    return spine.join(means, [location_col, "month_end"], "left")


def rolling_mean(
    df: DataFrame, column: str = "MaxTemp", series_col: str | None = LOCATION, date_col: str = DATE,
    rows: int = 7,
) -> DataFrame:
    """Centred rolling mean over ``rows`` consecutive days of record, NULL unless all are known.

    Without ``series_col`` the whole frame is one series.

    Each series is first reduced to one row per day (mean of the known values), so a window
    partition holds at most one row per calendar day however many rows a series has.
    """
    half, keys = rows // 2, [series_col] if series_col else []
    daily = (
        df.where(F.col(date_col).isNotNull()).groupBy(*keys, date_col)
        .agg(F.avg(nan_to_null(F.col(column).cast("double"))).alias(column))
    )
    frame = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(-half, rows - 1 - half)
    smooth = F.when(F.count(column).over(frame) == rows, F.avg(column).over(frame))
    return daily.withColumn(f"{column}_smooth", smooth)


def time_series(
    df: DataFrame, value_cols: Sequence[str], series_col: str | None = LOCATION, date_col: str = DATE,
) -> DataFrame:
    """Date-keyed measures for a line chart, in date order."""
    keys = [c for c in (series_col, date_col) if c]
    return df.where(F.col(date_col).isNotNull()).select(*keys, *value_cols).orderBy(*keys)
