from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import make_frame, make_rows, replace
from pyspark.sql import functions as F

from rainloom.operators import explore, profile, versions
from rainloom.operators.cleaning import parse_date_column
from rainloom.schema import NUMERIC_COLUMNS, OBSERVATION_COLUMNS, TARGET


@pytest.fixture
def holes(spark):
    rows = make_rows(40, seed=3)
    for i in range(0, 40, 3):
        rows = replace(rows, i, Sunshine=None, WindGustDir=None)
    rows = replace(rows, 5, MaxTemp=float("nan"), RainTomorrow=None)
    return make_frame(spark, rows)


def as_pandas(df):
    return df.toPandas().fillna(value=np.nan)


@pytest.mark.parametrize("approximate", [None, 0.01])
def test_missing_report_matches_pandas(holes, approximate):
    want = as_pandas(holes)
    got = {r["column"]: r for r in profile.missing_report(holes, approximate=approximate).collect()}
    assert set(got) == set(OBSERVATION_COLUMNS)
    for c in OBSERVATION_COLUMNS:
        assert got[c].missing_count == want[c].isna().sum()
        assert got[c].missing_rate == pytest.approx(want[c].isna().mean())
        exact = want[c].nunique()
        assert got[c].unique_values == (exact if approximate is None else pytest.approx(exact, rel=0.05))
    order = [r.missing_rate for r in profile.missing_report(holes).collect()]
    assert order == sorted(order, reverse=True)


def test_high_missing_is_strict_and_sorted(spark):
    df = spark.createDataFrame(
        [(None, None, 1.0)] * 3 + [(1.0, None, None)] * 7, "c double, b double, a double")
    assert [r["column"] for r in profile.high_missing_columns(df, 0.3).collect()] == ["a", "b"]
    assert [r["column"] for r in profile.high_missing_columns(df, 0.3, exclude=["a"]).collect()] == ["b"]


def test_all_null_sunshine_is_found(spark):
    rows = make_rows()
    for i in range(12):
        rows = replace(rows, i, Sunshine=None)
    found = profile.high_missing_columns(make_frame(spark, rows), exclude=[TARGET]).collect()
    assert [r["column"] for r in found] == ["Sunshine"]


def test_kpis_and_rates_count_null_as_no(holes):
    row = profile.overview_kpis(parse_date_column(holes)).first()
    want = as_pandas(holes)
    assert row.observations == 40 and row.stations == 3
    assert row.rain_pct == pytest.approx((want[TARGET] == "Yes").mean() * 100)
    assert (row.first_year, row.last_year) == (2017, 2017)
    rates = {r.Location: r.rain_rate for r in profile.rain_rate_topk(holes).collect()}
    for name, part in want.groupby("Location"):
        assert rates[name] == pytest.approx((part[TARGET] == "Yes").mean())
    counts = {r[TARGET]: r.n for r in profile.value_counts(holes).collect()}
    assert counts[None] == 1 and sum(counts.values()) == 40


def test_class_distribution_fills_absent_classes(spark):
    df = spark.createDataFrame([(0, "train"), (0, "train"), (1, "train"), (0, "test")], "y int, split string")
    got = {r.y: (r.train, r.test) for r in profile.class_distribution(df, "y").collect()}
    assert got == {0: (pytest.approx(2 / 3), 1.0), 1: (pytest.approx(1 / 3), 0.0)}


def test_last_import_takes_newest_then_first_file(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    df = spark.createDataFrame(
        [(old, "a"), (new, "b"), (new, "a"), (new, "a"), (None, "z")], "import_date timestamp, source_file string")
    row = profile.last_import(df).first()
    assert (row.import_date, row.source_file, row.rows_imported) == (new, "a", 2)


@pytest.mark.parametrize("lower", [False, True])
def test_correlations_match_pandas(holes, lower):
    want = as_pandas(holes)[NUMERIC_COLUMNS].corr()
    got = explore.corr_matrix(holes, lower_triangle=lower).collect()
    assert len(got) == (120 if lower else 256)
    for r in got:
        assert r.correlation == pytest.approx(want.loc[r.variable, r.other], abs=1e-9)
        if lower:
            assert NUMERIC_COLUMNS.index(r.variable) > NUMERIC_COLUMNS.index(r.other)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    got = {(r.variable, r.other): r.correlation for r in explore.corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "a")] is None and got[("a", "b")] is None and got[("b", "b")] == 1.0


def test_histogram_matches_numpy(holes):
    values = as_pandas(holes)["Humidity3pm"].dropna()
    counts, edges = np.histogram(values, bins=35)
    rows = sorted(explore.histogram(holes, ["Humidity3pm"], 35).collect(), key=lambda r: r.bin)
    assert [r.n for r in rows] == list(counts)
    np.testing.assert_allclose([r.bin_start for r in rows], edges[:-1])


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    rows = explore.histogram(df, ["x"], 10).collect()
    assert sum(r.n for r in rows) == 5 and len(rows) == 10


def test_kde_matches_direct_sum(holes):
    values = as_pandas(holes)["Humidity3pm"].dropna().to_numpy()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    rows = explore.kde(holes, "Humidity3pm").orderBy("grid").collect()
    np.testing.assert_allclose([r.density for r in rows], want, rtol=1e-9)


def test_box_statistics(spark):
    random = np.random.default_rng(5)
    rows = [(date(2020, 1 + i % 3, 1 + i % 28), float(v)) for i, v in enumerate(random.normal(size=600))]
    rows += [(date(2020, 1, 1), 50.0), (date(2020, 5, 1), None)]
    got = {r.month: r for r in explore.monthly_box_stats(
        spark.createDataFrame(rows, "Date date, v double"), "v").collect()}
    assert set(got) == {1, 2, 3}
    for m, r in got.items():
        v = np.array([x for d, x in rows if d.month == m and x is not None])
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        keep = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        np.testing.assert_allclose(
            [r.q1, r.median, r.q3, r.whisker_low, r.whisker_high], [q1, q2, q3, keep.min(), keep.max()])
        assert r.outliers == len(v) - len(keep)


def test_pivot_has_twelve_months(holes):
    df = explore.year_month_pivot(parse_date_column(holes))
    assert df.columns == ["year", *[f"m{m}" for m in range(1, 13)]]
    row = df.first()
    assert row.m1 is None and row.m3 > 0 and not math.isnan(row.m3)


def test_monthly_means_fill_gaps(spark):
    rows = [("a", date(2020, 1, 5), 1.0), ("a", date(2020, 1, 9), 3.0), ("a", date(2020, 4, 2), 5.0), ("b", date(2020, 2, 2), 7.0)]
    df = spark.createDataFrame(rows, "Location string, Date date, x double")
    got = {(r.Location, r.month_end): r.x for r in explore.monthly_resample(df, ["x"]).collect()}
    assert got == {
        ("a", date(2020, 1, 31)): 2.0, ("a", date(2020, 2, 29)): None, ("a", date(2020, 3, 31)): None,
        ("a", date(2020, 4, 30)): 5.0, ("b", date(2020, 2, 29)): 7.0,
    }


def test_rolling_mean_matches_pandas(spark):
    random = np.random.default_rng(6)
    values = [None if i == 12 else float(v) for i, v in enumerate(random.normal(size=30))]
    rows = [("a", date(2020, 1, 1) + timedelta(days=2 * i), v) for i, v in enumerate(values)]
    got = explore.rolling_mean(spark.createDataFrame(rows, "Location string, Date date, x double"), "x").orderBy("Date")
    want = pd.Series(values, dtype=float).rolling(7, center=True).mean()
    have = pd.Series([r.x_smooth for r in got.collect()], dtype=float)
    np.testing.assert_allclose(have, want)


def raw_versions(spark):
    rows = [
        ("2020-01-01", "Fenwick", "1", datetime(2024, 1, 1)), ("2020-01-01", "Fenwick", "2", datetime(2024, 3, 1)),
        ("2020-01-01", "Fenwick", "3", datetime(2024, 2, 1)), ("2020-01-02", "Saltmere", "4", datetime(2024, 1, 1)),
    ]
    return spark.createDataFrame(rows, "date string, location string, rainfall string, import_date timestamp")


def test_latest_version_wins(spark):
    df = raw_versions(spark)
    got = {r.location: r.rainfall for r in versions.latest_observation(df).collect()}
    assert got == {"Fenwick": "2", "Saltmere": "4"}
    assert versions.feature_at(df, "2020-01-01", "Fenwick").first().rainfall == "2"
    assert versions.feature_at(df, "2020-01-09", "Fenwick").first() is None
    rows = versions.feature_lookup(df, "Rainfall").collect()
    assert {(r.location, r.feature, r.value) for r in rows} == {("Fenwick", "Rainfall", "2"), ("Saltmere", "Rainfall", "4")}
    with pytest.raises(ValueError):
        versions.feature_lookup(df, "MinTemp")


def test_point_lookup_filters_reach_the_scan(spark, tmp_path):
    raw_versions(spark).write.parquet(str(tmp_path / "t"))
    df = versions.observation_at(spark.read.parquet(str(tmp_path / "t")), "2020-01-01", "Fenwick", ["rainfall"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(location,Fenwick)" in plan and "TakeOrderedAndProject" in plan


def test_sample_and_preview_are_repeatable(holes):
    one = profile.sample_rows(holes, ["Date", "Location"], 3).collect()
    two = profile.sample_rows(holes.repartition(7), ["Date", "Location"], 3).collect()
    assert one == two and len(one) == 3
    assert [r.Date for r in profile.preview(holes, ["Date"], 2).collect()] == ["2017-03-05", "2017-03-06"]
    assert [r.Location for r in profile.station_list(holes).collect()] == ["Fenwick", "Saltmere", "Upper Holm"]


def test_hot_key_lookup_is_salted(spark):
    from rainloom.operators import lookup

    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")))
    table = spark.createDataFrame([("hot", 1.0), ("950", 2.0)], "k string, v double")
    joined = lookup.lookup_join(df, table, ["k"], lookup.BROADCAST_ROWS + 1, ["id"])
    assert joined.count() == 1000
    assert {(r.v, r["count"]) for r in joined.groupBy("v").count().collect()} == {(1.0, 900), (2.0, 1), (None, 99)}


def test_nan_and_empty_tables(spark):
    df = spark.createDataFrame([(date(2021, 3, 1), "a", 1.0), (date(2021, 3, 2), "a", float("nan")), (date(2021, 3, 3), "a", 4.0)], "Date date, Location string, MaxTemp double")
    assert explore.year_month_pivot(df).first().m3 == 2.5
    assert explore.monthly_resample(df, ["MaxTemp"]).first().MaxTemp == 2.5
    assert explore.rolling_mean(df.where("MaxTemp < 9"), series_col=None, rows=1).count() == 2
    empty = profile.missing_report(df.limit(0)).collect()
    assert [(r["column"], r.missing_count, r.missing_rate, r.unique_values) for r in sorted(empty)] == [
        (c, 0, None, 0) for c in ("Date", "Location", "MaxTemp")]
    assert profile.missing_report(df, columns=[]).count() == 0
    assert all(r.correlation is None for r in explore.corr_matrix(df.limit(0), ["MaxTemp"]).collect())
    for frame in (explore.kde_columns(df.limit(0), ["MaxTemp"]), explore.year_month_pivot(df.limit(0))):
        assert frame.count() == 0


def test_densities_of_all_columns_equal_single_ones(holes):
    many = explore.kde_columns(holes, ["MaxTemp", "Humidity3pm"], 50)
    for c in ("MaxTemp", "Humidity3pm"):
        want = {r.grid: (r.x, r.density) for r in explore.kde(holes, c, 50).collect()}
        got = {r.grid: (r.x, r.density) for r in many.where(many["column"] == c).collect()}
        assert set(got) == set(want) and all(got[g] == pytest.approx(want[g]) for g in got)


def test_older_versions_go_before_rows_are_sorted(spark, monkeypatch):
    rows = [(None if i % 11 == 0 else f"k{i % 5}", None if i % 13 == 0 or i % 5 == 2 else i % 7, i % 3, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v int, t int, x int")
    want = {}
    for k, v, t, x in rows:
        mark = (-1 if v is None else v, t)
        want[k] = max(want.get(k, mark), mark)
    for bound in (versions.NEWEST_KEYS, 2):
        monkeypatch.setattr(versions, "NEWEST_KEYS", bound)
        got = versions.latest_observation(df, ["k"], "v", ["t"])
        assert {r.k: (-1 if r.v is None else r.v, r.t) for r in got.collect()} == want
        # the table of newest versions is joined below the sorting aggregate
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftSemi" in plan) == (bound > 2)
