from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rainloom.operators import splits

KEYS = ["Date", "id"]


def frame(spark, per_day):
    rows, i = [], 0
    for offset, n in enumerate(per_day):
        for _ in range(n):
            rows.append((date(2020, 1, 1) + timedelta(days=offset), i, int(i % 10 < 3)))
            i += 1
    return spark.createDataFrame(rows, "Date date, id bigint, y int")


@pytest.mark.parametrize("per_day", [[1] * 10, [5, 5, 5, 5], [3, 90, 7], [1, 1, 500], [50]])
@pytest.mark.parametrize("fetch", [4096, 4])
def test_positional_split(spark, per_day, fetch, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", fetch)
    df = splits.temporal_split(frame(spark, per_day), 0.2, "Date", KEYS)
    n = sum(per_day)
    train = df.where("split = 'train'")
    assert train.count() == int(n * 0.8) and df.count() == n
    last = train.agg(F.max("Date")).first()[0]
    first = df.where("split = 'test'").agg(F.min("Date")).first()[0]
    assert last <= first


def test_split_needs_no_shuffle_of_rows(spark):
    df = splits.temporal_split(frame(spark, [4] * 10), 0.2, "Date", KEYS)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_whole_dates(spark):
    df = splits.temporal_split(frame(spark, [10, 10, 10]), 0.5, "Date", KEYS, whole_dates=True)
    sides = df.groupBy("Date").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in sides)


def test_split_is_repeatable_and_ignores_row_order(spark):
    df = frame(spark, [7, 30, 9])
    first = {(r.id, r.split) for r in splits.temporal_split(df, 0.3, "Date", KEYS).collect()}
    again = {(r.id, r.split) for r in splits.temporal_split(df.orderBy(F.desc("id")).repartition(5), 0.3, "Date", KEYS).collect()}
    assert first == again


@pytest.mark.parametrize("fetch", [4096, 4])
def test_rows_of_one_key_are_told_apart_by_the_whole_row(spark, fetch, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", fetch)
    df = frame(spark, [100]).withColumns({"v": F.col("id"), "id": F.lit(1)})
    marked = splits.temporal_split(df, 0.2, "Date", KEYS)
    assert marked.where("split = 'train'").count() == 80
    folds = splits.time_series_folds(df, 3, "Date", KEYS).groupBy("block").count().collect()
    assert {r["count"] for r in folds} == {25}
    exact = splits.stratified_split(df, "y", KEYS, 0.2, exact=True)
    assert exact.where("split = 'test'").count() == 20


@pytest.mark.parametrize("fetch", [4096, 4])
def test_rows_alike_in_every_column_go_after_the_cut(spark, fetch, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", fetch)
    same = spark.createDataFrame([(date(2020, 1, 1), 1, 0)] * 10, "Date date, id bigint, y int")
    assert splits.temporal_split(same, 0.2, "Date", KEYS).where("split = 'test'").count() == 10
    copies = frame(spark, [4, 6]).unionByName(frame(spark, [4, 6]))
    train = splits.temporal_split(copies, 0.25, "Date", KEYS).where("split = 'train'")
    assert train.count() in (14, 15) and train.groupBy("id").count().where("count = 1").count() == 0


def test_rows_without_a_date_come_last_and_count(spark):
    df = frame(spark, [1] * 8).unionByName(spark.createDataFrame([(None, 90, 1), (None, 91, 0)], "Date date, id bigint, y int"))
    marked = splits.temporal_split(df, 0.2, "Date", KEYS)
    assert {r.id for r in marked.where("split = 'test'").collect()} == {90, 91}
    half = splits.temporal_split(df, 0.1, "Date", KEYS)
    assert half.where("split = 'test'").count() == 1
    assert splits.temporal_split(df, 0.1, "Date", KEYS, whole_dates=True).where("split = 'test'").count() == 2
    blocks = {r.block: r["count"] for r in splits.time_series_folds(df, 3, "Date", KEYS).groupBy("block").count().collect()}
    assert blocks == {0: 4, 1: 2, 2: 2, 3: 2}


@pytest.mark.parametrize("per_day", [[1] * 11, [2, 40, 3], [43]])
def test_expanding_folds(spark, per_day):
    df = splits.time_series_folds(frame(spark, per_day), 3, "Date", KEYS)
    n = sum(per_day)
    size = n // 4
    counts = {r.block: r["count"] for r in df.groupBy("block").count().collect()}
    assert counts == {0: n - 3 * size, 1: size, 2: size, 3: size}
    dates = df.groupBy("block").agg(F.min("Date").alias("a"), F.max("Date").alias("b")).orderBy("block").collect()
    assert all(x.b <= y.a for x, y in zip(dates, dates[1:]))


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError):
        splits.time_series_folds(frame(spark, [3]), 3, "Date", KEYS)


@pytest.mark.parametrize("fetch", [4096, 4])
def test_exact_stratified(spark, fetch, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", fetch)
    df = splits.stratified_split(frame(spark, [103]), "y", KEYS, 0.2, exact=True)
    counts = {(r.y, r.split): r["count"] for r in df.groupBy("y", "split").count().collect()}
    zeros = sum(n for (y, _), n in counts.items() if y == 0)
    assert counts[(0, "test")] + counts[(1, "test")] == 21
    assert abs(counts[(0, "test")] - zeros * 0.2) < 1


def test_hashed_stratified_depends_on_seed(spark):
    df = frame(spark, [400])
    shares = splits.stratified_split(df, "y", KEYS, 0.2).groupBy("y").agg(
        F.avg((F.col("split") == "test").cast("int")).alias("s")).collect()
    assert all(0.1 < r.s < 0.3 for r in shares)
    one = {r.id for r in splits.stratified_split(df, "y", KEYS, 0.2, seed=1).where("split='test'").collect()}
    two = {r.id for r in splits.stratified_split(df, "y", KEYS, 0.2, seed=2).where("split='test'").collect()}
    assert one != two
