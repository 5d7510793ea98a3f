"""Plans and jobs of the splits: what a filter on the split costs, how many jobs the cuts take."""

from __future__ import annotations

from pyspark.sql import functions as F

from rainloom.operators import cleaning, splits
from rainloom.plans.features import prepare_features
from rainloom.schema import TARGET
from conftest import make_frame, make_rows, replace
from test_splits import KEYS, frame


def test_a_filter_on_the_split_repeats_no_whole_row_digest(spark):
    data = splits.temporal_split(prepare_features(make_frame(spark, make_rows(40)), keep=["Date"]), 0.2)
    plan = data.where("split = 'train'")._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Filter" in line]
    assert sum(line.count("md5(") for line in conditions) <= 1
    assert all("Humidity" not in line[line.find("md5("):].split(")")[0] for line in conditions)


def test_jobs_do_not_grow_with_the_number_of_cuts(spark, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", 4)
    df = frame(spark, [400])

    def jobs(n):
        spark.sparkContext.setJobGroup(f"folds-{n}", "")
        splits.time_series_folds(df, n, "Date", KEYS)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{n}"))
        spark.sparkContext.setJobGroup("", "")
        return found

    assert jobs(24) <= jobs(2) + 4          # at most a further narrowing step


def test_cuts_in_several_days_equal_a_sort(spark, monkeypatch):
    monkeypatch.setattr(splits, "FETCH_LIMIT", 3)
    df = frame(spark, [30, 60, 5, 45])
    ordered = [r["id"] for r in df.orderBy("Date", splits.digest(*KEYS)).collect()]
    folds = splits.time_series_folds(df, 7, "Date", KEYS).groupBy("block").agg(F.collect_set("id").alias("ids")).collect()
    size = 140 // 8
    starts = [0, *[140 - size * k for k in range(7, 0, -1)], 140]
    assert {r["block"]: set(r["ids"]) for r in folds} == {
        b: set(ordered[starts[b]:starts[b + 1]]) for b in range(8)}


def test_target_guard_is_right_under_later_filters(spark):
    rows = replace(make_rows(), 3, RainTomorrow=None)
    coded = cleaning.clean_target(make_frame(spark, rows))
    want = sum(r[-1] == "Yes" for r in rows)
    assert coded.where(F.col(TARGET) == 1).count() == want
    assert coded.where(F.col(TARGET).eqNullSafe(F.lit(None))).count() == 0
    assert coded.count() == len(rows) - 1
