"""The stored ensemble: the same score by expression, flat trees and stream; no Python in the plan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from conftest import make_frame, make_rows, replace
from rainloom.catalog.stored import FEATURES, stored_ensemble
from rainloom.operators import modeling
from rainloom.plans.features import featurize
from rainloom.schema import TARGET


def test_prediction_equals_the_trees_and_needs_no_python(spark):
    rows = replace(replace(make_rows(50), 4, Humidity3pm=None, MaxTemp=None), 7, Rainfall=None, RainToday=None)
    raw = make_frame(spark, rows).drop(TARGET)
    got = modeling.ensemble_predict(raw, stored_ensemble(), digits=None)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    ready = featurize(raw, keep=["Date"]).orderBy("Date").select(*[F.col(c).cast("double") for c in FEATURES]).collect()
    values = np.array([[np.nan if v is None else v for v in r] for r in ready])
    want = 1 / (1 + np.exp(-stored_ensemble().score(values)))
    found = got.orderBy("Date").collect()
    assert np.allclose([r.probability for r in found], want, atol=1e-9)
    assert [r.rain_tomorrow for r in found] == ["Yes" if p >= 0.5 else "No" for p in want]


def test_invalid_dates_and_empty_tables(spark):
    raw = make_frame(spark, replace(make_rows(5), 0, Date="2020-13-01"))
    assert modeling.ensemble_predict(raw, stored_ensemble()).count() == 4
    assert modeling.ensemble_predict(raw.limit(0), stored_ensemble()).columns == ["Date", "Location", "rain_tomorrow", "probability"]


def test_replay_takes_the_latest_version(spark):
    raw = make_frame(spark, make_rows(20)).withColumn("import_date", F.lit("2024-01-01").cast("timestamp"))
    later = raw.limit(2).withColumns({"import_date": F.lit("2024-02-01").cast("timestamp"), TARGET: F.lit("Yes")})
    got = modeling.ensemble_replay(raw.unionByName(later), stored_ensemble())
    assert got.count() == 20
    keys = [(r.Date, r.Location) for r in later.select(F.to_date("Date").alias("Date"), "Location").collect()]
    assert all(r.rain_tomorrow_actual == "Yes" for r in got.collect() if (r.Date, r.Location) in keys)
