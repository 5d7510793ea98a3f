from __future__ import annotations

import math
from datetime import date

import pytest
from conftest import make_frame, make_rows, replace
from pyspark.sql import functions as F

from rainloom.functions.features import (
    add_cyclical_features, add_temporal_features, add_weather_features, encode_wind_directions,
)
from rainloom.functions.scalars import compass_degrees, to_double
from rainloom.operators import cleaning
from rainloom.plans.features import featurize, prepare_features
from rainloom.schema import OBSERVATION_COLUMNS, RAW_TO_OBSERVATION, TARGET


def test_schema_complete_and_missing(weather):
    cleaning.validate_schema(weather)
    with pytest.raises(ValueError, match="Location.*Rainfall"):
        cleaning.validate_schema(weather.drop("Rainfall", "Location"))


def test_target_is_coded_and_null_rows_go(spark):
    df = make_frame(spark, replace(make_rows(), 0, RainTomorrow=None))
    rows = cleaning.clean_target(df).collect()
    assert len(rows) == 11 and {r[TARGET] for r in rows} == {0, 1}
    assert cleaning.clean_target(df).schema[TARGET].dataType.simpleString() == "int"


def test_unexpected_target_raises(spark):
    df = make_frame(spark, replace(make_rows(), 3, RainTomorrow="Maybe"))
    with pytest.raises(Exception, match="unexpected value in RainTomorrow: Maybe"):
        cleaning.clean_target(df).collect()


def test_rain_today_never_raises(spark):
    df = make_frame(spark, replace(replace(make_rows(), 0, RainToday="odd"), 1, RainToday=None))
    values = [r.RainToday for r in cleaning.encode_rain_today(df).orderBy("Date").collect()]
    assert values[:2] == [None, None] and set(values[2:]) == {0.0, 1.0}


@pytest.mark.parametrize("text,kept", [
    ("2020-02-29", date(2020, 2, 29)), ("2019-02-29", None), ("2020-13-01", None), ("2020-1-5", None), ("", None),
])
def test_dates(spark, text, kept):
    df = spark.createDataFrame([(text,)], "Date string")
    assert cleaning.coerce_date_column(df).first().Date == kept
    assert cleaning.parse_date_column(df).count() == (kept is not None)


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("1.5",), ("NA",), ("",), (None,), ("NaN",)], "x string")
    assert [r[0] for r in df.select(to_double(F.col("x"))).collect()] == [1.5, None, None, None, None]


def test_missing_tokens_and_nan_become_null(spark):
    df = spark.createDataFrame([("NA", float("nan")), ("x", 2.0)], "t string, d double")
    assert [tuple(r) for r in cleaning.normalise_missing(df).collect()] == [(None, None), ("x", 2.0)]


def test_temporal_and_cyclical(weather):
    df = add_cyclical_features(add_temporal_features(cleaning.parse_date_column(weather)))
    for r in df.collect():
        assert (r.Year, r.Month, r.Day, r.DayOfYear) == (r.Date.year, r.Date.month, r.Date.day, r.Date.timetuple().tm_yday)
        for c in ("Month_sin", "Month_cos", "DayOfYear_sin", "DayOfYear_cos"):
            assert -1 <= r[c] <= 1
        assert math.isclose(r.Month_sin, math.sin(2 * math.pi * 3 / 12))


def test_day_366_passes_the_end_of_the_cycle(spark):
    df = spark.createDataFrame([(date(2020, 12, 31),)], "Date date")
    r = add_cyclical_features(add_temporal_features(df)).first()
    assert r.DayOfYear == 366 and math.isclose(r.DayOfYear_sin, math.sin(2 * math.pi * 366 / 365))


def test_compass(spark):
    df = spark.createDataFrame([("N",), ("E",), ("NNW",), ("XX",), (None,)], "d string")
    assert [r[0] for r in df.select(compass_degrees(F.col("d"))).collect()] == [0.0, 90.0, 337.5, None, None]


def test_wind_columns_are_replaced_and_absent_ones_skipped(weather):
    df = encode_wind_directions(weather.drop("WindDir3pm"))
    assert "WindGustDir" not in df.columns and {"WindGustDir_sin", "WindDir9am_cos"} <= set(df.columns)
    assert "WindDir3pm_sin" not in df.columns


def test_weather_features(spark):
    rows = replace(make_rows(), 0, Rainfall=-3.0, Humidity3pm=70.0, WindGustSpeed=50.0)
    rows = replace(rows, 1, Rainfall=None, Humidity3pm=None, WindGustSpeed=None, MinTemp=None)
    got = add_weather_features(make_frame(spark, rows)).orderBy("Date").collect()
    assert got[0].RainfallLog1p == 0.0 and got[0].HasRainfall == 0.0
    assert got[0].HighHumidity3pm == 1.0 and got[0].StrongWindGust == 1.0
    for c in ("RainfallLog1p", "HasRainfall", "HighHumidity3pm", "StrongWindGust", "TempRange"):
        assert got[1][c] is None
    for r in got[2:]:
        assert r.TempRange == r.MaxTemp - r.MinTemp
        assert r.HumidityDrop == r.Humidity9am - r.Humidity3pm
        assert r.WindSpeedChange == r.WindSpeed3pm - r.WindSpeed9am


def test_prepared_columns(weather):
    df = prepare_features(weather)
    features, target = cleaning.split_features_target(df)
    assert TARGET not in features.columns and target.columns == [TARGET]
    numeric, categorical = cleaning.identify_feature_types(features)
    assert len(numeric) == 40 and categorical == ["Location"]
    assert "Date" not in df.columns and df.count() == 12


def test_prepare_is_one_narrow_stage(weather):
    plan = prepare_features(weather)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_audit_columns_never_become_features(weather):
    audited = weather.withColumns({"import_run_id": F.lit("r"), "source_file": F.lit("f"), "id": F.lit(1)})
    for df in (prepare_features(audited), featurize(audited)):
        assert not {"import_run_id", "source_file", "id"} & set(df.columns)


def test_drop_high_missing_scenario(weather):
    kept = prepare_features(weather, ["Sunshine", TARGET], drop_high_missing=True)
    assert "Sunshine" not in kept.columns and TARGET in kept.columns
    assert "Sunshine" in prepare_features(weather, ["Sunshine"]).columns


def test_featurize_equals_training_chain(weather):
    text = weather.select(*[F.col(c).cast("string") for c in weather.columns])
    left = featurize(text)
    right = prepare_features(weather).drop(TARGET)
    assert set(left.columns) == set(right.columns)
    assert left.select(*right.columns).exceptAll(right).count() == 0


def test_raw_names_and_texts_to_observations(weather):
    raw = weather.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c.lower()) for c in weather.columns])
    df = cleaning.raw_to_observations(raw.withColumn("id", F.lit(1)))
    assert df.columns == OBSERVATION_COLUMNS == list(RAW_TO_OBSERVATION.values())
    assert df.schema["Date"].dataType.simpleString() == "date"
    assert df.schema["MinTemp"].dataType.simpleString() == "double"


def test_threshold_before_rounding(spark):
    df = spark.createDataFrame([(0.49999,), (0.5,)], "probability double")
    rows = cleaning.threshold_label(df).collect()
    assert [(r.rain_tomorrow, r.probability) for r in rows] == [("No", 0.5), ("Yes", 0.5)]


def test_lookup_checks():
    cleaning.check_lookup("Rainfall", "2020-01-01")
    assert len(cleaning.lookup_features()) == 12
    with pytest.raises(ValueError):
        cleaning.check_lookup("Rainfall; drop table x", "2020-01-01")
    with pytest.raises(ValueError):
        cleaning.check_lookup("Rainfall", "01/02/2020")
