from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rainloom.operators import modeling, prepare
from rainloom.operators.prepare import imputation
from rainloom.operators.prepare.preparation import Preparation, fit_preparation
from rainloom.operators.splits import temporal_split
from rainloom.plans.features import prepare_features
from rainloom.schema import TARGET
from rainloom.streaming import stream_score

KEYS = ["Date", "Location"]


def numbers(spark, n=1500, holes=0.25, seed=0):
    """Correlated columns, one an exact difference of two others, with holes; and the full truth."""
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, 2))
    full = np.column_stack([
        10 + base[:, 0], 20 + 2 * base[:, 0] + base[:, 1], base @ [1.0, -1.0] * 5 + random.normal(size=n) * 0.2])
    full = np.column_stack([full, full[:, 1] - full[:, 0], random.normal(size=n)])
    seen = full.copy()
    seen[random.random(full.shape) < holes] = np.nan
    seen[np.isnan(seen[:, 0]) | np.isnan(seen[:, 1]), 3] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(seen)]
    names = ["a", "b", "c", "d", "e"]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names)), names, full, seen


def filled(df, names):
    return np.array([[r[c] for c in names] for r in df.orderBy("id").collect()], dtype=float)


@pytest.mark.parametrize("driver_patterns", [2000, 1])
def test_imputer_beats_the_mean_and_keeps_known_cells(spark, driver_patterns):
    df, names, full, seen = numbers(spark)
    fitted = prepare.fit_gaussian_imputer(df, names, driver_patterns=driver_patterns)
    got = filled(fitted.transform(df), names)
    known = ~np.isnan(seen)
    assert not np.isnan(got).any() and (got[known] == seen[known]).all()
    mean = filled(prepare.mean_impute(df, names), names)
    hidden = ~known

    def error(x):
        return np.sqrt((((x - full) / full.std(axis=0)) ** 2)[hidden].mean())

    assert error(got) < 0.65 * error(mean)
    assert fitted.incomplete == names


def test_both_iteration_paths_agree(spark, monkeypatch):
    df, names, _, _ = numbers(spark, 400)
    one = prepare.fit_gaussian_imputer(df, names, driver_patterns=2000)
    monkeypatch.setattr(imputation, "TASK_PATTERNS", 2)      # partial sums leave the task early
    two = prepare.fit_gaussian_imputer(df.repartition(16), names, driver_patterns=1)
    np.testing.assert_allclose(one.mean, two.mean, atol=1e-9)
    np.testing.assert_allclose(one.cov, two.cov, atol=1e-9)
    assert one.iterations == two.iterations


def test_imputer_matches_a_direct_em(spark):
    """The pattern sums give the same step as completing every row."""
    df, names, _, seen = numbers(spark, 300)
    fitted = prepare.fit_gaussian_imputer(df, names, max_iter=3, tol=0.0)
    x = (seen - np.nanmean(seen, axis=0)) / np.nanstd(seen, axis=0)
    mean, cov = np.zeros(5), np.eye(5)
    for _ in range(3):
        rows, extra = [], np.zeros((5, 5))
        for r in x:
            m = np.isnan(r)
            full = r.copy()
            if m.any():
                weights, left = imputation._conditional(m, mean, cov)
                full[m] = mean[m] + weights @ (r[~m] - mean[~m])
                extra[np.ix_(m, m)] += left
            rows.append(full)
        done = np.array(rows)
        mean = done.mean(axis=0)
        cov = (done.T @ done + extra) / len(done) - np.outer(mean, mean)
    np.testing.assert_allclose(fitted.mean, mean, atol=1e-8)
    np.testing.assert_allclose(fitted.cov, cov, atol=1e-8)


def test_imputer_with_nothing_missing_or_everything(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (3, None, None)], "id int, a double, b double")
    got = filled(prepare.fit_gaussian_imputer(df, ["a", "b"]).transform(df), ["a", "b"])
    assert not np.isnan(got).any() and got[2, 0] == pytest.approx(1.5)


def test_robust_scale_leaves_constant_spread(spark):
    df = spark.createDataFrame([(float(i), 5.0, float(i == 0)) for i in range(9)], "a double, b double, f double")
    fitted = prepare.fit_robust_scale(df, ["a", "b"], {"f": 1}, 9)
    assert fitted.centre == [4.0, 5.0, 0.0] and fitted.scale == [4.0, 1.0, 1.0]
    assert [r.b for r in fitted.transform(df).collect()] == [0.0] * 9


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", None), ("a", None), (None, None)], "p string, q string")
    got = {r["column"]: r["value"] for r in prepare.most_frequent(df, ["p", "q"]).collect()}
    assert got == {"p": "a", "q": "x"}
    assert prepare.mode_impute(df, ["p"]).where("p = 'a'").count() == 3


def shrunk(y, all_y):
    n, mean, overall = len(y), np.mean(y), np.mean(all_y)
    weight = n * np.var(all_y) / (np.var(y) + n * np.var(all_y))
    return weight * mean + (1 - weight) * overall


def encoded_rows(spark):
    random = np.random.default_rng(4)
    return [(i, "abc"[int(random.integers(0, 3))], int(random.random() < 0.4)) for i in range(200)]


def test_target_encoding(spark):
    rows = encoded_rows(spark)
    df = spark.createDataFrame(rows, "id int, k string, y int")
    table, overall = prepare.fit_target_encoding(df, "k", "y")
    unseen = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None)], "id int, k string")
    got = {r.k: r.k_encoded for r in prepare.target_encode(unseen, table, "k", overall).collect()}
    ys = [y for _, _, y in rows]
    assert got["a"] == pytest.approx(shrunk([y for _, k, y in rows if k == "a"], ys))
    assert got["zzz"] == got[None] == pytest.approx(np.mean(ys))


def test_out_of_fold_encoding_never_sees_its_own_fold(spark):
    rows = encoded_rows(spark) + [(999, "only", 1)]
    df = spark.createDataFrame(rows, "id int, k string, y int")
    fold = {r.id: r.f for r in df.select("id", prepare.encoding.encoding_fold(["id"]).alias("f")).collect()}
    got = {r.id: r.k_encoded for r in prepare.target_encode_oof(df, "k", "y", ["id"]).collect()}
    for i, k, _ in rows:
        rest = [(kk, y) for j, kk, y in rows if fold[j] != fold[i]]
        same = [y for kk, y in rest if kk == k]
        ys = [y for _, y in rest]
        want = shrunk(same, ys) if same else np.mean(ys)
        assert got[i] == pytest.approx(want)
    assert len(got) == len(rows)


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    fitted = prepare.fit_one_hot(df, ["k"])
    got = {r.k: r.v for r in fitted.transform(spark.createDataFrame([("a",), ("c",), ("new",)], "k string")).select(
        "k", vector_to_array("k_onehot").alias("v")).collect()}
    assert got == {"a": [1.0, 0.0, 0.0], "c": [0.0, 0.0, 1.0], "new": [0.0, 0.0, 0.0]}


def observations(spark, n=600):
    """Observations whose target depends on humidity, with holes and two stations."""
    from conftest import make_frame, make_rows
    from rainloom.schema import OBSERVATION_COLUMNS

    random = np.random.default_rng(8)
    rows = []
    for i, r in enumerate(make_rows(n, seed=9)):
        cells = dict(zip(OBSERVATION_COLUMNS, r))
        cells["Date"] = (date(2018, 1, 1) + timedelta(days=i)).isoformat()
        cells["RainTomorrow"] = "Yes" if cells["Humidity3pm"] + random.normal() * 8 > 60 else "No"
        for c in ("Sunshine", "Cloud3pm", "MinTemp"):
            if random.random() < 0.2:
                cells[c] = None
        rows.append(tuple(cells[c] for c in OBSERVATION_COLUMNS))
    return make_frame(spark, rows)


@pytest.fixture(scope="module")
def fitted(spark):
    raw = observations(spark)
    data = temporal_split(prepare_features(raw, keep=["Date"]), 0.2, "Date", KEYS)
    train, test = (data.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return raw, train, test, modeling.fit_model(train, {"n_estimators": 6, "num_leaves": 7}, KEYS)


def test_preparation_learns_from_training_rows_only(spark, fitted, tmp_path):
    _, train, test, _ = fitted
    numeric, categorical = modeling.model_columns(train)
    prep, ready = fit_preparation(train, numeric, categorical, TARGET, KEYS)
    assert len(numeric) == 40 and categorical == ["Location"]
    assert ready.count() == train.count()
    size = len(ready.first().features)
    assert size == len(prep.feature_names) == 40 + len(prep.imputer.incomplete) + 1
    assert "Sunshine" in prep.imputer.incomplete
    # statistics do not move when other test rows are used, and survive storage
    prep.save(spark, str(tmp_path / "prep"))
    loaded = Preparation.load(spark, str(tmp_path / "prep"))
    changed = test.withColumn("Humidity3pm", F.lit(1e6))
    one, two = prep.transform(changed, KEYS), loaded.transform(changed, KEYS)
    assert one.exceptAll(two).count() == 0 and one.count() == test.count()
    values = np.array([r.features.toArray() for r in ready.collect()])
    assert np.isfinite(values).all()


def test_other_categoricals_become_indicators(spark, fitted):
    _, train, _, _ = fitted
    extra = train.withColumn("Season", F.when(F.col("Month") < 7, "cold").otherwise("warm"))
    numeric, categorical = modeling.model_columns(extra)
    prep, ready = fit_preparation(extra, numeric, categorical, TARGET, KEYS)
    unknown = prep.transform(extra.withColumn("Season", F.lit("never")), KEYS).first().features.toArray()
    assert list(unknown[-2:]) == [0.0, 0.0] and ready.first().features.toArray()[-2:].sum() == 1.0


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "RainTomorrow int")
    got = {r.RainTomorrow: r.weight for r in modeling.class_weights(df).collect()}
    assert got == {0: 8 / 12, 1: 8 / 4}


def test_depth_for_leaves():
    assert [modeling.depth_for_leaves(n) for n in (2, 31, 32, 63)] == [1, 5, 5, 6]


def test_model_scores_save_and_load(spark, fitted, tmp_path):
    from rainloom.operators.cleaning import threshold_label
    from rainloom.operators.metrics import score_report

    raw, _, test, model = fitted
    scored = threshold_label(model.transform(test, [*KEYS, TARGET]), label_col="p", as_text=False, digits=None)
    figures = score_report(scored, TARGET, "p", "probability")
    assert figures["roc_auc"] > 0.8 and figures["f1"] > 0.5
    model.save(spark, str(tmp_path / "m"))
    loaded = modeling.RainModel.load(spark, str(tmp_path / "m"))
    assert loaded.params == model.params
    one, two = modeling.batch_predict(raw, model), modeling.batch_predict(raw, loaded)
    assert one.columns == ["Date", "Location", "rain_tomorrow", "probability"]
    assert one.count() == 600 and one.exceptAll(two).count() == 0


def test_invalid_dates_are_not_scored(spark, fitted):
    raw, _, _, model = fitted
    odd = raw.limit(5).withColumn("Date", F.lit("2020-13-01"))
    assert modeling.batch_predict(odd, model).count() == 0


def test_replay_shows_the_actual_outcome(spark, fitted):
    raw, _, _, model = fitted
    stored = raw.withColumn("import_date", F.lit("2024-01-01").cast("timestamp"))
    later = stored.limit(3).withColumns({
        "import_date": F.lit("2024-02-01").cast("timestamp"), TARGET: F.lit("Yes")})
    got = modeling.replay_predict(stored.unionByName(later), model)
    assert got.count() == 600
    assert {c for c in got.columns} == {*KEYS, "rain_tomorrow_pred", "probability", "rain_tomorrow_actual"}
    again = got.join(later.select(F.to_date("Date").alias("Date"), "Location"), KEYS).collect()
    assert len(again) == 3 and all(r.rain_tomorrow_actual == "Yes" for r in again)


def test_stream_and_batch_scores_agree(spark, fitted, tmp_path):
    raw, _, _, model = fitted
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_score(arriving, model, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stream = spark.read.parquet(str(tmp_path / "out"))
    batch = modeling.batch_predict(raw, model)
    assert stream.count() == 600 and stream.exceptAll(batch).count() == 0


def test_search_picks_the_first_best(spark, fitted):
    _, train, _, _ = fitted
    found = modeling.grid_search(train, KEYS, {"n_estimators": [1, 3], "num_leaves": [3]}, max_iter=2)
    rows = found.scores.collect()
    assert len(rows) == 6 and {r.fold for r in rows} == {1, 2, 3}
    means = {r.candidate: r.mean_f1 for r in rows}
    best = min(c for c in means if means[c] == max(means.values()))
    assert found.best_params["n_estimators"] == [1, 3][best] and found.best_score == means[best]


def test_fits_leave_no_scratch_tables(spark, tmp_path, monkeypatch):
    import os

    from rainloom import session

    base = str(tmp_path / "scratch")
    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: f"{base}/{name}-{os.urandom(6).hex()}")
    for module in ("modeling",):
        monkeypatch.setattr(f"rainloom.operators.{module}.scratch_dir", session.scratch_dir)
    raw = observations(spark, 240)
    data = temporal_split(prepare_features(raw, keep=["Date"]), 0.2, "Date", KEYS)
    train = data.where("split = 'train'").drop("split")
    found = modeling.grid_search(train, KEYS, {"n_estimators": [2], "num_leaves": [7]}, n_splits=2, max_iter=2)
    assert found.scores.count() == 2
    assert not [f for f in os.listdir(base) if not f.startswith("trees")]
    model = modeling.fit_model(train, {"n_estimators": 2, "num_leaves": 7}, KEYS, max_iter=2)
    left = [f for f in os.listdir(base) if not f.startswith("trees")]
    assert len(left) == 1 and left[0].startswith("categories")
    assert model.transform(data.where("split = 'test'"), ["Date"]).count() == 48


def test_unfitted_preprocessor_is_stored_and_fitted(spark, tmp_path):
    from rainloom.operators import prepare

    plan = prepare.build_preprocessor(["MinTemp", "Humidity3pm"], ["Location"], ["Date", "Location"], max_iter=2)
    plan.save(spark, f"{tmp_path}/plan")
    again = prepare.Preprocessor.load(spark, f"{tmp_path}/plan")
    assert again == plan
    raw = observations(spark, 120)
    features = prepare_features(raw, keep=["Date"])
    fitted_, ready = again.fit(features)
    assert ready.count() == 120 and fitted_.transform(features, ["Date"]).columns == ["Date", "features"]


def test_nan_counts_as_missing_when_fitting(spark):
    from rainloom.operators import prepare

    values = [float("nan") if i % 3 == 0 else float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v == v]
    scale = prepare.fit_robust_scale(df, ["x"])
    low, middle, high = np.percentile(known, [25, 50, 75])
    assert scale.centre == [middle] and scale.scale == [pytest.approx(high - low)]
    filled = [r.x for r in prepare.mean_impute(df, ["x"]).collect()]
    assert filled[0] == pytest.approx(np.mean(known)) and not np.isnan(filled).any()


def test_registered_fits_are_whole(spark, monkeypatch):
    """``train_score`` and ``grid_search`` fit the published numbers of trees and leaves."""
    from rainloom.catalog import queries

    class Seen(Exception):
        pass

    def seen(train, *given, **named):
        raise Seen(given, named)

    monkeypatch.setattr(queries, "_split_features", lambda spark, sf_dir: (None, None))
    monkeypatch.setattr(modeling, "fit_model", seen)
    monkeypatch.setattr(modeling, "grid_search", seen)
    with pytest.raises(Seen) as fit:
        queries.train_score(spark, "")
    assert fit.value.args[0][0] == {"n_estimators": 100, "num_leaves": 31}
    with pytest.raises(Seen) as search:
        queries.grid_search(spark, "")
    given, named = search.value.args
    assert given[1:] == () and named == {}                # the published grid, all rounds of the imputer
    assert modeling.SEARCH_GRID == {"n_estimators": [100, 200], "num_leaves": [31, 63]}


def test_candidates_that_share_a_fit(spark):
    grid = [{"n_estimators": n, "num_leaves": k} for n in (2, 5) for k in (3, 4)] + [{"n_estimators": 2, "growth": "depth"}, {"n_estimators": 3, "growth": "depth"}]
    assert modeling._shared_fits(grid) == [[0, 2], [1, 3], [4], [5]]
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    from pyspark.ml.linalg import Vectors

    ready = spark.createDataFrame([(Vectors.dense(r), int(r[0] + r[1] ** 2 > 0.5)) for r in x], ["features", "RainTomorrow"])
    few, many = (modeling.train_classifier(ready, n_estimators=n, num_leaves=3) for n in (2, 5))
    assert many.first_trees(2).ensemble == few.ensemble
