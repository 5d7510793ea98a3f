"""Jobs that compose the operators: data preparation, the four training stages, exploration."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from rainloom.operators import explore, metrics as scoring, profile
from rainloom.operators.cleaning import normalise_missing, threshold_label, validate_schema
from rainloom.operators.modeling import RainModel, fit_model, grid_search, load_params, model_columns, save_params
from rainloom.operators.splits import stratified_split, temporal_split
from rainloom.plans.features import prepare_features
from rainloom.schema import DATE, HIGH_MISSING_THRESHOLD, LOCATION, NUMERIC_COLUMNS, TARGET
from rainloom.sources.readers import read_observations
from rainloom.sources.writers import append_metrics, write_predictions, write_report, write_splits


@dataclass
class PreparedData:
    data: DataFrame                   # features, target, keys and ``split`` in one row
    missing_report: DataFrame
    high_missing_columns: list[str]
    numeric_features: list[str]
    categorical_features: list[str]
    key_cols: list[str]

    @property
    def train(self) -> DataFrame:
        return self.data.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.data.where(F.col("split") == "test")


def prepare_data(
    observations: DataFrame, test_size: float = 0.2, seed: int = 42, split_strategy: str = "temporal",
    missing_threshold: float = HIGH_MISSING_THRESHOLD, drop_high_missing: bool = False,
    report_path: str | None = None, key_cols: Sequence[str] = (DATE, LOCATION),
) -> PreparedData:
    """Validate, profile, build features and split. Profiling sees the raw rows, before any is dropped."""
    if split_strategy not in ("temporal", "random"):
        raise ValueError("split_strategy must be 'temporal' or 'random'")
    validate_schema(observations)
    raw = normalise_missing(observations)
    report = profile.missing_report(raw, columns=[c for c in raw.columns if c not in key_cols[2:]])
    high = [r["column"] for r in profile.high_missing_columns(
        raw, missing_threshold, exclude=[TARGET, *[c for c in key_cols if c not in (DATE, LOCATION)]]).collect()]
    if report_path:
        write_report(report, report_path)
    features = prepare_features(raw, high, drop_high_missing, keep=list(key_cols))
    if split_strategy == "temporal":
        data = temporal_split(features, test_size, DATE, key_cols)
    else:
        data = stratified_split(features, TARGET, key_cols, test_size, seed, exact=True)
    numeric, categorical = model_columns(features, TARGET, [c for c in key_cols if c != LOCATION])
    return PreparedData(data, report, high, numeric, categorical, list(key_cols))


def make_dataset(spark: SparkSession, workdir: str, source: str = "csv", key_cols: Sequence[str] = (DATE, LOCATION),
                 split_strategy: str = "temporal", test_size: float = 0.2, **options: Any) -> None:
    """Stage 1: source -> split feature table and missing-value report."""
    observations = read_observations(spark, source, **options)
    prepared = prepare_data(observations, test_size, split_strategy=split_strategy, key_cols=key_cols,
                            report_path=f"{workdir}/missing_values")
    write_splits(prepared.data, f"{workdir}/dataset")


def _side(spark: SparkSession, workdir: str, split: str) -> DataFrame:
    return spark.read.parquet(f"{workdir}/dataset").where(F.col("split") == split).drop("split")


def search_params(spark: SparkSession, workdir: str, key_cols: Sequence[str] = (DATE, LOCATION),
                  grid: dict | None = None) -> dict:
    """Stage 2: best parameters over expanding time windows of the training rows."""
    found = grid_search(_side(spark, workdir, "train"), key_cols, grid)
    save_params(spark, {"params": found.best_params, "cv_f1": found.best_score}, f"{workdir}/best_params")
    return found.best_params


def train_model(spark: SparkSession, workdir: str, key_cols: Sequence[str] = (DATE, LOCATION)) -> RainModel:
    """Stage 3: final fit on all training rows."""
    best = load_params(spark, f"{workdir}/best_params")["params"]
    model = fit_model(_side(spark, workdir, "train"), best, key_cols)
    model.save(spark, f"{workdir}/model")
    return model


def evaluate_model(spark: SparkSession, workdir: str, key_cols: Sequence[str] = (DATE, LOCATION)) -> dict:
    """Stage 4: score the test rows, keep the predictions, log the figures."""
    model = RainModel.load(spark, f"{workdir}/model")
    test = _side(spark, workdir, "test")
    scored = threshold_label(model.transform(test, [*key_cols, TARGET]), label_col="prediction",
                             as_text=False, digits=None)
    write_predictions(scored, f"{workdir}/predictions")
    figures = scoring.score_report(
        spark.read.parquet(f"{workdir}/predictions"), TARGET, "prediction", "probability")
    append_metrics(spark, f"{workdir}/metrics", str(uuid.uuid4()), model.params, figures)
    return figures


def run_training(spark: SparkSession, workdir: str, key_cols: Sequence[str] = (DATE, LOCATION),
                 grid: dict | None = None, **source: Any) -> dict:
    """All four stages, handing over through the work directory."""
    make_dataset(spark, workdir, key_cols=key_cols, **source)
    search_params(spark, workdir, key_cols, grid)
    train_model(spark, workdir, key_cols)
    return evaluate_model(spark, workdir, key_cols)


def exploration_report(
    df: DataFrame, column: str = "MaxTemp", columns: Sequence[str] = tuple(NUMERIC_COLUMNS),
) -> dict[str, DataFrame]:
    """The tables behind the exploration figures."""
    return {
        "target_counts": profile.value_counts(df),
        "rain_rate": profile.rain_rate_topk(df),
        "smoothed_series": explore.rolling_mean(df, column),
        "distributions": explore.histogram(df, columns, 35),
        "density": explore.kde_columns(df, columns),
        "correlations": explore.corr_matrix(df, columns, lower_triangle=True),
        "monthly_boxes": explore.monthly_box_stats(df, column),
        "year_month": explore.year_month_pivot(df, column),
        "monthly_means": explore.monthly_resample(df),
        "missing": profile.missing_pct(df),
    }
