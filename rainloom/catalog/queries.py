"""Every registered query: (spark, table directory) -> DataFrame over the whole tables.

Floating-point results are rounded here, at the very end, so that two engines can be compared.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rainloom.catalog.derived import ID, KEYS, observations
from rainloom.catalog.stored import FEATURES as STORED_FEATURES, stored_ensemble
from rainloom.functions.features import (
    CYCLICAL_FEATURES, TEMPORAL_FEATURES, WEATHER_FEATURES, add_cyclical_features,
    add_temporal_features, add_weather_features, encode_wind_directions,
)
from rainloom.operators import cleaning, explore, metrics, modeling, prepare, profile, splits, versions
from rainloom.plans.features import featurize, prepare_features
from rainloom.plans.ingest import import_run, ingest_files, ingest_frame
from rainloom.plans.training import prepare_data
from rainloom.schema import (
    IMPORT_RUN_ID, NUMERIC_COLUMNS, OBSERVATION_COLUMNS, TARGET, WIND_COLUMNS,
)
from rainloom.session import materialize, plain_planning, scratch_dir, tune
from rainloom.sources import readers, tables, writers
from rainloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
IMPORT_MOMENT = datetime(2024, 5, 1, 6, 30, tzinfo=timezone.utc)
WIND_FEATURES = [f"{c}_{f}" for c in WIND_COLUMNS for f in ("sin", "cos")]
CHAINED_PAIR = ["MinTemp", "MaxTemp"]
#: what ``train_score`` fits: the first parameters of the published grid
PUBLISHED = {c: values[0] for c, values in modeling.SEARCH_GRID.items()}
#: the small model whose scores the prediction queries show
QUICK = {"n_estimators": 5, "num_leaves": 31}


def register(query: Query) -> Query:
    """Register under the function name; a trailing underscore avoids hiding an imported name."""
    @functools.wraps(query)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__.rstrip("_")] = tuned
    return query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, halves away from zero as in the checking engine; no negative zero.

    Plain arithmetic stays in generated code, unlike the decimal arithmetic of ``round``.
    """
    unit = float(10 ** digits)
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    steps = {c: F.signum(c) * F.floor(F.abs(F.col(c)) * unit + 0.5) for c in doubles}
    return df.withColumns({c: n / unit + 0.0 for c, n in steps.items()}) if doubles else df


def _orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text cells with missing-value tokens, the shape of an incoming file."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) as o_orderkey",
        "case when o_custkey % 9 = 1 then 'NA' when o_custkey % 9 = 2 then '' else o_orderstatus end as o_orderstatus",
        "case when o_custkey % 7 = 1 then 'NA' else cast(o_totalprice as string) end as o_totalprice",
        "case when o_custkey % 8 = 1 then '2020-13-01' else date_format(o_orderdate, 'yyyy-MM-dd') end as o_orderdate",
    )


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "orders-csv")
    _orders_text(spark, sf_dir).write.option("header", True).csv(path)
    return path


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import versions of (date, location): import day from the line number, file from the status."""
    obs = observations(spark, sf_dir, "import_day", "status")
    return obs.withColumns({
        "import_date": F.timestamp_add("DAY", F.col("import_day"), F.lit(IMPORT_MOMENT)),
        "source_file": F.concat("status", F.lit(".csv")),
    })


def _labelled(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return cleaning.clean_target(observations(spark, sf_dir, *extra))


# ---- sources and the raw table ---------------------------------------------------------------

@register
def scan_csv(spark, sf_dir):
    return rounded(readers.read_csv(spark, _orders_csv(spark, sf_dir), ["o_totalprice"], "o_orderdate"))


@register
def scan_csv_mixed_headers(spark, sf_dir):
    """Files whose headers name the same columns in different orders."""
    base, orders = scratch_dir(spark, "orders-mixed"), _orders_text(spark, sf_dir)
    names = orders.columns
    for part, order in enumerate((names, names[::-1], [*names[2:], *names[:2]])):
        rows = orders.where(F.col("o_orderkey").cast("bigint") % 3 == part).select(*order)
        rows.write.option("header", True).csv(f"{base}/part={part}")
    files = readers.read_csv(spark, f"{base}/part=*", ["o_totalprice"], "o_orderdate")
    return rounded(files.select(*names))


@register
def scan_raw_strings(spark, sf_dir):
    return readers.read_raw_text(spark, _orders_csv(spark, sf_dir)).drop("o_totalprice")


@register
def scan_json(spark, sf_dir):
    path = scratch_dir(spark, "orders-json")
    record = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
    ])
    names = record.fieldNames()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*names)
    one, texts = F.struct(*names), F.struct(*[F.col(c).cast("string").alias(c) for c in names])
    # numbers as numbers and as text, single records and lists
    wrapped = F.to_json(F.struct(F.array(texts).alias("data")))
    document = F.when(F.col("o_orderkey") % 2 == 0, wrapped).otherwise(F.to_json(one))
    orders.select(document.alias("value")).write.text(path)
    return rounded(readers.read_json(spark, path, record, multi_line=False))


@register
def scan_table(spark, sf_dir):
    path = scratch_dir(spark, "raw")
    text = observations(spark, sf_dir).select(
        *[F.col(c).cast("string").alias(c.lower()) for c in OBSERVATION_COLUMNS], *ID)
    tables.append_raw(tables.with_audit_columns(text, IMPORT_MOMENT, "run-1", "lineitem"), path)
    return rounded(readers.read_table(spark, path=path, keep=ID))


@register
def rename_project(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return rounded(versions.rename_project(tables.normalize_columns(obs)))


@register
def ingest_append(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    text = observations(spark, sf_dir, "status").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c.lower()) for c in OBSERVATION_COLUMNS],
        F.concat("status", F.lit(".csv")).alias("file"))
    for run in ("run-1", "run-2"):
        ingest_frame(tables.with_audit_columns(text, IMPORT_MOMENT, run, F.col("file")).drop("file"), path)
    return tables.read_raw_table(spark, path).groupBy(IMPORT_RUN_ID, "source_file").agg(
        F.count(F.lit(1)).alias("rows_imported"),
        F.count_if(F.col("rainfall") == "NA").alias("na_cells"),
        F.countDistinct("location").alias("stations"),
    )


@register
def audit_columns(spark, sf_dir):
    audited = tables.with_audit_columns(observations(spark, sf_dir), IMPORT_MOMENT, "run-1", "lineitem")
    return audited.select(*ID, F.date_format("import_date", "yyyy-MM-dd HH:mm:ss").alias("import_date"),
                          IMPORT_RUN_ID, "source_file")


@register
def normalize_columns(spark, sf_dir):
    odd = observations(spark, sf_dir).select(
        F.col("order_key").alias(" Order Key "), F.col("line_no").alias("Line No"),
        F.col("part_key").alias("PART_KEY"), F.col("MaxTemp").alias("MaxTemp "))
    return rounded(tables.normalize_columns(odd))


@register
def import_stats(spark, sf_dir):
    seen = _versions(spark, sf_dir).withColumn(
        IMPORT_RUN_ID, F.concat(F.lit("run-"), F.col("import_day").cast("string")))
    return profile.import_stats(seen)


@register
def ingest_job(spark, sf_dir):
    base = scratch_dir(spark, "ingest")
    record = ingest_files(spark, _orders_csv(spark, sf_dir), f"{base}/bronze", f"{base}/log", f"{base}/archive")
    if record["status"] != "success":
        raise RuntimeError(record["error"])
    seen = tables.read_raw_table(spark, f"{base}/bronze", f"{base}/log")
    return seen.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows_imported"))


@register
def stream_ingest(spark, sf_dir):
    base = scratch_dir(spark, "stream")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    query = jobs.stream_ingest(spark, _orders_csv(spark, sf_dir), f"{base}/bronze", f"{base}/checkpoint", f"{base}/log",
                               columns=columns, run_id="run-1")
    query.awaitTermination()
    seen = tables.read_raw_table(spark, f"{base}/bronze", f"{base}/log").withColumn(IMPORT_RUN_ID, _without_batch())
    return seen.groupBy(IMPORT_RUN_ID, "o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows_imported"), F.count_if(F.col("o_totalprice") == "NA").alias("na_cells"))


def _without_batch():
    """The run of a stream without the number of its batch."""
    return F.regexp_replace(IMPORT_RUN_ID, "-[0-9]{6}$", "")


@register
def ingest_mixed(spark, sf_dir):
    """A batch and a stream import into one table, read through the log, with the log's counts."""
    base = scratch_dir(spark, "mixed")
    run = import_run(spark, _orders_csv(spark, sf_dir), f"{base}/bronze", f"{base}/log", "batch")
    if run["status"] != "success":
        raise RuntimeError(run["error"])
    jobs.stream_ingest(spark, _orders_csv(spark, sf_dir), f"{base}/bronze", f"{base}/checkpoint", f"{base}/log",
                       run_id="stream").awaitTermination()
    logged = tables.read_import_log(spark, f"{base}/log").groupBy(F.regexp_replace("run_id", "-[0-9]{6}$", "").alias(IMPORT_RUN_ID)).agg(
        F.sum("rows_imported").alias("rows_logged"), F.sum("rows_rejected").alias("rows_rejected"))
    seen = tables.read_raw_table(spark, f"{base}/bronze", f"{base}/log").withColumn(IMPORT_RUN_ID, _without_batch())
    return seen.groupBy(IMPORT_RUN_ID).agg(F.count(F.lit(1)).alias("rows_visible")).join(logged, IMPORT_RUN_ID)


# ---- cleaning --------------------------------------------------------------------------------

@register
def clean_target(spark, sf_dir):
    return cleaning.clean_target(observations(spark, sf_dir).select(*ID, TARGET))


@register
def encode_rain_today(spark, sf_dir):
    return cleaning.encode_rain_today(observations(spark, sf_dir).select(*ID, "RainToday"))


@register
def parse_date(spark, sf_dir):
    obs = observations(spark, sf_dir, "date_text").select(*ID, "date_text")
    # every third text carries a time of day
    timed = F.concat("date_text", F.when(F.col("order_key") % 2 == 0, " 09:30:00").otherwise("T09:30:00Z"))
    text = F.when((F.col("order_key") % 3 == 0) & F.col("date_text").rlike("^[0-9]"), timed).otherwise(F.col("date_text"))
    return cleaning.parse_date_column(obs.withColumn("date_text", text), "date_text")


@register
def coerce_numeric(spark, sf_dir):
    return cleaning.coerce_numeric(observations(spark, sf_dir, "rain_text").select(*ID, "rain_text"), ["rain_text"])


@register
def drop_high_missing(spark, sf_dir):
    obs = observations(spark, sf_dir)
    high = [r["column"] for r in profile.high_missing_columns(obs, exclude=[TARGET, *ID]).collect()]
    return rounded(cleaning.drop_high_missing_columns(obs, high))


@register
def threshold_label(spark, sf_dir):
    scored = observations(spark, sf_dir, "score").select(*ID, F.col("score").alias("probability"))
    return rounded(cleaning.threshold_label(scored))


@register
def preview(spark, sf_dir):
    return rounded(profile.preview(observations(spark, sf_dir).select(*KEYS, "MaxTemp", "Rainfall"), KEYS, 50))


@register
def sample_rows(spark, sf_dir):
    return rounded(profile.sample_rows(observations(spark, sf_dir).select(*KEYS, "MaxTemp"), KEYS, 20))


@register
def station_list(spark, sf_dir):
    return profile.station_list(observations(spark, sf_dir))


# ---- profile ---------------------------------------------------------------------------------

@register
def missing_report(spark, sf_dir):
    return rounded(profile.missing_report(observations(spark, sf_dir), OBSERVATION_COLUMNS))


@register
def high_missing_columns(spark, sf_dir):
    return rounded(profile.high_missing_columns(observations(spark, sf_dir), exclude=[TARGET, *ID]))


@register
def missing_pct(spark, sf_dir):
    return rounded(profile.missing_pct(observations(spark, sf_dir), OBSERVATION_COLUMNS))


@register
def last_import(spark, sf_dir):
    return profile.last_import(_versions(spark, sf_dir)).withColumn(
        "import_date", F.date_format("import_date", "yyyy-MM-dd HH:mm:ss"))


@register
def overview_kpis(spark, sf_dir):
    return rounded(profile.overview_kpis(observations(spark, sf_dir)))


@register
def rain_rate_topk(spark, sf_dir):
    return rounded(profile.rain_rate_topk(observations(spark, sf_dir)))


@register
def value_counts(spark, sf_dir):
    return profile.value_counts(observations(spark, sf_dir))


@register
def class_distribution(spark, sf_dir):
    data = splits.temporal_split(_labelled(spark, sf_dir), tie_cols=KEYS)
    return rounded(profile.class_distribution(data))


@register
def split_counts(spark, sf_dir):
    return profile.split_counts(splits.temporal_split(_labelled(spark, sf_dir), tie_cols=KEYS))


# ---- what is written and read back -----------------------------------------------------------

@register
def report_top10(spark, sf_dir):
    """The written report's ten columns with most missing cells."""
    path = scratch_dir(spark, "report")
    writers.write_report(profile.missing_report(observations(spark, sf_dir), OBSERVATION_COLUMNS), path)
    back = spark.read.option("header", True).csv(path).select(
        "column", "dtype", F.col("missing_count").cast("bigint").alias("missing_count"), F.col("unique_values").cast("bigint").alias("unique_values"))
    return back.orderBy(F.desc("missing_count"), "column").limit(10)


@register
def persisted_splits(spark, sf_dir):
    """Splits written apart; the test side read without the other."""
    path = scratch_dir(spark, "splits")
    writers.write_splits(splits.temporal_split(_labelled(spark, sf_dir), tie_cols=KEYS), path)
    return spark.read.parquet(path).where("split = 'test'").select(*KEYS, TARGET)


@register
def metrics_log(spark, sf_dir):
    """Figures of a run appended to the log and read back."""
    path = scratch_dir(spark, "metrics")
    figures = metrics.confusion_metrics(_scored(spark, sf_dir), "label", "prediction").first().asDict()
    writers.append_metrics(spark, path, "run-1", {"threshold": 0.5}, figures)
    names = ["tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"]
    return rounded(readers.read_metrics(spark, path).select(*names))


@register
def predictions_csv(spark, sf_dir):
    """Scored rows with their keys, written as CSV and read back."""
    path = scratch_dir(spark, "predictions")
    scored = observations(spark, sf_dir, "score").select(*ID, F.col("score").alias("probability"))
    writers.write_predictions(cleaning.threshold_label(scored), path, "csv")
    keys = ", ".join(f"{c} {scored.schema[c].dataType.simpleString()}" for c in ID)
    back = spark.read.schema(f"{keys}, probability double, rain_tomorrow string").option("header", True).csv(path)
    return rounded(back)


@register
def drop_unused(spark, sf_dir):
    """Date and audit columns of either naming go."""
    audited = tables.with_audit_columns(observations(spark, sf_dir), IMPORT_MOMENT, "run-1", "lineitem")
    audited = audited.withColumns({"run_id": F.lit("r"), "data_source": F.lit("d"), "date_import": F.lit("x")})
    return rounded(cleaning.drop_unused_columns(audited))


@register
def scan_series(spark, sf_dir):
    """Date-keyed measures from text files."""
    series = readers.read_series(spark, _orders_csv(spark, sf_dir), ["o_totalprice"], "o_orderdate")
    return rounded(series.select("o_orderkey", "o_totalprice", "o_orderdate"))


# ---- exploration -----------------------------------------------------------------------------

@register
def corr_matrix(spark, sf_dir):
    return rounded(explore.corr_matrix(observations(spark, sf_dir)))


@register
def histogram(spark, sf_dir):
    return rounded(explore.histogram(observations(spark, sf_dir), ["Humidity3pm", "MaxTemp", "Rainfall"], 40))


@register
def kde(spark, sf_dir):
    return rounded(explore.kde(observations(spark, sf_dir), "Humidity3pm"))


@register
def monthly_box_stats(spark, sf_dir):
    return rounded(explore.monthly_box_stats(observations(spark, sf_dir)))


@register
def year_month_pivot(spark, sf_dir):
    return rounded(explore.year_month_pivot(observations(spark, sf_dir)))


@register
def monthly_resample(spark, sf_dir):
    return rounded(explore.monthly_resample(observations(spark, sf_dir)))


@register
def rolling_mean_7(spark, sf_dir):
    return rounded(explore.rolling_mean(observations(spark, sf_dir)))


# ---- versions and splits ---------------------------------------------------------------------

@register
def latest_observation(spark, sf_dir):
    seen = _versions(spark, sf_dir)
    return rounded(versions.latest_observation(
        seen, ["Date", "Location"], tie_cols=ID, columns=[*OBSERVATION_COLUMNS, *ID]))


@register
def feature_lookup(spark, sf_dir):
    return rounded(versions.feature_lookup(_versions(spark, sf_dir), "Rainfall", ["Date", "Location"], tie_cols=ID))


@register
def temporal_split_duplicates(spark, sf_dir):
    """A cut among rows of which many share the key (date, location)."""
    rows = observations(spark, sf_dir).select("Date", "Location", *ID)
    return splits.temporal_split(rows, 0.2, "Date", ["Date", "Location"])


@register
def temporal_split(spark, sf_dir):
    return splits.temporal_split(observations(spark, sf_dir), tie_cols=KEYS).select(*KEYS, "split")


@register
def temporal_split_whole_dates(spark, sf_dir):
    return splits.temporal_split(observations(spark, sf_dir), tie_cols=KEYS, whole_dates=True).select(*KEYS, "split")


@register
def time_series_folds(spark, sf_dir):
    return splits.time_series_folds(observations(spark, sf_dir), tie_cols=KEYS).select(*KEYS, "block")


@register
def stratified_split(spark, sf_dir):
    return splits.stratified_split(_labelled(spark, sf_dir), key_cols=KEYS).select(*KEYS, "split")


@register
def stratified_split_exact(spark, sf_dir):
    return splits.stratified_split(_labelled(spark, sf_dir), key_cols=KEYS, exact=True).select(*KEYS, "split")


# ---- features --------------------------------------------------------------------------------

@register
def temporal_features(spark, sf_dir):
    return add_temporal_features(observations(spark, sf_dir)).select(*KEYS, *TEMPORAL_FEATURES)


@register
def cyclical_features(spark, sf_dir):
    dated = add_temporal_features(observations(spark, sf_dir))
    return rounded(add_cyclical_features(dated).select(*KEYS, *CYCLICAL_FEATURES))


@register
def wind_encoding(spark, sf_dir):
    return rounded(encode_wind_directions(observations(spark, sf_dir)).select(*KEYS, *WIND_FEATURES))


@register
def weather_features(spark, sf_dir):
    return rounded(add_weather_features(observations(spark, sf_dir)).select(*KEYS, *WEATHER_FEATURES))


@register
def prepare_features_(spark, sf_dir):
    return rounded(prepare_features(observations(spark, sf_dir), keep=["Date"]))


@register
def featurize_(spark, sf_dir):
    return rounded(featurize(observations(spark, sf_dir), keep=["Date"]))


# ---- fitted preparation ----------------------------------------------------------------------

@register
def mean_impute(spark, sf_dir):
    return rounded(prepare.mean_impute(observations(spark, sf_dir).select(*ID, *NUMERIC_COLUMNS), NUMERIC_COLUMNS))


@register
def missing_indicator(spark, sf_dir):
    flagged = prepare.missing_indicator(observations(spark, sf_dir), NUMERIC_COLUMNS)
    return flagged.select(*ID, *[f"{c}_missing" for c in NUMERIC_COLUMNS])


@register
def robust_scale(spark, sf_dir):
    obs = prepare.missing_indicator(observations(spark, sf_dir), ["Rainfall"])
    chosen = ["MaxTemp", "Rainfall", "Sunshine", "Humidity3pm", "Rainfall_missing"]
    return rounded(prepare.fit_robust_scale(obs, chosen).transform(obs.select(*ID, *chosen)))


@register
def mode_impute(spark, sf_dir):
    return prepare.mode_impute(observations(spark, sf_dir).select(*ID, *WIND_COLUMNS, "RainToday"),
                               [*WIND_COLUMNS, "RainToday"])


@register
def target_encode(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select(*ID, "Location", TARGET)
    table, overall = prepare.fit_target_encoding(rows, "Location", TARGET)
    return rounded(prepare.target_encode(rows, table, "Location", overall))


@register
def target_encode_oof(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select(*KEYS, TARGET)
    return rounded(prepare.target_encode_oof(rows, "Location", TARGET, KEYS))


@register
def one_hot(spark, sf_dir):
    """Rows per category of each indicator vector, read back from the vectors."""
    from pyspark.ml.functions import vector_to_array

    obs = prepare.mode_impute(observations(spark, sf_dir).select(*WIND_COLUMNS), WIND_COLUMNS)
    fitted = prepare.fit_one_hot(obs, WIND_COLUMNS)
    coded = fitted.transform(obs)
    parts = []
    for column, labels in zip(WIND_COLUMNS, fitted.stages[0].labelsArray):
        slots = vector_to_array(f"{column}_onehot")
        sums = coded.agg(*[F.sum(slots[i]).alias(label) for i, label in enumerate(labels)])
        parts.append(sums.unpivot([], list(labels), "category", "total").select(
            F.lit(column).alias("variable"), "category", "total"))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@register
def one_hot_wide(spark, sf_dir):
    """Positions and rows of a column with one category per order, by the dictionary kept as a table."""
    obs = observations(spark, sf_dir).select(F.col("order_key").cast("string").alias("order_text"))
    found = prepare.fit_wide_one_hot(obs, ["order_text"]).indexed(obs)
    return found.groupBy(F.col("order_text").alias("category")).agg(
        F.max(F.col("order_text_index").cast("long")).alias("position"), F.count(F.lit(1)).alias("rows"))


@register
def iterative_impute(spark, sf_dir):
    obs = observations(spark, sf_dir).select(*ID, *NUMERIC_COLUMNS)
    return rounded(prepare.fit_chained_imputer(obs, NUMERIC_COLUMNS).transform(obs))


@register
def chained_impute_pair(spark, sf_dir):
    """Three rounds of ordinary regressions between two columns."""
    obs = observations(spark, sf_dir).select(*ID, *CHAINED_PAIR)
    return rounded(prepare.fit_chained_imputer(obs, CHAINED_PAIR, 3, 0.0, "least_squares").transform(obs))


@register
def prepare_data_(spark, sf_dir):
    prepared = prepare_data(observations(spark, sf_dir), key_cols=KEYS)
    return prepared.data.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(TARGET).cast("bigint").alias("positives"),
        F.min("Date").alias("first_date"), F.max("Date").alias("last_date"))


# ---- model -----------------------------------------------------------------------------------

def _split_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # both sides are read several times: features and split are computed once
    with plain_planning(spark):
        data = materialize(splits.temporal_split(
            prepare_features(observations(spark, sf_dir), keep=["Date"]), tie_cols=KEYS), "split")
    return (data.where(F.col("split") == "train").drop("split"),
            data.where(F.col("split") == "test").drop("split"))


def _quick_model(spark: SparkSession, sf_dir: str) -> modeling.RainModel:
    train, _ = _split_features(spark, sf_dir)
    return modeling.fit_model(train, QUICK, KEYS)


@register
def class_weights(spark, sf_dir):
    return rounded(modeling.class_weights(_labelled(spark, sf_dir)))


@register
def train_score(spark, sf_dir):
    train, test = _split_features(spark, sf_dir)
    model = modeling.fit_model(train, PUBLISHED, KEYS)
    scored = cleaning.threshold_label(model.transform(test, [*KEYS, TARGET]), label_col="prediction",
                                      as_text=False, digits=None)
    figures = metrics.score_report(materialize(scored, "scored"), TARGET, "prediction", "probability")
    return rounded(spark.createDataFrame([tuple(float(v) for v in figures.values())], list(figures)))


@register
def grid_search(spark, sf_dir):
    train, _ = _split_features(spark, sf_dir)
    return rounded(modeling.grid_search(train, KEYS).scores)


@register
def batch_predict(spark, sf_dir):
    model = _quick_model(spark, sf_dir)
    return modeling.batch_predict(observations(spark, sf_dir).drop(TARGET), model, KEYS)


@register
def replay_predict(spark, sf_dir):
    model = _quick_model(spark, sf_dir)
    return modeling.replay_predict(_versions(spark, sf_dir), model, ["Date", "Location"], tie_cols=ID)


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as a file stream."""
    from rainloom.catalog.derived import COLUMNS

    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
            .selectExpr(*[f"{e} as {n}" for n, e in COLUMNS]))


@register
def stream_score(spark, sf_dir):
    model = _quick_model(spark, sf_dir)
    arriving = _arriving(spark, sf_dir)
    base = scratch_dir(spark, "stream-score")
    query = jobs.stream_score(arriving, model, f"{base}/scores", f"{base}/checkpoint", KEYS)
    query.awaitTermination()
    return spark.read.parquet(f"{base}/scores")


@register
def stored_batch_predict(spark, sf_dir):
    obs = observations(spark, sf_dir).drop(TARGET)
    return rounded(modeling.ensemble_predict(obs, stored_ensemble(), KEYS, digits=None))


@register
def stored_replay_predict(spark, sf_dir):
    return rounded(modeling.ensemble_replay(
        _versions(spark, sf_dir), stored_ensemble(), ["Date", "Location"], tie_cols=ID, digits=None))


@register
def stored_stream_score(spark, sf_dir):
    """The stored ensemble on a file stream, read back from the table it appends to."""
    base = scratch_dir(spark, "stored-stream")
    scored = modeling.ensemble_predict(_arriving(spark, sf_dir).drop(TARGET), stored_ensemble(), KEYS, digits=None)
    jobs.append_stream(scored, f"{base}/scores", f"{base}/checkpoint").awaitTermination()
    return rounded(spark.read.parquet(f"{base}/scores"))


@register
def stored_score_report(spark, sf_dir):
    """Figures of the stored ensemble on the later fifth of the labelled rows."""
    _, test = _split_features(spark, sf_dir)
    scored = test.select(TARGET, stored_ensemble().probability().alias("probability"))
    scored = cleaning.threshold_label(scored, label_col="prediction", as_text=False, digits=None)
    figures = metrics.score_report(materialize(scored, "scored"), TARGET, "prediction", "probability")
    return rounded(spark.createDataFrame([tuple(float(v) for v in figures.values())], list(figures)))


@register
def stored_nodes(spark, sf_dir):
    """Share of the rows that reach each side of the trees' roots, by the flat node table."""
    roots = stored_ensemble().node_table(spark).where("node = 0 and feature is not null").select(
        "tree", "feature", "threshold", "missing_left")
    ready = featurize(observations(spark, sf_dir))
    cells = ready.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in STORED_FEATURES])).alias("x")).select("x.*")
    goes_left = F.coalesce(F.col("value") <= F.col("threshold"), F.col("missing_left"))
    return cells.join(F.broadcast(roots), "feature").groupBy("tree", "feature").agg(
        F.count_if(goes_left).alias("rows_left"), F.count_if(~goes_left).alias("rows_right"))


# ---- metrics ---------------------------------------------------------------------------------

def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, "score").select(
        F.col(TARGET).alias("label"), "score", (F.col("score") >= 0.5).cast("int").alias("prediction"))


@register
def confusion_metrics(spark, sf_dir):
    return rounded(metrics.confusion_metrics(_scored(spark, sf_dir), "label", "prediction"))


@register
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(_scored(spark, sf_dir), "score", "label"))


@register
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(_scored(spark, sf_dir), "score", "label"))
