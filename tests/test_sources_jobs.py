from __future__ import annotations

import json
import os
from datetime import date, datetime, timezone

import pytest
from conftest import make_frame, make_rows, replace
from pyspark.sql import functions as F, types as T

from rainloom import session, sources
from rainloom.plans import ingest, training
from rainloom.plans.features import prepare_features
from rainloom.schema import OBSERVATION_COLUMNS, RAW_TABLE_SCHEMA, TARGET, observation_schema
from rainloom.sources import tables
from rainloom.streaming import stream_ingest


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


HEADER = "Date,Location, Min Temp ,WindGustDir"
LINES = '2020-01-01,"A, upon ""B""",NA,\n2020-1-2,Saltmere,3.5,N\n,NA,x,NA\n'


@pytest.fixture
def csv(tmp_path):
    return write(f"{tmp_path}/landing/a.csv", f"{HEADER}\n{LINES}")


def test_raw_text_keeps_every_cell(spark, csv):
    rows = sources.read_raw_text(spark, csv).collect()
    assert [tuple(r) for r in rows] == [
        ("2020-01-01", 'A, upon "B"', "NA", ""), ("2020-1-2", "Saltmere", "3.5", "N"), ("", "NA", "x", "NA")]


def test_csv_is_typed(spark, csv):
    df = sources.read_csv(spark, csv, [" Min Temp "])
    assert [tuple(r) for r in df.collect()] == [
        (date(2020, 1, 1), 'A, upon "B"', None, None), (None, "Saltmere", 3.5, "N"), (None, None, None, None)]


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_csv(spark, f"{tmp_path}/none.csv")


@pytest.mark.parametrize("form", ["list", "data", "single"])
def test_json_forms(spark, tmp_path, form):
    records = [{"Date": "2020-01-01", "Location": "A", "MinTemp": 1.5}, {"Date": "2020-01-02", "Location": "B"}]
    body = {"list": records, "data": {"data": records, "more": 1}, "single": records[0]}[form]
    path = write(f"{tmp_path}/{form}.json", json.dumps(body, indent=1))
    df = sources.read_observations(spark, "json", path=path)
    assert df.count() == (1 if form == "single" else 2)
    assert df.orderBy("Date").first().Date == date(2020, 1, 1) and df.orderBy("Date").first().MinTemp == 1.5


def test_table_source_renames_and_casts(spark, weather, tmp_path):
    raw = weather.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c.lower()) for c in weather.columns])
    raw.write.parquet(f"{tmp_path}/t")
    raw.createOrReplaceTempView("weather_raw")
    one = sources.read_observations(spark, "table", path=f"{tmp_path}/t")
    two = sources.read_observations(spark, "table", table="weather_raw")
    assert one.schema == observation_schema() and one.exceptAll(two).count() == 0
    assert prepare_features(one).count() == 12


def test_source_arguments(spark):
    for source, options in [("csv", {}), ("table", {}), ("postgres", {"url": "jdbc:x"}), ("ftp", {"path": "x"})]:
        with pytest.raises(ValueError):
            sources.read_observations(spark, source, **options)


def test_jdbc_options():
    plain = sources.jdbc_options("jdbc:x", "t", user="u")
    assert plain["dbtable"] == "t" and "numPartitions" not in plain
    split = sources.jdbc_options("jdbc:x", "t", "id", 1, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["numPartitions"]) == ("id", "1", "8")
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "t", "id")


def test_series_scan(spark, tmp_path):
    path = write(f"{tmp_path}/s.csv", "date,temperature,precipitation\nbad,1,2\n2020-01-01,3.5,\n")
    rows = sources.read_series(spark, path).collect()
    assert [tuple(r) for r in rows] == [(None, 1.0, 2.0), (date(2020, 1, 1), 3.5, None)]


def test_column_names(spark):
    df = sources.normalize_columns(spark.createDataFrame([(1, 2)], "` Wind Gust ` int, MaxTemp int"))
    assert df.columns == ["wind_gust", "maxtemp"]


def full_csv(path, rows):
    text = ",".join(OBSERVATION_COLUMNS) + "\n"
    text += "".join(",".join("NA" if v is None else str(v) for v in r) + "\n" for r in rows)
    return write(path, text)


def test_import_run(spark, tmp_path):
    base = str(tmp_path)
    path = full_csv(f"{base}/landing/w.csv", make_rows())
    record = ingest.ingest_files(spark, path, f"{base}/raw", f"{base}/log", f"{base}/archive")
    assert record["status"] == "success" and record["rows_imported"] == 12
    assert not os.path.exists(path)
    archived, = record["archive_path"]
    assert os.path.basename(archived).startswith("w_2") and archived.endswith(".csv")
    raw = sources.read_raw_table(spark, f"{base}/raw", f"{base}/log")
    assert {f.name for f in RAW_TABLE_SCHEMA} == set(raw.columns)
    assert {f.dataType for f in raw.schema if f.name != "import_date"} == {T.StringType()}
    row = raw.first()
    assert row.source_file.endswith("w.csv") and row.import_run_id == record["run_id"]
    # a second import of the same file adds versions
    again = full_csv(f"{base}/landing/w.csv", make_rows())
    ingest.ingest_files(spark, again, f"{base}/raw", f"{base}/log")
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 24
    assert spark.read.json(f"{base}/log").where("status = 'success'").count() == 2


def test_failed_import_leaves_nothing_visible(spark, tmp_path):
    base = str(tmp_path)
    full_csv(f"{base}/landing/w.csv", make_rows())
    ingest.ingest_files(spark, f"{base}/landing/w.csv", f"{base}/raw", f"{base}/log")
    record = ingest.ingest_files(spark, f"{base}/landing/none.csv", f"{base}/raw", f"{base}/log")
    assert record["status"] == "failed" and "not found" in record["error"] and record["rows_imported"] == 0
    # a header that does not match stops the write half way
    bad = write(f"{base}/landing/bad.csv", "x,y\n1,2\n")
    record = ingest.ingest_files(spark, bad, f"{base}/raw", f"{base}/log", f"{base}/archive", OBSERVATION_COLUMNS)
    assert record["status"] == "failed" and os.path.exists(bad)
    # rows of a run without a success record stay hidden
    stray = spark.read.parquet(f"{base}/raw").withColumn("import_run_id", F.lit("stray"))
    sources.append_raw(stray, f"{base}/raw")
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 12
    assert sources.read_raw_table(spark, f"{base}/raw").count() == 24


def test_stream_import_is_exactly_once_and_archives_later(spark, tmp_path):
    base = str(tmp_path)
    def run():
        stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/cp", f"{base}/log", f"{base}/archive").awaitTermination()
        return sources.read_raw_table(spark, f"{base}/raw", f"{base}/log")
    full_csv(f"{base}/landing/1.csv", make_rows())
    assert run().count() == 12
    assert run().count() == 12
    full_csv(f"{base}/landing/2.csv", replace(make_rows(5), 0, Rainfall=None))
    got = run()
    assert got.count() == 17 and got.where("rainfall = 'NA'").count() == 1
    assert got.select("source_file").distinct().count() == 2
    assert not os.path.exists(f"{base}/landing/1.csv")      # moved by a later run
    assert {f.name for f in RAW_TABLE_SCHEMA} == set(got.columns)


def test_headers_are_matched_by_name(spark, tmp_path):
    base = str(tmp_path)
    write(f"{base}/in/a b.csv", "Date,Location,MinTemp\n2020-01-01,A,1\n")
    write(f"{base}/in/c.csv", "\ufeffLocation,MinTemp,Date\nB,2,2020-01-02\n")
    write(f"{base}/in/d.csv", "")
    rows = sources.read_raw_text(spark, f"{base}/in").orderBy("Date").collect()
    assert [tuple(r) for r in rows] == [("2020-01-01", "A", "1"), ("2020-01-02", "B", "2")]
    write(f"{base}/in/e.csv", "Date,Place,MinTemp\n2020-01-01,A,1\n")
    with pytest.raises(ValueError, match="Place"):
        sources.read_raw_text(spark, f"{base}/in")
    with pytest.raises(ValueError, match="no header"):
        sources.read_raw_text(spark, f"{base}/in/d.csv")


def test_rows_with_a_wrong_number_of_cells(spark, tmp_path):
    base = str(tmp_path)
    path = write(f"{base}/in/r.csv", 'a,b\n1,2\n3\n4,5,6\n"7,7",\n')
    with pytest.raises(Exception, match="wrong number of cells"):
        sources.read_raw_text(spark, path).count()
    assert {tuple(r) for r in sources.read_raw_text(spark, path, ragged="pad").collect()} == {("1", "2"), ("3", ""), ("4", "5"), ("7,7", "")}
    record = ingest.ingest_files(spark, path, f"{base}/raw", f"{base}/log")
    assert (record["status"], record["rows_imported"], record["rows_rejected"]) == ("success", 2, 2)
    rejects = spark.read.parquet(ingest.rejects_path(f"{base}/raw"))
    assert {r["_rejected"] for r in rejects.collect()} == {"3", "4,5,6"}


def test_batch_and_stream_share_a_table(spark, tmp_path):
    base = str(tmp_path)
    full_csv(f"{base}/one/w.csv", make_rows(4))
    ingest.ingest_files(spark, f"{base}/one/w.csv", f"{base}/raw", f"{base}/log")
    full_csv(f"{base}/landing/1.csv", make_rows(3))
    for _ in range(2):
        stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/cp", f"{base}/log").awaitTermination()
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 7
    assert sources.read_raw_table(spark, f"{base}/raw").count() == 7
    ingest.ingest_files(spark, f"{base}/one/w.csv", f"{base}/raw", f"{base}/log")
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 11
    log = sources.read_import_log(spark, f"{base}/log")
    assert sorted(r["rows_imported"] for r in log.collect()) == [3, 4, 4]
    # a repeated attempt of a batch replaces its rows
    run, = [r["run_id"] for r in log.collect() if r["rows_imported"] == 3]
    ingest.import_run(spark, f"{base}/landing/1.csv", f"{base}/raw", f"{base}/log", run)
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 11
    full_csv(f"{base}/landing/2.csv", make_rows(1))
    write(f"{base}/landing/bad.csv", "x,y\n1,2\n")
    with pytest.raises(Exception):
        stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/cp", f"{base}/log", columns=OBSERVATION_COLUMNS).awaitTermination()
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 11


def test_a_failing_archive_undoes_the_import(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for part in ("x", "y"):
        full_csv(f"{base}/in/p={part}/w.csv", make_rows(2))
    args = (spark, f"{base}/in/p=*", f"{base}/raw", f"{base}/log", f"{base}/archive")
    move, calls = ingest._move, []

    def failing(*given):
        calls.append(given)
        if len(calls) == 2:
            raise OSError("no space")
        return move(*given)

    monkeypatch.setattr(ingest, "_move", failing)
    record = ingest.ingest_files(*args)
    assert record["status"] == "failed" and "no space" in record["error"] and record["archive_path"] == []
    assert os.path.exists(f"{base}/in/p=x/w.csv") and os.path.exists(f"{base}/in/p=y/w.csv")
    monkeypatch.setattr(ingest, "_move", move)
    record = ingest.ingest_files(*args)           # files of one name in two folders
    assert record["status"] == "success" and len(set(record["archive_path"])) == 2
    assert sources.read_raw_table(spark, f"{base}/raw", f"{base}/log").count() == 4
    assert not os.path.exists(f"{base}/in/p=x/w.csv")


def test_json_numbers_as_text_and_broken_documents(spark, tmp_path):
    path = write(f"{tmp_path}/j.json", '{"Date": "2020-01-01", "MinTemp": "13.4", "MaxTemp": 20}\n{"data": [{"MinTemp": "NA"}, {"MinTemp": "1d"}]}\n{"Date": \n')
    with pytest.raises(Exception, match="no JSON document"):
        sources.read_json(spark, path, multi_line=False).collect()
    rows = sources.read_json(spark, path, multi_line=False, broken="keep").collect()
    assert [(r.MinTemp, r.MaxTemp) for r in rows] == [(13.4, 20.0), (None, None), (None, None), (None, None)]
    assert [r["_rejected"] for r in rows] == [None, None, None, '{"Date": ']


@pytest.mark.parametrize("text,kept", [
    ("2020-01-05 00:00:00", True), ("2020-01-05T09:00:00", True), ("2020-01-05T09:00:00.5+02:00", True), (" 2020-01-05", True),
    ("2020-01-05 noon", False), ("2020-1-5", False), ("12020-01-05", False)])
def test_dates_with_a_time_of_day(spark, text, kept):
    from rainloom.operators import cleaning

    df = spark.createDataFrame([(text,)], "Date string")
    want = [date(2020, 1, 5)] if kept else []
    assert [r.Date for r in cleaning.parse_date_column(df).collect()] == want
    assert [r.Date for r in cleaning.parse_date_column(df, unpadded=True).collect()] == (want or [date(2020, 1, 5)] * (text == "2020-1-5"))


def test_audit_literal_instant(spark):
    df = sources.with_audit_columns(spark.range(1), datetime(2024, 5, 1, 6, 30, tzinfo=timezone.utc), "r", "f")
    assert df.selectExpr("cast(import_date as string)").first()[0] == "2024-05-01 06:30:00"


def test_report_and_metrics_tables(spark, weather, tmp_path):
    base = str(tmp_path)
    assert sources.read_metrics(spark, f"{base}/metrics") is None
    sources.append_metrics(spark, f"{base}/metrics", "r1", {"n_estimators": 5}, {"f1": 0.5})
    sources.append_metrics(spark, f"{base}/metrics", "r2", {"n_estimators": 9}, {"f1": 0.6})
    rows = sources.read_metrics(spark, f"{base}/metrics").orderBy("run_id").collect()
    assert [(r.run_id, r.params.n_estimators, r.f1) for r in rows] == [("r1", 5, 0.5), ("r2", 9, 0.6)]
    data = training.prepare_data(weather, report_path=f"{base}/report")
    assert spark.read.option("header", True).csv(f"{base}/report").count() == 23
    sources.write_splits(data.data, f"{base}/splits")
    assert spark.read.parquet(f"{base}/splits").count() == 12


@pytest.mark.parametrize("strategy", ["temporal", "random"])
def test_prepare_data_keeps_every_row(spark, strategy):
    rows = make_rows(60)
    for i in range(30):
        rows = replace(rows, i, Sunshine=None)
    data = training.prepare_data(make_frame(spark, rows), split_strategy=strategy)
    assert data.high_missing_columns == ["Sunshine"]
    assert data.train.count() + data.test.count() == 60 and data.test.count() == 12
    assert len(data.numeric_features) == 40 and data.categorical_features == ["Location"]
    if strategy == "temporal":
        assert data.train.agg(F.max("Date")).first()[0] < data.test.agg(F.min("Date")).first()[0]
    with pytest.raises(ValueError):
        training.prepare_data(make_frame(spark, rows), split_strategy="other")


def test_four_stage_training(spark, tmp_path):
    from test_prepare_model import observations

    base = str(tmp_path)
    pdf = observations(spark, 240).collect()
    path = full_csv(f"{base}/w.csv", [tuple(r) for r in pdf])
    figures = training.run_training(
        spark, f"{base}/work", source="csv", path=path, grid={"n_estimators": [2], "num_leaves": [7]})
    assert set(figures) == {"accuracy", "f1", "roc_auc", "pr_auc", "precision", "recall"}
    assert figures["roc_auc"] > 0.7
    assert sources.read_metrics(spark, f"{base}/work/metrics").first().roc_auc == figures["roc_auc"]
    predictions = spark.read.parquet(f"{base}/work/predictions")
    assert set(predictions.columns) == {"Date", "Location", TARGET, "probability", "prediction"}
    assert predictions.count() == 48


def test_exploration_tables(spark):
    df = make_frame(spark, make_rows(30)).withColumn("Date", F.to_date("Date"))
    tables = training.exploration_report(df)
    assert {"correlations", "monthly_boxes", "year_month", "smoothed_series", "density"} <= set(tables)
    assert all(t.count() >= 0 for t in tables.values())


def test_scratch_space_follows_the_cluster_setting(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_dir(spark, "x")
    if before:
        assert path.startswith(before)
    df = session.materialize(spark.range(5), "numbers")
    assert df.count() == 5




def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path, monkeypatch):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    df = spark.range(300).select("id", F.concat(F.lit("run-"), F.col("id") % 40).alias("import_run_id")).coalesce(1)
    writer = type(df.write)
    given = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(key)), given(self, *a, **b))[1])
    before = spark.conf.get(key)
    sources.append_raw(df, f"{tmp_path}/raw")
    tables.replace_run(df, f"{tmp_path}/raw")
    sources.write_splits(df.withColumnRenamed("import_run_id", "split"), f"{tmp_path}/splits")
    assert seen and all(int(n) > 1 for n in seen) and spark.conf.get(key) == before
    # more runs in a task than open files: the rest is sorted, nothing is lost
    assert sorted(map(tuple, sources.read_raw_table(spark, f"{tmp_path}/raw").select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    assert spark.read.parquet(f"{tmp_path}/splits").groupBy("split").count().count() == 40
