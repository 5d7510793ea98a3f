"""Plain SQL with the meaning of each registered query, for a second engine to check against."""

from __future__ import annotations

from itertools import combinations

from rainloom.catalog.derived import COLUMNS, ID, KEYS, observations_sql
from rainloom.catalog.stored import stored_ensemble
from rainloom.functions.features import (
    CYCLICAL_FEATURES, DAYS_PER_CYCLE, DIFFERENCES, FLAGS, LOG_AMOUNTS, MONTHS_PER_CYCLE,
    TEMPORAL_FEATURES, WEATHER_FEATURES,
)
from rainloom.functions.scalars import COMPASS_POINTS
from rainloom.schema import NUMERIC_COLUMNS, OBSERVATION_COLUMNS, TARGET, WIND_COLUMNS

COMMA = ", "
TEXT = [c for c in OBSERVATION_COLUMNS if c not in NUMERIC_COLUMNS and c != "Date"]


def _round(expression: str, name: str, digits: int = 6) -> str:
    # adding zero turns a rounded negative zero into zero
    return f"round({expression}, {digits}) + 0.0 as {name}"


def _rounded(columns, digits: int = 6) -> str:
    return COMMA.join(_round(c, c, digits) for c in columns)


def _with(body: str, *extra: str, ctes: str = "") -> str:
    more = f", {ctes}" if ctes else ""
    return f"with obs as ({observations_sql(*extra)}){more} {body}"


def _digest(columns, seed: int = 0) -> str:
    parts = COMMA.join(f"coalesce(cast({c} as varchar), '')" for c in columns)
    return f"md5(concat_ws('|', '{seed}', {parts}))"


def _fraction(digest: str) -> str:
    return f"(cast('0x' || substr({digest}, 1, 8) as bigint) / 4294967296.0)"


IDS = COMMA.join(ID)
KEY = COMMA.join(KEYS)
YES_NO = f"case {TARGET} when 'Yes' then 1 when 'No' then 0 end"
LABELLED = (f"labelled as (select * replace ({YES_NO} as {TARGET}) from obs where {TARGET} is not null)")
ORDERED = f"row_number() over (order by Date, {_digest(KEYS)}) - 1"


def _split(source: str) -> str:
    """Rows of ``source`` with a chronological split column."""
    return (f"select *, case when {ORDERED} < cast(floor((select count(*) from {source}) * (1 - cast(0.2 as double)))"
            f" as bigint) then 'train' else 'test' end as split from {source}")


TEMPORAL = {
    "Year": "cast(year(Date) as int)", "Month": "cast(month(Date) as int)",
    "Day": "cast(day(Date) as int)", "DayOfYear": "cast(dayofyear(Date) as int)",
}
CYCLICAL = {
    "Month_sin": f"sin(2 * pi() * month(Date) / {MONTHS_PER_CYCLE})",
    "Month_cos": f"cos(2 * pi() * month(Date) / {MONTHS_PER_CYCLE})",
    "DayOfYear_sin": f"sin(2 * pi() * dayofyear(Date) / {DAYS_PER_CYCLE})",
    "DayOfYear_cos": f"cos(2 * pi() * dayofyear(Date) / {DAYS_PER_CYCLE})",
}


def _degrees(column: str) -> str:
    cases = " ".join(f"when '{p}' then {i * 22.5}" for i, p in enumerate(COMPASS_POINTS))
    return f"case {column} {cases} end"


WIND = {f"{c}_{f}": f"{f}(radians({_degrees(c)}))" for c in WIND_COLUMNS for f in ("sin", "cos")}
WEATHER = {
    **{n: f"{a} - {b}" for n, (a, b) in DIFFERENCES.items()},
    **{n: f"ln(1 + case when {c} < 0 then 0 else {c} end)" for n, c in LOG_AMOUNTS.items()},
    **{n: f"case when {c} {'>' if t == 'above' else '>='} {v} then 1.0 when {c} is not null then 0.0 end"
       for n, (c, t, v) in FLAGS.items()},
}
WEATHER = {n: f"cast({e} as double)" for n, e in WEATHER.items()}


def _expressions(parts: dict[str, str], integers=()) -> str:
    return COMMA.join(f"{e} as {n}" if n in integers else _round(e, n) for n, e in parts.items())


RAIN_TODAY = "cast(case RainToday when 'Yes' then 1 when 'No' then 0 end as double) as RainToday"
FEATURE_LIST = COMMA.join([
    "Date", "Location", _rounded(NUMERIC_COLUMNS), RAIN_TODAY, _expressions(TEMPORAL, TEMPORAL),
    _expressions(CYCLICAL), _expressions(WIND), _expressions(WEATHER), IDS,
])

SQL: dict[str, str] = {}

# ---- sources and the raw table ----
ORDERS = """orders_text as (select o_orderkey, o_custkey,
  case when o_custkey % 9 = 1 then 'NA' when o_custkey % 9 = 2 then '' else o_orderstatus end as status,
  case when o_custkey % 7 = 1 then null else o_totalprice end as price,
  case when o_custkey % 8 = 1 then '2020-13-01' else strftime(o_orderdate, '%Y-%m-%d') end as day from orders)"""
SQL["scan_csv"] = f"""with {ORDERS} select cast(o_orderkey as varchar) as o_orderkey,
  case when status not in ('NA', '') then status end as o_orderstatus,
  {_round('price', 'o_totalprice')}, try_cast(day as date) as o_orderdate from orders_text"""
SQL["scan_csv_mixed_headers"] = SQL["scan_csv"]
SQL["scan_raw_strings"] = f"""with {ORDERS} select cast(o_orderkey as varchar) as o_orderkey,
  status as o_orderstatus, day as o_orderdate from orders_text"""
SQL["scan_json"] = f"select o_orderkey, {_round('o_totalprice', 'o_totalprice')}, o_orderstatus from orders"
PLAIN = f"Date, {COMMA.join(TEXT)}, {_rounded(NUMERIC_COLUMNS)}"
SQL["scan_table"] = _with(f"select {PLAIN}, {IDS} from obs")
SQL["rename_project"] = _with(f"select {PLAIN} from obs")
SQL["ingest_append"] = _with(
    "select import_run_id, concat(status, '.csv') as source_file, count(*) as rows_imported, "
    "count(*) filter (where Rainfall is null) as na_cells, count(distinct Location) as stations "
    "from obs, (values ('run-1'), ('run-2')) as runs(import_run_id) group by 1, 2", "status")
SQL["audit_columns"] = _with(
    f"select {IDS}, '2024-05-01 06:30:00' as import_date, 'run-1' as import_run_id, "
    "'lineitem' as source_file from obs")
SQL["normalize_columns"] = _with(f"select {IDS}, {_round('MaxTemp', 'maxtemp')} from obs")
SQL["import_stats"] = _with(
    "select concat('run-', cast(import_day as varchar)) as import_run_id, concat(status, '.csv') as source_file, "
    "count(*) as rows_imported from obs group by 1, 2", "import_day", "status")
SQL["ingest_job"] = f"with {ORDERS} select status as o_orderstatus, count(*) as rows_imported from orders_text group by 1"
SQL["ingest_mixed"] = """select import_run_id, count(*) as rows_visible, count(*) as rows_logged, cast(0 as bigint) as rows_rejected
  from orders, (values ('batch'), ('stream')) as runs(import_run_id) group by 1"""
SQL["stream_ingest"] = f"""with {ORDERS} select 'run-1' as import_run_id, status as o_orderstatus,
  count(*) as rows_imported, count(*) filter (where price is null) as na_cells from orders_text group by 1, 2"""

# ---- cleaning ----
SQL["clean_target"] = _with(f"select {IDS}, {TARGET} from labelled", ctes=LABELLED)
SQL["encode_rain_today"] = _with(f"select {IDS}, {RAIN_TODAY} from obs")
SQL["parse_date"] = _with(
    f"select {IDS}, cast(date_text as date) as date_text from obs where date_text not in ('2020-13-01', 'NA')",
    "date_text")
SQL["coerce_numeric"] = _with(
    f"select {IDS}, try_cast(nullif(nullif(rain_text, 'NA'), '') as double) as rain_text from obs", "rain_text")
DROPPED = ["Evaporation", "Sunshine", "Cloud9am", "Cloud3pm"]
SQL["drop_high_missing"] = _with(
    f"select Date, {COMMA.join(TEXT)}, {_rounded(c for c in NUMERIC_COLUMNS if c not in DROPPED)}, {IDS} from obs")
SQL["threshold_label"] = _with(
    f"select {IDS}, {_round('score', 'probability', 4)}, case when score >= 0.5 then 'Yes' else 'No' end "
    "as rain_tomorrow from obs", "score")
SQL["preview"] = _with(f"select {KEY}, {_rounded(['MaxTemp', 'Rainfall'])} from obs order by {KEY} limit 50")
SQL["sample_rows"] = _with(
    f"select {KEY}, {_rounded(['MaxTemp'])} from obs where Location is not null order by {_digest(KEYS, 42)} limit 20")
SQL["station_list"] = _with("select distinct Location from obs where Location is not null")

# ---- profile ----


def _type_of(column: str) -> str:
    return "date" if column == "Date" else "double" if column in NUMERIC_COLUMNS else "string"


SQL["missing_report"] = _with(" union all ".join(
    f"select '{c}' as \"column\", '{_type_of(c)}' as dtype, count(*) - count({c}) as missing_count, "
    f"{_round(f'(count(*) - count({c})) / cast(count(*) as double)', 'missing_rate')}, "
    f"{_round(f'100 * (count(*) - count({c})) / cast(count(*) as double)', 'missing_rate_pct', 2)}, "
    f"count(distinct {c}) as unique_values from obs" for c in OBSERVATION_COLUMNS))


def _rates(columns) -> str:
    return "rates as (" + " union all ".join(
        f"select '{c}' as \"column\", (count(*) - count({c})) / cast(count(*) as double) as rate from obs"
        for c in columns) + ")"


SQL["high_missing_columns"] = _with(
    f"select \"column\", {_round('rate', 'missing_rate')} from rates where rate > 0.3",
    ctes=_rates([c for c in OBSERVATION_COLUMNS if c != TARGET]))
SQL["missing_pct"] = _with(
    f"select \"column\", {_round('rate * 100', 'missing_pct')} from rates where rate > 0",
    ctes=_rates(OBSERVATION_COLUMNS))
SEEN = ("seen as (select *, cast('2024-05-01 06:30:00' as timestamp) + to_days(import_day) as import_date, "
        "concat(status, '.csv') as source_file from obs)")
SQL["last_import"] = _with(
    "select strftime(import_date, '%Y-%m-%d %H:%M:%S') as import_date, source_file, count(*) as rows_imported "
    "from seen where import_date = (select max(import_date) from seen) group by seen.import_date, source_file "
    "order by source_file limit 1", "import_day", "status", ctes=SEEN)
HIT = f"avg(case when {TARGET} = 'Yes' then 1.0 else 0.0 end)"
SQL["overview_kpis"] = _with(
    f"select count(*) as observations, count(distinct Location) as stations, {_round(f'{HIT} * 100', 'rain_pct')}, "
    "cast(min(year(Date)) as int) as first_year, cast(max(year(Date)) as int) as last_year from obs")
SQL["rain_rate_topk"] = _with(
    f"select Location, {_round('rate', 'rain_rate')} from (select Location, {HIT} as rate from obs "
    "where Location is not null group by 1 order by 2 desc, 1 limit 15)")
SQL["value_counts"] = _with(f"select {TARGET}, count(*) as n from obs group by 1")
SPLIT = f"{LABELLED}, parts as ({_split('labelled')})"
SQL["class_distribution"] = _with(
    f"select {TARGET}, " + COMMA.join(
        _round(f"count(*) filter (where split = '{s}') / cast((select count(*) from parts where split = '{s}') as double)", s)
        for s in ("train", "test")) + " from parts group by 1", ctes=SPLIT)
SQL["split_counts"] = _with("select split, count(*) as rows from parts group by 1", ctes=SPLIT)

# ---- exploration ----
SQL["corr_matrix"] = _with(" union all ".join(
    [f"select '{x}' as variable, '{y}' as other, {_round(f'corr({a}, {b})', 'correlation')} from obs"
     for a, b in combinations(NUMERIC_COLUMNS, 2) for x, y in ((a, b), (b, a))]
    + [f"select '{c}' as variable, '{c}' as other, cast(1.0 as double) as correlation" for c in NUMERIC_COLUMNS]))
VALUES = "vals as (" + " union all ".join(
    f"select '{c}' as variable, {c} as v from obs where {c} is not null"
    for c in ("Humidity3pm", "MaxTemp", "Rainfall")) + ")"
SQL["histogram"] = _with(
    "select s.variable, cast(g.bin as int) as bin, "
    + _round("low + (high - low) * g.bin / 40", "bin_start") + COMMA
    + _round("low + (high - low) * (g.bin + 1) / 40", "bin_end") + ", coalesce(n, 0) as n "
    "from spans s cross join range(40) g(bin) left join counts c on c.variable = s.variable and c.bin = g.bin",
    ctes=VALUES + ", spans as (select variable, min(v) as low, max(v) as high from vals group by 1), "
    "counts as (select variable, least(cast(floor((v - low) / (high - low) * 40) as bigint), 39) as bin, "
    "count(*) as n from vals join spans using (variable) group by 1, 2)")
SQL["kde"] = _with(
    f"select cast(g as int) as grid, {_round('low + g * step', 'x')}, "
    f"{_round('sum(w * exp(-0.5 * power((low + g * step - v) / h, 2))) / any_value(n * h * sqrt(2 * pi()))', 'density')} "
    "from weights cross join stats cross join range(200) t(g) group by g, low, step",
    ctes="weights as (select Humidity3pm as v, count(*) as w from obs where Humidity3pm is not null group by 1), "
    "stats as (select count(Humidity3pm) as n, min(Humidity3pm) as low, (max(Humidity3pm) - min(Humidity3pm)) / 199 as step, "
    "stddev_samp(Humidity3pm) * power(count(Humidity3pm), -0.2) as h from obs)")
SQL["monthly_box_stats"] = _with(
    f"select cast(month as int) as month, {_rounded(['q1', 'median', 'q3'])}, "
    + _round("min(v) filter (where v >= q1 - 1.5 * (q3 - q1))", "whisker_low") + COMMA
    + _round("max(v) filter (where v <= q3 + 1.5 * (q3 - q1))", "whisker_high") + COMMA
    + "count(*) filter (where v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as outliers, count(*) as n "
    "from vals join boxes using (month) group by month, q1, median, q3",
    ctes="vals as (select month(Date) as month, MaxTemp as v from obs where MaxTemp is not null), "
    "boxes as (select month, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, "
    "quantile_cont(v, 0.75) as q3 from vals group by 1)")
SQL["year_month_pivot"] = _with(
    "select cast(year(Date) as int) as year, " + COMMA.join(
        _round(f"avg(MaxTemp) filter (where month(Date) = {m})", f"m{m}") for m in range(1, 13))
    + " from obs group by 1")
MEASURES = ["MaxTemp", "MinTemp", "Rainfall"]
SQL["monthly_resample"] = _with(
    f"select s.Location, last_day(s.m) as month_end, {COMMA.join(_round(f'avg({c})', c) for c in MEASURES)} "
    "from spine s left join obs o on o.Location = s.Location and last_day(o.Date) = last_day(s.m) group by 1, 2",
    ctes="spine as (select Location, cast(unnest(generate_series(date_trunc('month', min(Date)), "
    "date_trunc('month', max(Date)), interval 1 month)) as date) as m from obs group by 1)")
SQL["rolling_mean_7"] = _with(
    f"select Location, Date, {_round('MaxTemp', 'MaxTemp')}, "
    + _round("case when count(MaxTemp) over w = 7 then avg(MaxTemp) over w end", "MaxTemp_smooth")
    + " from daily window w as (partition by Location order by Date rows between 3 preceding and 3 following)",
    ctes="daily as (select Location, Date, avg(MaxTemp) as MaxTemp from obs group by 1, 2)")

# ---- versions and splits ----
NEWEST = SEEN + (
    ", newest as (select *, row_number() over (partition by Date, Location order by import_date desc, "
    + COMMA.join(f"{c} desc" for c in ID) + ") as rn from seen)")
SQL["latest_observation"] = _with(
    f"select {PLAIN}, {IDS} from newest where rn = 1", "import_day", "status", ctes=NEWEST)
SQL["feature_lookup"] = _with(
    f"select Date, Location, 'Rainfall' as feature, {_round('Rainfall', 'value')} from newest where rn = 1",
    "import_day", "status", ctes=NEWEST)
_SAME_KEY = "'0|' || cast(Date as varchar) || '|' || Location"
SQL["temporal_split_duplicates"] = _with(f"""select Date, Location, {IDS}, case when place <= floor(n * (1 - 0.2)) then 'train' else 'test' end as split
  from (select *, count(*) over () as n, row_number() over (order by Date, md5({_SAME_KEY}),
    md5({_SAME_KEY} || '|' || cast(line_no as varchar) || '|' || cast(order_key as varchar) || '|' || cast(part_key as varchar))) as place from obs)""")
SQL["temporal_split"] = _with(f"select {KEY}, split from ({_split('obs')})")
SQL["temporal_split_whole_dates"] = _with(
    f"select {KEY}, case when Date < (select Date from ranked where r = (select cast(floor(count(*) * "
    "(1 - cast(0.2 as double))) as bigint) from obs)) then 'train' else 'test' end as split from obs",
    ctes="ranked as (select Date, row_number() over (order by Date) - 1 as r from obs)")
SQL["time_series_folds"] = _with(
    f"select {KEY}, cast(case when r < n - 3 * f then 0 when r < n - 2 * f then 1 when r < n - f then 2 else 3 end as int) "
    f"as block from (select *, {ORDERED} as r, count(*) over () as n, count(*) over () // 4 as f from obs)")
SQL["stratified_split"] = _with(
    f"select {KEY}, case when {_fraction(_digest(KEYS, 42))} < cast(0.2 as double) then 'test' else 'train' end as split "
    "from labelled", ctes=LABELLED)
SQL["stratified_split_exact"] = _with(
    f"select {KEY}, case when row_number() over (partition by {TARGET} order by {_digest(KEYS, 42)}) <= take "
    f"then 'test' else 'train' end as split from labelled join takes using ({TARGET})",
    ctes=LABELLED + f", quotas as (select {TARGET}, count(*) * cast(0.2 as double) as q from labelled group by 1), "
    "short as (select ceil((select count(*) from labelled) * cast(0.2 as double)) - sum(floor(q)) as s from quotas), "
    f"takes as (select {TARGET}, floor(q) + case when row_number() over (order by q - floor(q) desc, {TARGET}) "
    "<= (select s from short) then 1 else 0 end as take from quotas)")

# ---- features ----
SQL["temporal_features"] = _with(f"select {KEY}, {_expressions(TEMPORAL, TEMPORAL_FEATURES)} from obs")
SQL["cyclical_features"] = _with(f"select {KEY}, {_expressions({c: CYCLICAL[c] for c in CYCLICAL_FEATURES})} from obs")
SQL["wind_encoding"] = _with(f"select {KEY}, {_expressions(WIND)} from obs")
SQL["weather_features"] = _with(f"select {KEY}, {_expressions({c: WEATHER[c] for c in WEATHER_FEATURES})} from obs")
SQL["prepare_features"] = _with(f"select {FEATURE_LIST}, {TARGET} from labelled", ctes=LABELLED)
SQL["featurize"] = _with(f"select {FEATURE_LIST} from obs")

# ---- fitted preparation ----
SQL["mean_impute"] = _with(
    f"select {IDS}, {COMMA.join(_round(f'coalesce({c}, avg({c}) over ())', c) for c in NUMERIC_COLUMNS)} from obs")


def _chained_pair(first: str, second: str, rounds: int) -> str:
    """Rounds of regressions between two columns as a chain of subqueries; the column with fewer gaps first."""
    rows = (f"select {IDS}, {first}, {second}, coalesce({first}, avg({first}) over ()) as x, "
            f"coalesce({second}, avg({second}) over ()) as y from obs")
    for _ in range(rounds):
        for given, filled, by in ((first, "x", "y"), (second, "y", "x")):
            other = "y" if filled == "x" else "x"
            rows = (
                f"select {IDS}, {first}, {second}, {other}, case when {given} is null then c + s * {by} else {filled} end as {filled} "
                f"from ({rows}), (select regr_slope({filled}, {by}) as s, regr_intercept({filled}, {by}) as c from ({rows}) where {given} is not null)")
    return rows


SQL["chained_impute_pair"] = _with(
    f"select {IDS}, {_round('x', 'MinTemp')}, {_round('y', 'MaxTemp')} from ({_chained_pair('MinTemp', 'MaxTemp', 3)})")
SQL["missing_indicator"] = _with(
    f"select {IDS}, " + COMMA.join(
        f"cast(case when {c} is null then 1 else 0 end as double) as {c}_missing" for c in NUMERIC_COLUMNS) + " from obs")
SCALED = ["MaxTemp", "Rainfall", "Sunshine", "Humidity3pm", "Rainfall_missing"]
SQL["robust_scale"] = _with(
    f"select {IDS}, " + COMMA.join(
        _round(f"({c} - {c}_m) / case when {c}_h = {c}_l then 1 else {c}_h - {c}_l end", c) for c in SCALED)
    + " from flagged cross join fitted",
    ctes="flagged as (select *, case when Rainfall is null then 1.0 else 0.0 end as Rainfall_missing from obs), "
    "fitted as (select " + COMMA.join(
        f"quantile_cont(cast({c} as double), {p}) as {c}_{n}" for c in SCALED
        for n, p in (("l", 0.25), ("m", 0.5), ("h", 0.75))) + " from flagged)")
SQL["mode_impute"] = _with(
    f"select {IDS}, " + COMMA.join(
        f"coalesce({c}, (select {c} from obs where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}"
        for c in [*WIND_COLUMNS, "RainToday"]) + " from obs")


def _shrunk(n: str, pos: str, all_n: str, all_pos: str) -> str:
    mean, overall = f"({pos} / {n})", f"({all_pos} / {all_n})"
    inside, total = f"({mean} * (1 - {mean}))", f"({overall} * (1 - {overall}))"
    weight = f"({n} * {total} / ({inside} + {n} * {total}))"
    return f"({weight} * {mean} + (1 - {weight}) * {overall})"


SQL["target_encode"] = _with(
    f"select {IDS}, Location, {TARGET}, {_round(_shrunk('n', 'pos', 'all_n', 'all_pos'), 'Location_encoded')} from "
    f"(select *, cast(count(*) over (partition by Location) as double) as n, "
    f"cast(sum({TARGET}) over (partition by Location) as double) as pos, cast(count(*) over () as double) as all_n, "
    f"cast(sum({TARGET}) over () as double) as all_pos from labelled)", ctes=LABELLED)
SQL["target_encode_oof"] = _with(
    f"select {KEY}, {TARGET}, case when n = fn then (all_pos - f_pos) / (all_n - f_n) else "
    f"round({_shrunk('(n - fn)', '(pos - fpos)', '(all_n - f_n)', '(all_pos - f_pos)')}, 6) end as Location_encoded from "
    "(select *, " + COMMA.join(
        f"cast({a} over ({w}) as double) as {n}" for a, w, n in [
            ("count(*)", "partition by Location", "n"), (f"sum({TARGET})", "partition by Location", "pos"),
            ("count(*)", "partition by Location, fold", "fn"), (f"sum({TARGET})", "partition by Location, fold", "fpos"),
            ("count(*)", "partition by fold", "f_n"), (f"sum({TARGET})", "partition by fold", "f_pos"),
            ("count(*)", "", "all_n"), (f"sum({TARGET})", "", "all_pos")])
    + f" from (select *, floor({_fraction(_digest(KEYS, 42))} * 5) as fold from labelled))", ctes=LABELLED)
SQL["one_hot"] = _with(" union all ".join(
    f"select '{c}' as variable, {c} as category, cast(count(*) as double) as total from filled group by 2"
    for c in WIND_COLUMNS),
    ctes="filled as (select " + COMMA.join(
        f"coalesce({c}, (select {c} from obs where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}"
        for c in WIND_COLUMNS) + " from obs)")
SQL["one_hot_wide"] = _with(
    "select category, row_number() over (order by category) - 1 as position, rows from "
    "(select cast(order_key as varchar) as category, count(*) as rows from obs group by 1)")
SQL["prepare_data"] = _with(
    f"select split, count(*) as rows, cast(sum({TARGET}) as bigint) as positives, min(Date) as first_date, "
    "max(Date) as last_date from parts group by 1", ctes=SPLIT)

# ---- model inputs and metrics ----
SQL["class_weights"] = _with(
    f"select {TARGET}, count(*) as n, "
    f"{_round('(select count(*) from labelled) / (2.0 * count(*))', 'weight')} from labelled group by 1", ctes=LABELLED)
SCORED = LABELLED + (
    f", scored as (select {TARGET} as label, score, case when score >= 0.5 then 1 else 0 end as prediction from labelled)")
SQL["confusion_metrics"] = _with(
    "select tp, fp, fn, tn, " + COMMA.join([
        _round("(tp + tn) / cast(tp + fp + fn + tn as double)", "accuracy"),
        _round("tp / cast(tp + fp as double)", "precision"), _round("tp / cast(tp + fn as double)", "recall"),
        _round("2 * tp / cast(2 * tp + fp + fn as double)", "f1")])
    + " from (select " + COMMA.join(
        f"count(*) filter (where label = {a} and prediction = {p}) as {n}"
        for n, a, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))) + " from scored)",
    "score", ctes=SCORED)
CURVE = SCORED + (
    ", groups as (select score, sum(label) as pos, count(*) - sum(label) as neg from scored group by 1), "
    "curve as (select pos, neg, sum(pos) over w as cp, sum(neg) over w as cn from groups "
    "window w as (order by score desc rows unbounded preceding))")
SQL["roc_auc"] = _with(
    "select " + _round("sum(cast(neg as double) * (cp - pos + pos / 2.0)) / (sum(pos) * cast(sum(neg) as double))",
                       "roc_auc") + " from curve", "score", ctes=CURVE)
SQL["average_precision"] = _with(
    "select " + _round("sum(cast(pos as double) * cp / (cp + cn)) / cast(sum(pos) as double)", "pr_auc")
    + " from curve", "score", ctes=CURVE)

assert [c for c, _ in COLUMNS][:23] == OBSERVATION_COLUMNS

# ---- what is written and read back ----
SQL["report_top10"] = f"""select "column", dtype, missing_count, unique_values from ({SQL["missing_report"]})
  order by missing_count desc, "column" limit 10"""
SQL["persisted_splits"] = _with(f"select {COMMA.join(KEYS)}, {TARGET} from parts where split = 'test'", ctes=SPLIT)
SQL["metrics_log"] = SQL["confusion_metrics"]
SQL["predictions_csv"] = SQL["threshold_label"]
SQL["drop_unused"] = _with(f"select {COMMA.join(TEXT)}, {_rounded(NUMERIC_COLUMNS)}, {IDS} from obs")
SQL["scan_series"] = f"select o_orderkey, o_totalprice, o_orderdate from ({SQL['scan_csv']})"

# ---- the stored ensemble ----
def _plain(parts: dict[str, str]) -> str:
    return COMMA.join(f"{e} as {n}" for n, e in parts.items())


RAW_FEATURES = COMMA.join([IDS, "Date", "Location", *NUMERIC_COLUMNS, RAIN_TODAY, _plain(TEMPORAL), _plain(WEATHER)])
PROBABILITY = stored_ensemble().probability_sql()
_LABEL = "case when probability >= 0.5 then 'Yes' else 'No' end"
SQL["stored_batch_predict"] = _with(
    f"select {KEY}, {_LABEL} as rain_tomorrow, {_round('probability', 'probability')} "
    f"from (select {KEY}, {PROBABILITY} as probability from (select {RAW_FEATURES} from obs))")
SQL["stored_stream_score"] = SQL["stored_batch_predict"]
SQL["stored_replay_predict"] = _with(
    f"select Date, Location, {_LABEL} as rain_tomorrow_pred, {_round('probability', 'probability')}, rain_tomorrow_actual "
    f"from (select Date, Location, {PROBABILITY} as probability, rain_tomorrow_actual "
    f"from (select {RAW_FEATURES}, {TARGET} as rain_tomorrow_actual from newest where rn = 1))",
    "import_day", "status", ctes=NEWEST)
_TESTED = SPLIT + (
    f", judged as (select {TARGET} as label, {PROBABILITY} as score from (select {RAW_FEATURES}, {TARGET} from parts where split = 'test')), "
    "counted as (select " + COMMA.join(
        f"cast(count(*) filter (where label = {a} and (score >= 0.5) = {p}) as double) as {n}"
        for n, a, p in (("tp", 1, "true"), ("fp", 0, "true"), ("fn", 1, "false"), ("tn", 0, "false"))) + " from judged), "
    "groups as (select score, sum(label) as pos, count(*) - sum(label) as neg from judged group by 1), "
    "curve as (select pos, neg, sum(pos) over w as cp, sum(neg) over w as cn from groups "
    "window w as (order by score desc rows unbounded preceding))")
SQL["stored_score_report"] = _with(
    "select " + COMMA.join([
        _round("(tp + tn) / (tp + fp + fn + tn)", "accuracy"), _round("2 * tp / (2 * tp + fp + fn)", "f1"),
        "(select " + _round("sum(cast(neg as double) * (cp - pos + pos / 2.0)) / (sum(pos) * cast(sum(neg) as double))", "x") + " from curve) as roc_auc",
        "(select " + _round("sum(cast(pos as double) * cp / (cp + cn)) / cast(sum(pos) as double)", "x") + " from curve) as pr_auc",
        _round("tp / (tp + fp)", "precision"), _round("tp / (tp + fn)", "recall")]) + " from counted", ctes=_TESTED)
_ROOTS = [(t, f, cut, left) for t, i, f, cut, left, *_ in stored_ensemble().node_rows() if i == 0 and f is not None]
SQL["stored_nodes"] = _with(" union all ".join(
    f"select cast({t} as int) as tree, '{f}' as feature, count(*) filter (where coalesce({f} <= {cut!r}, {str(left).lower()})) as rows_left, "
    f"count(*) filter (where not coalesce({f} <= {cut!r}, {str(left).lower()})) as rows_right from (select {RAW_FEATURES} from obs)"
    for t, f, cut, left in _ROOTS))
