"""Latest imported version of each record."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rainloom.operators.cleaning import check_date, check_lookup
from rainloom.schema import IMPORT_DATE, LOOKUP_FEATURES, RAW_TO_OBSERVATION
from rainloom.session import materialize

#: keys whose newest versions are copied to every task
NEWEST_KEYS = 500_000


def latest_observation(
    df: DataFrame, keys: Sequence[str] = ("date", "location"), version_col: str = IMPORT_DATE,
    tie_cols: Sequence[str] = (), columns: Sequence[str] | None = None,
) -> DataFrame:
    """For every key, the row with the greatest version (then the greatest ``tie_cols``, then the
    greatest hash of the row, so that reruns agree).

    The newest version of every key is found first, from the keys and versions alone, and kept as a
    table. Rows of older versions then go before anything is sorted or shuffled; among the rest a
    maximum per key combines on the map side, so a key with many versions sends one row per task.
    More than ``NEWEST_KEYS`` keys are not copied to the tasks, there the maximum takes all rows.
    """
    chosen = [c for c in (columns or df.columns) if c not in keys]
    order = F.struct(*[F.col(c) for c in (version_col, *tie_cols)], F.xxhash64(*[F.col(c) for c in chosen]))
    last = df if df.isStreaming else _newest_only(df, list(keys), version_col)
    newest = last.groupBy(*keys).agg(F.max_by(F.struct(*chosen), order).alias("_r"))
    return newest.select(*keys, "_r.*")


def _newest_only(df: DataFrame, keys: list[str], version_col: str) -> DataFrame:
    """The rows of every key's greatest version."""
    names = {c: f"_newest_{i}" for i, c in enumerate([*keys, version_col])}
    top = materialize(df.groupBy(*[F.col(c).alias(names[c]) for c in keys]).agg(F.max(version_col).alias(names[version_col])),
                      "newest", keep=True)
    if top.count() > NEWEST_KEYS:
        return df
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(F.broadcast(top), functools.reduce(lambda a, b: a & b, same), "left_semi")


def observation_at(
    df: DataFrame, date: str, location: str, columns: Sequence[str] | None = None,
    date_col: str = "date", location_col: str = "location", version_col: str = IMPORT_DATE,
) -> DataFrame:
    """Latest version of one station day; the equality filters reach the scan."""
    check_date(date)
    hit = df.where((F.col(date_col) == date) & (F.col(location_col) == location))
    return hit.orderBy(F.desc(version_col)).limit(1).select(*(columns or df.columns))


def feature_lookup(
    df: DataFrame, feature: str, keys: Sequence[str] = ("date", "location"),
    version_col: str = IMPORT_DATE, tie_cols: Sequence[str] = (),
) -> DataFrame:
    """Latest value of one allowed measurement for every key."""
    if feature not in LOOKUP_FEATURES:
        raise ValueError(f"{feature!r} is not available")
    column = _column_named(df, feature)
    found = latest_observation(df, keys, version_col, tie_cols, [column])
    return found.select(*keys, F.lit(feature).alias("feature"), F.col(column).alias("value"))


def feature_at(df: DataFrame, date: str, location: str, feature: str = "Rainfall", **names: str) -> DataFrame:
    """Latest value of one allowed measurement for one station day."""
    check_lookup(feature, date)
    return observation_at(df, date, location, [_column_named(df, feature)], **names)


def all_features_at(df: DataFrame, date: str, location: str, **names: str) -> DataFrame:
    """Latest values of all allowed measurements for one station day."""
    return observation_at(df, date, location, [_column_named(df, f) for f in LOOKUP_FEATURES], **names)


def rename_project(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Table columns under their analytic names, nothing else."""
    names = RAW_TO_OBSERVATION if mapping is None else mapping
    return df.select(*[F.col(k).alias(v) for k, v in names.items()])


def _column_named(df: DataFrame, feature: str) -> str:
    return feature if feature in df.columns else feature.lower()
