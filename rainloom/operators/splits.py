"""Chronological, expanding-window and stratified splits without a global sort.

A split is a cut in the order (group value, digest of the key columns), where the group is the
date or the class. Counts per group locate the groups that hold cuts; inside them the digests at the
wanted ranks are found by radix selection: one histogram job per digest step serves all cuts. The split
itself is then a comparison with literals: no shuffle of the table, and a group holding a large share
of the rows is only counted, never gathered.

Rows with one key are ordered by a digest of the whole row, which is computed only where a cut falls
among them; such a split is written once, so that no later filter repeats the digest. Rows alike in
every column cannot be told apart: if the cut falls among them, all of them go after it. Rows without a
date come last in time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from rainloom.functions.scalars import digest, digest_fraction
from rainloom.schema import DATE, LOCATION, TARGET
from rainloom.session import materialize

#: digests of one group fetched at once; larger groups are first narrowed by prefix
FETCH_LIMIT = 4096
PREFIX_STEP = 2        # hex digits per narrowing pass: at most 256 counts a cut
DIGEST_DIGITS = 32


def row_digest(df: DataFrame) -> Column:
    """Order of rows of one key: digest of all columns, by name."""
    return digest(*[F.col(f"`{c}`") for c in sorted(df.columns)])


@dataclass(frozen=True)
class Cut:
    """Rows before the cut have a smaller group (NULL is the largest), or the same group and a smaller
    key digest, or the same key digest and a smaller ``tie`` (a digest of the whole row)."""

    position: int
    group: Any
    digest: str
    tie: str | None = None

    def inside(self, key: Column, row: Column) -> Column:
        """Is a row of the cut's group before the cut?"""
        below = key < F.lit(self.digest)
        if self.tie is None:
            return below
        return below | F.when(key == F.lit(self.digest), row < F.lit(self.tie)).otherwise(F.lit(False))

    def before(self, group_col: str, key: Column, row: Column) -> Column:
        group = F.col(group_col)
        if self.group is None:
            return group.isNotNull() | self.inside(key, row)
        return F.coalesce((group < F.lit(self.group)) | ((group == F.lit(self.group)) & self.inside(key, row)), F.lit(False))


@dataclass(frozen=True)
class _Seek:
    """A search for the digest at ``rank`` among the ``count`` digests of ``place`` under ``prefix``."""

    place: int
    rank: int
    count: int
    prefix: str = ""

    @property
    def wide(self) -> bool:
        return self.count > FETCH_LIMIT and len(self.prefix) < DIGEST_DIGITS


def radix_select(digests: DataFrame, seeks: Sequence[_Seek]) -> list[tuple[str, int]]:
    """For each search the digest at its rank and how many rows of that digest come before the rank.

    ``digests`` has the columns ``place`` and ``d``. Every step narrows all searches together by one
    count per (search, next prefix); what is left is fetched together, so the number of jobs does not
    depend on the number of searches.
    """
    spark, seeks = digests.sparkSession, list(seeks)

    def under(chosen: list[int]) -> DataFrame:
        table = spark.createDataFrame(
            [(i, seeks[i].place, seeks[i].prefix) for i in chosen], "i int, at int, prefix string")
        return digests.join(F.broadcast(table), (F.col("place") == F.col("at")) & F.col("d").startswith(F.col("prefix")))

    while wide := [i for i, s in enumerate(seeks) if s.wide]:
        step = F.substring(F.col("d"), F.lit(1), F.length("prefix") + PREFIX_STEP)
        counts = under(wide).groupBy("i", step.alias("p")).count().collect()
        for i, part, n in sorted(map(tuple, counts)):
            seek = seeks[i]
            if len(part) == len(seek.prefix):          # found in this step
                continue
            seeks[i] = replace(seek, prefix=part, count=n) if seek.rank < n else replace(seek, rank=seek.rank - n)
    found = {i: [] for i, s in enumerate(seeks) if s.count <= FETCH_LIMIT}
    for i, d in under(list(found)).select("i", "d").collect() if found else []:
        found[i].append(d)
    result = []
    for i, seek in enumerate(seeks):
        if i not in found:                             # one digest that many rows share
            result.append((seek.prefix, seek.rank))
            continue
        ordered = sorted(found[i])
        result.append((ordered[seek.rank], seek.rank - ordered.index(ordered[seek.rank])))
    return result


def _places(df: DataFrame, tests: Sequence[Column], value: Column, name: str) -> DataFrame:
    """The narrow table (place, d) of the rows that fit a test, written once."""
    place = F.coalesce(*[F.when(t, i) for i, t in enumerate(tests)])
    rows = df.select(place.cast("int").alias("place"), value.alias("d")).where("place is not null")
    return materialize(rows, name)


def find_cuts(
    df: DataFrame, group_col: str, key: Column, wanted: Sequence[tuple[int, Any, int, int]]
) -> list[Cut]:
    """Cuts for ``(position, group, rank inside the group, group size)``, all found together."""
    cuts = [Cut(position, group, "") for position, group, _, _ in wanted]
    inner = [i for i, (_, _, rank, _) in enumerate(wanted) if rank]
    if not inner:
        return cuts
    groups = list(dict.fromkeys(wanted[i][1] for i in inner))
    digests = _places(df, [F.col(group_col).eqNullSafe(F.lit(g)) for g in groups], key, "digests")
    seeks = [_Seek(groups.index(wanted[i][1]), wanted[i][2], wanted[i][3]) for i in inner]
    tied = []
    for i, (d, passed) in zip(inner, radix_select(digests, seeks)):
        cuts[i] = replace(cuts[i], digest=d)
        if passed:
            tied.append((i, passed))
    if tied:
        slices = list(dict.fromkeys((cuts[i].group, cuts[i].digest) for i, _ in tied))
        tests = [F.col(group_col).eqNullSafe(F.lit(g)) & (key == F.lit(d)) for g, d in slices]
        rows = _places(df, tests, row_digest(df), "row_digests")
        sizes = {r["place"]: r["count"] for r in rows.groupBy("place").count().collect()}
        seeks = [_Seek(p := slices.index((cuts[i].group, cuts[i].digest)), passed, sizes[p]) for i, passed in tied]
        for (i, _), (tie, _) in zip(tied, radix_select(rows, seeks)):
            cuts[i] = replace(cuts[i], tie=tie)
    return cuts


def _marked(df: DataFrame, column: str, value: Column, cuts: Sequence[Cut]) -> DataFrame:
    """``df`` with the split column; written once if it depends on digests of whole rows."""
    marked = df.withColumn(column, value)
    return materialize(marked, "split") if any(c.tie is not None for c in cuts) else marked


def group_counts(df: DataFrame, group_col: str) -> list[tuple[Any, int]]:
    """Rows per group value, sorted, NULL last: one row per calendar day or class."""
    counts = [(r[0], r[1]) for r in df.groupBy(group_col).count().collect()]
    return sorted([c for c in counts if c[0] is not None]) + [c for c in counts if c[0] is None]


def chronological_cuts(
    df: DataFrame, positions: Sequence[int], date_col: str, tie_cols: Sequence[str],
    counts: list[tuple[Any, int]] | None = None,
) -> list[Cut]:
    """Cuts at global positions of the order (date, digest of the tie columns)."""
    counts = counts if counts is not None else group_counts(df, date_col)
    wanted, passed, pending = [], 0, sorted(set(positions))
    for group, n in counts:
        while pending and pending[0] < passed + n:
            wanted.append((pending[0], group, pending[0] - passed, n))
            pending.pop(0)
        passed += n
    if pending:
        raise ValueError(f"positions {pending} lie beyond the {passed} rows")
    return find_cuts(df, date_col, digest(*tie_cols), wanted)


def temporal_split(
    df: DataFrame, test_size: float = 0.2, date_col: str = DATE,
    tie_cols: Sequence[str] = (DATE, LOCATION), split_col: str = "split", whole_dates: bool = False,
) -> DataFrame:
    """Mark the first ``int(n * (1 - test_size))`` rows in time order ``train``, the rest ``test``.

    ``tie_cols`` order the rows of a day; they need not identify a row. With ``whole_dates`` the boundary day goes entirely to test,
    so that no day is on both sides.
    """
    if isinstance(date_col, str) and df.schema[date_col].dataType.typeName() != "date":
        raise ValueError(f"{date_col} must be a date")
    counts = group_counts(df, date_col)
    total = sum(n for _, n in counts)
    position = int(total * (1 - test_size))
    if total == 0 or position >= total:
        return df.withColumn(split_col, F.lit("train"))
    cuts: list[Cut] = []
    if whole_dates:
        passed = 0
        for day, n in counts:
            if position < passed + n:
                train = F.col(date_col) < F.lit(day) if day is not None else F.col(date_col).isNotNull()
                break
            passed += n
    else:
        cuts = chronological_cuts(df, [position], date_col, tie_cols, counts)
        train = cuts[0].before(date_col, digest(*tie_cols), row_digest(df))
    return _marked(df, split_col, F.when(train, "train").otherwise("test"), cuts)


def time_series_folds(
    df: DataFrame, n_splits: int = 3, date_col: str = DATE,
    tie_cols: Sequence[str] = (DATE, LOCATION), block_col: str = "block",
) -> DataFrame:
    """Number the expanding-window blocks: block 0 is the first training part, fold ``i`` (from 1)
    validates block ``i`` and trains on every earlier block. Each of the last ``n_splits`` blocks
    has ``n // (n_splits + 1)`` rows."""
    counts = group_counts(df, date_col)
    total = sum(n for _, n in counts)
    size = total // (n_splits + 1)
    if size == 0:
        raise ValueError(f"{total} rows are too few for {n_splits} folds")
    starts = [total - size * k for k in range(n_splits, 0, -1)]
    key, row, block = digest(*tie_cols), row_digest(df), F.lit(0)
    cuts = chronological_cuts(df, starts, date_col, tie_cols, counts)
    for cut in cuts:
        block = block + F.when(cut.before(date_col, key, row), 0).otherwise(1)
    return _marked(df, block_col, block.cast("int"), cuts)


def stratified_split(
    df: DataFrame, label_col: str = TARGET, key_cols: Sequence[str] = (DATE, LOCATION),
    test_size: float = 0.2, seed: int = 42, split_col: str = "split", exact: bool = False,
) -> DataFrame:
    """Reproducible random split with the same class shares on both sides.

    By default each row is placed by its own digest: no pass over the table, class shares hold in
    expectation. ``exact`` places ``test_size`` of every class exactly (largest remainders), by
    cutting each class in digest order; rows without a label are a class of their own.
    """
    if not exact:
        test = digest_fraction(digest(*key_cols, seed=seed)) < F.lit(test_size)
        return df.withColumn(split_col, F.when(test, "test").otherwise("train"))
    key, counts = digest(*key_cols, seed=seed), group_counts(df, label_col)
    total = sum(n for _, n in counts)
    quota = {g: n * test_size for g, n in counts}
    take = {g: int(q) for g, q in quota.items()}
    short = math.ceil(total * test_size) - sum(take.values())
    for g in sorted(quota, key=lambda g: (take[g] - quota[g], g is None, g or 0))[:max(short, 0)]:
        take[g] += 1
    test = F.lit(False)
    partial = [(take[g], g, take[g], n) for g, n in counts if 0 < take[g] < n]
    cuts = find_cuts(df, label_col, key, partial)
    for cut in cuts:
        test = test | (F.col(label_col).eqNullSafe(F.lit(cut.group)) & cut.inside(key, row_digest(df)))
    for g, n in counts:
        if take[g] == n:
            test = test | F.col(label_col).eqNullSafe(F.lit(g))
    return _marked(df, split_col, F.when(test, "test").otherwise("train"), cuts)
