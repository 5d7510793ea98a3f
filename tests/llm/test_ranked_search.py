from __future__ import annotations

import math
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom.llm import common, ranked_search
from rainloom.session import scratch_dir
from tests.llm.conftest import HARD_TEXTS, SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, top=20):
    held = [(d, terms(t)) for d, t in docs if terms(t)]
    n_docs, n_terms, holders = len(held), sum(len(t) for _, t in held), {}
    for _, words in held:
        for w in set(words):
            holders[w] = holders.get(w, 0) + 1
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for w, df in holders.items()}
    result = []
    for item, text in items:
        scores = []
        for d, words in held:
            m = 100 - 25 + (25 * len(words) * n_docs) // n_terms
            score = 0
            for w in terms(text):
                tf = words.count(w)
                if tf:
                    score += weight[w] * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, d is not None, d or 0, d))
        result += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top])]
    return sorted(result, key=str)


def result_of(spark, items, docs, **limits):
    path = scratch_dir(spark, "search")
    ranked_search.write_index(docs, path, **limits)
    return sorted((tuple(r) for r in ranked_search.search(items, path).collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"shard_docs": 7}])
def test_equal_brute_force_on_benchmark(spark, limits):
    docs, items = common.documents(spark, SF), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([tuple(r) for r in items.select("item_id", "text").collect()],
                 [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert result_of(spark, items, docs, **limits) == want


def test_equal_sql(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
    import check_oracle

    good, note = check_oracle.compare(spark, check_oracle.connect(SF), "op12_ranked_search", SF)
    assert good, note


def test_ties_hard_rows_and_repeated_items(spark, docs_of):
    rows = HARD_TEXTS + [(i, "alpha beta") for i in range(40, 70)] + [(None, "alpha beta"), (3, "ALPHA-beta"), (50, "word gamma é")]
    items = [(1, "beta"), (2, ""), (3, None), (4, "no such zzz"), (5, "word é one no alpha alpha"), (5, "word é one no alpha alpha"), (None, "x 85d")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns({"score": F.lit(1), "item": F.lit("x"), "rank": F.lit(0)})
    for limits in ({}, {"shard_docs": 3}, {"shard_postings": 50}):
        assert result_of(spark, frame, docs_of(rows), **limits) == brute(items, rows)
    assert result_of(spark, frame, docs_of(rows).limit(0)) == []
    assert result_of(spark, frame.limit(0), docs_of(rows)) == []


def test_items_in_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEM_ROWS", 2)
    rows = [(i, f"a{i % 5} b{i % 7} c{i % 3} {'pad ' * (i % 4)}") for i in range(60)]
    items = [(i, f"a{i} b{i} pad") for i in range(5)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert result_of(spark, frame, docs_of(rows)) == brute(items, rows)


@pytest.mark.parametrize("opened", [1, 3, 96])
def test_treap_search_equals_the_grid(opened, monkeypatch):
    monkeypatch.setattr(ranked_search, "OPENED", opened)
    rng = np.random.default_rng(opened)
    for height, full in ((1, 3), (4, 60), (6, 900)):
        cells = rng.choice(4 ** height, full, replace=False)
        rows, cols, values = cells >> height, cells & ((1 << height) - 1), rng.integers(1, 6, full)
        bits, maxima = ranked_search.build_treap(rows, cols, values, height)
        treap = ranked_search.Treap(height, bits, maxima)
        grid = np.zeros((1 << height, 1 << height), np.int64)
        grid[rows, cols] = values
        for _ in range(5):
            asked = rng.choice(1 << height, min(4, 1 << height), replace=False)
            weights = rng.integers(1, 9, len(asked))
            scores = weights @ grid[asked]
            want = sorted((-s, c) for c, s in enumerate(scores.tolist()) if s > 0)[:5]
            assert treap.search(asked, weights, 5) == [(-s, c) for s, c in want]


def test_few_ranges_are_opened_for_a_rare_term(monkeypatch):
    seen = []
    rng = random.Random(1)
    rows, cols = zip(*sorted({(rng.randrange(64), rng.randrange(4096)) for _ in range(9000)}))
    rows, cols = np.array([*rows, 3000]), np.array([*cols, 1234])
    bits, maxima = ranked_search.build_treap(rows, cols, np.ones(len(rows), np.int64), 12)
    treap = ranked_search.Treap(12, bits, maxima)

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    treap.bits = bits.view(Counted)
    assert treap.search(np.array([3000]), np.array([1]), 20) == [(1, 1234)]
    assert sum(seen) < 60


def test_the_index_is_written_range_by_range(spark, docs_of, tmp_path):
    """A range is up to 20 MB; the writer must not hold all ranges of a task."""
    import pyarrow.parquet as pq

    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(60_000))) for i in range(40)]
    ranked_search.write_index(docs_of(rows).coalesce(1), f"{tmp_path}/index", shard_docs=1)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "index" / "shards").glob("*.parquet")]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40 and len(groups) > 1
    assert max(g.total_byte_size for g in groups) < 40 << 20
