from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rainloom.llm import common, mixing
from tests.llm.conftest import HARD_TEXTS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Share again and again until no target is above its limit."""
    sources = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    left, open_, target = 1.5 * sum(sizes.values()), list(sources), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if rate * weight[s] > 2 * sizes[s]]
        if not full:
            target |= {s: rate * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check(docs, slack):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes, total = {}, defaultdict(int)
    for r in rows:
        sizes[r["doc_id"]] = len(WORD.findall(r["text"] or ""))
        total[r["source"]] += sizes[r["doc_id"]]
    target = brute_targets(total)
    source = {r["doc_id"]: r["source"] for r in rows}
    found = mixing.mix_counts(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows)
    taken = defaultdict(int)
    for r in found:
        s = source[r["doc_id"]]
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == total[s]
        assert abs(r["target"] - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in target:
        assert abs(taken[s] - target[s]) <= slack(target[s]), (s, taken[s], target[s])
    return found


def test_targets_and_taken_words(spark):
    found = check(common.documents(spark, SF), lambda t: 0.1 * t + 20)
    again = mixing.mix_counts(common.documents(spark, SF).repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    check(common.documents(spark, "/root/testdata/sf0.01"), lambda t: 0.01 * t + 20)


def test_hard_rows_and_empty_table(spark, docs_of):
    docs = docs_of(HARD_TEXTS)
    check(docs, lambda t: 40000)
    check(docs.withColumn("source", F.when(F.col("doc_id") > 6, F.col("doc_id").cast("string"))), lambda t: 40000)
    assert mixing.mix_counts(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("levels,words", [(None, mixing.PART_WORDS), (3, mixing.PART_WORDS), (None, 3000), (2, 3000)])
def test_mixed_rows_follow_the_counts(spark, levels, words, monkeypatch):
    monkeypatch.setattr(mixing, "PART_WORDS", words)
    docs = common.documents(spark, SF)
    mixed = mixing.mix(docs, levels)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    for r in mixing.mix_counts(docs).collect():
        if r["size"]:
            assert r["taken"] == times[r["doc_id"]] * r["size"]


def test_tree_keeps_quotas_exactly_and_draws_by_share(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 200), (None, 37), ("d", 0)], "source string, n long")
    rows = mixing.split_quotas(quotas, 3).collect()
    sums, shards = Counter(), Counter()
    for r in rows:
        sums[r["source"]] += r["n"]
        shards[r["shard"]] += r["n"]
        assert r["n"] >= 0
    assert sums == Counter({"a": 1000, "b": 200, None: 37, "d": 0})
    assert set(shards) == set(range(8)) and max(shards.values()) - min(shards.values()) <= 3
    a = [r["n"] for r in rows if r["source"] == "a"]
    assert all(105 < n < 145 for n in a) and len(set(a)) > 1
    assert mixing.split_quotas(quotas, 3).collect() == rows


def test_counts_are_those_of_the_drawn_mixture(spark, docs_of, monkeypatch):
    """A unit lost or doubled in the drawing shows in the counts."""
    docs = common.documents(spark, SF)
    intended = {r["doc_id"]: r["size"] * (r["whole"] + r["extra"]) for r in mixing.plan(docs).collect()}
    assert {r["doc_id"]: r["taken"] for r in mixing.mix_counts(docs, 2).collect()} == intended
    twice = docs_of([(1, "a b c"), (1, "a b c"), (2, "d e f g"), (3, "h"), (3, None)])
    assert sum(r["taken"] for r in mixing.mix_counts(twice).collect()) == sum(
        len((r["text"] or "").split()) for r in mixing.mix(twice).collect())
    assign = mixing.assign

    def faulty(planned, levels):
        shards = assign(planned, levels)
        short = F.expr("if(size(shards) > 1, slice(shards, 1, 1), array_repeat(shards[0], 3))")
        return shards.withColumn("shards", short)

    monkeypatch.setattr(mixing, "assign", faulty)
    for r in mixing.mix_counts(docs, 2).collect():
        times = {0: 0, 1: 3, 2: 1}[intended[r["doc_id"]] // max(r["size"], 1)]
        assert r["taken"] == times * r["size"]
