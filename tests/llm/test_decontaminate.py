from __future__ import annotations

import random

from rainloom.llm import common, decontaminate as d
from tests.llm.conftest import HARD_TEXTS, SF


def edit_distance_inside(item, text):
    """Least edits between the item and any part of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        above, row[0] = row[:], 0
        for i, x in enumerate(item, 1):
            row[i] = min(above[i] + 1, row[i - 1] + 1, above[i - 1] + (x != c))
        best = min(best, row[-1])
    return best


def brute(text, items):
    text = d.normalise(text)
    return sorted({k for k, raw in items if (t := d.normalise(raw)) and edit_distance_inside(t, text) <= d.budget(len(t))})


def test_edits_equal_brute_force(spark):
    rng = random.Random(1)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))

    items = [(i, words(rng.randint(2, 25))) for i in range(12)] + [(3, words(20)), (50, ""), (51, " "), (None, "x y"), (52, None)]
    docs = []
    for i in range(60):
        body = list(rng.choice(items[:13])[1])
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(body))
            body[at:at + rng.randint(0, 1)] = rng.choice("abcz ") * rng.randint(0, 1)
        docs.append((i, words(10) + "".join(body).upper().replace(" ", "\n ") + words(10)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: r["items"] for r in d.matches(frame, bench).collect()}
    want = {i: brute(t, [x for x in items if x[0] is not None]) for i, t in docs}
    assert found == want and 10 < sum(map(bool, want.values())) < 60


def test_blocks_give_the_same(spark, monkeypatch):
    docs, bench = common.documents(spark, SF), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, d.matches(docs, bench).select("doc_id", "n_items").collect()))
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in bench.collect() if d.normalise(t) in d.normalise(r["text"])}
    found = {(r["doc_id"], i) for r in d.matches(docs, bench).collect() for i in r["items"]}
    assert exact and exact <= found
    monkeypatch.setattr(d, "BLOCK_CHARS", 1500)
    assert sorted(map(tuple, d.matches(docs, bench).select("doc_id", "n_items").collect())) == whole


def test_hard_rows_and_empty_tables(spark, docs_of):
    docs = docs_of(HARD_TEXTS)
    bench = spark.createDataFrame([(1, "no id HERE at all"), (2, "same line same line")], "item_id long, text string")
    found = [(r["doc_id"], r["items"]) for r in d.matches(docs, bench).collect()]
    assert len(found) == len(HARD_TEXTS) and (None, [1]) in found and found.count((8, [2])) == 2
    kept = d.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(HARD_TEXTS) - 3
    assert d.matches(docs.limit(0), bench).count() == 0
    assert d.matches(docs, bench.limit(0)).where("contaminated").count() == 0


def test_several_blocks_keep_rows_and_clashing_columns(spark, docs_of, monkeypatch):
    bench = spark.createDataFrame(
        [(1, "no id HERE at all"), (2, "same line same line"), (2, "another text of item two"), (None, "x"), (4, None), (5, " ")],
        "item_id long, text string")
    docs = docs_of(HARD_TEXTS + [(70, "see: Another  text of item two")] * 3).selectExpr("*", "1L as item")
    one = sorted(map(str, d.matches(docs, bench).collect()))
    kept = sorted(map(str, d.remove_contaminated(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 1)
    assert sorted(map(str, d.matches(docs, bench).collect())) == one and sum("items=[2]" in r for r in one) >= 5
    several = d.remove_contaminated(docs, bench)
    assert several.columns == docs.columns and sorted(map(str, several.collect())) == kept
    assert d.matches(docs.limit(0), bench).count() == 0
    with_nothing = bench.where("item_id is null or text is null")
    assert d.remove_contaminated(docs, with_nothing).count() == docs.count()
