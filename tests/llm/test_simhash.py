from __future__ import annotations

import random
import re

import xxhash
import pytest

from rainloom.llm import common, simhash
from tests.llm.conftest import HARD_TEXTS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{p:016x}", low.get(find(i))) for i, (d, p) in enumerate(zip(ids, prints))), key=str)


def result_of(docs):
    return sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)


@pytest.mark.parametrize("sf", [SF])
def test_equal_brute_force(spark, sf):
    docs = common.documents(spark, sf)
    rows = docs.select("doc_id", "text").collect()
    assert result_of(docs) == brute_components([r[0] for r in rows], [brute_print(r[1]) for r in rows])


def test_hard_rows_and_empty_table(spark, docs_of):
    docs = docs_of(HARD_TEXTS)
    assert result_of(docs) == brute_components([i for i, _ in HARD_TEXTS], [brute_print(t) for _, t in HARD_TEXTS])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and None in ids and 1 in ids and 2 not in ids


def test_links_of_dense_groups(spark):
    """Chains and balls of fingerprints around common centres, against all pairs."""
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(40):
            y = x
            for _ in range(rng.randrange(5)):
                y ^= 1 << rng.randrange(64)
            prints.append(y)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    want = brute_components(signed, prints)
    assert {d: roots.get(d, d) for d in signed} == {d: c for d, _, c in want}


def test_keep_one_tells_components_apart_where_ids_repeat(spark, docs_of):
    a, b = "red apples fall from old trees", "seven ships sail past the harbour wall"
    kept = lambda rows: sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs_of(rows)).select("doc_id", "text").collect())
    assert kept([(5, a), (5, b)]) == [(5, a), (5, b)]
    assert kept([(4, a.upper()), (5, a), (5, b)]) == [(4, a.upper()), (5, b)]
    assert kept([(5, a), (5, a), (5, a.upper()), (5, b)]) == sorted([(5, min(a, a.upper())), (5, b)])
    many = [(7, f"only text number {i} of many with word{i * i} in it") for i in range(40)]
    prints = [brute_print(t) for _, t in many]
    assert len(kept(many + [(9, a)])) == 1 + len({c for _, _, c in brute_components(list(range(40)), prints)})
