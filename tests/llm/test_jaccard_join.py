from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rainloom.llm import common, jaccard_join
from tests.llm.conftest import HARD_TEXTS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """All pairs that share an n-gram, exact sets, components by union-find."""
    sets = [brute_set(t) for _, t in rows]
    root, holders = list(range(len(rows))), {}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result_of(docs):
    return sorted((tuple(r) for r in jaccard_join.components_of(docs).collect()), key=str)


def edited(rng, words, share):
    words = list(words)
    for _ in range(max(1, round(share * len(words) / 5))):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def clusters(seed, sizes, copies, shares=(0.02, 0.08, 0.11, 0.2)):
    rng, rows = random.Random(seed), []
    for size in sizes:
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        rows.append(base)
        for _ in range(copies):
            rows.append(edited(rng, rng.choice(rows[-3:]) if rng.random() < 0.3 else base, rng.choice(shares)))
            if rng.random() < 0.2:
                rows.append(rows[-1] + [f"tail{rng.randrange(99)}" for _ in range(rng.randrange(size // 4 + 1))])
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_equal_brute_force_on_documents(spark):
    docs = common.documents(spark, SF)
    assert result_of(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_similarity_at_the_edge(spark, docs_of):
    rows = clusters(3, [5, 6, 9, 14, 30, 77, 300], 12)
    assert result_of(docs_of(rows)) == brute(rows)


@pytest.mark.parametrize("hot", [1, 4])
def test_frequent_subsets_take_the_neighbourhoods(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rows = clusters(8, [7, 12, 25, 60, 140], 25)
    assert result_of(docs_of(rows)) == brute(rows)


def test_hard_rows_and_empty_table(spark, docs_of):
    docs = docs_of(HARD_TEXTS)
    assert result_of(docs) == brute(HARD_TEXTS)
    assert jaccard_join.components_of(docs.limit(0)).count() == 0
    assert jaccard_join.components_of(docs).columns == ["doc_id", "n_shingles", "component_id"]


def test_a_large_group_gives_few_pairs(spark, docs_of, monkeypatch):
    compared = []
    verified = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: (compared.append(pairs.count()), verified(pairs, *rest))[1])
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, 0.06))) for i in range(300)] + [(300, " ".join(base))]
    assert result_of(docs_of(rows)) == brute(rows)
    assert sum(compared) < 20 * len(rows)


def test_near_misses_of_one_text_are_not_compared_pair_by_pair(spark, docs_of, monkeypatch):
    compared = []
    verified = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: (compared.append(pairs.count()), verified(pairs, *rest))[1])
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, share))) for i, share in enumerate([0.03] * 60 + [0.14] * 120)] + [(180, " ".join(base))]
    assert result_of(docs_of(rows)) == brute(rows)
    assert sum(compared) < len(rows)


def test_sizes_and_weights():
    rule = jaccard_join.Rule()
    n = np.arange(1, 3000)
    band, t, h, t_above, h_above = rule.roles(n)
    assert (n <= rule.upper[band]).all() and (h < t).all() and (t <= rule.segments[band]).all()
    assert (t_above <= rule.segments[band + 1]).all()
    for a in range(1, 400):
        for b in range(a, rule.largest(a) + 1):
            own = band[a - 1] == band[b - 1]
            assert own or (band[b - 1] - band[a - 1] == 1 and t_above[a - 1])
            used, budget = (t[a - 1], h[a - 1]) if own else (t_above[a - 1], h_above[a - 1])
            assert rule.budget(a, b) <= budget <= h[b - 1] and used <= t[b - 1]
            # so many of the smaller set's segments agree; both sets then have candidates
            assert used - rule.budget(a, b) >= max(used - budget, t[b - 1] - h[b - 1])
    assert jaccard_join.allocate([0, 9, 5], [2, 1, 7], 3) == [2, 0, 1]
    assert jaccard_join.allocate([3, 1], [0, 0], 4) == [2, 2]


def test_sketches_never_underrate():
    rng = np.random.default_rng(7)
    for n in (1, 5, 300, 20000):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate((x[: n // 2], rng.integers(0, 1 << 63, n // 3 + 1, dtype=np.uint64))))
        both = len(np.intersect1d(x, y))
        assert jaccard_join.exactly_shared(x, y) == both <= jaccard_join.most_shared(jaccard_join.sketch(x), jaccard_join.sketch(y))
