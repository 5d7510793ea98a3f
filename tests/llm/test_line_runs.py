from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from rainloom.llm import common, line_runs
from tests.llm.conftest import HARD_TEXTS, SF


def brute(rows, m):
    """Later copies of every run of m lines, by a dictionary of all runs."""
    rows = sorted({(line_runs.NULL_ID if i is None else i, t or "") for i, t in rows})
    texts = [(i, t.split("\n")) for i, t in rows]
    filled = [[(k, x) for k, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")] for _, lines in texts]
    seen, out = {}, {}
    for d, words in enumerate(filled):
        for p in range(len(words) - m + 1):
            seen.setdefault(tuple(x for _, x in words[p:p + m]), (d, p))
    for d, ((i, lines), words) in enumerate(zip(texts, filled)):
        gone = set()
        for p in range(len(words) - m + 1):
            if seen[tuple(x for _, x in words[p:p + m])] != (d, p):
                gone.update(range(p, p + m))
        numbers = {words[p][0] for p in gone}
        kept = "\n".join(x for k, x in enumerate(lines) if k not in numbers)
        out[(i, "\n".join(lines))] = (len(words), len(gone), sum(p - 1 not in gone for p in gone), kept)
    return out


def check(docs, m=line_runs.MIN_LINES):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, m)
    expected = Counter((i, *want[(line_runs.NULL_ID if i is None else i, t or "")]) for i, t in rows)
    found = Counter(tuple(r) for r in line_runs.delete_runs(docs, m).collect())
    assert found == expected
    return expected


def test_equal_brute_force_and_sql(spark):
    expected = check(common.documents(spark, SF))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert Counter(con.execute(line_runs.SQL).fetchall()) == expected
    assert any(r[2] for r in expected)


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_random_lines(spark, docs_of, m):
    rng = random.Random(m)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "a "]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    check(docs_of(rows), m)


def test_hard_rows_and_empty_table(spark, docs_of):
    rows = HARD_TEXTS + [(50, "l1\nl2\nl3\nl4"), (51, "x\nl2\nl3\nl4\ny"), (None, "l1\nl2\nl3"), (52, "\n".join(f"n{i}" for i in range(20000))),
                         (53, "\n".join(f"n{i}" for i in range(10000, 20000))), (54, "r\n" * 5000)]
    check(docs_of(rows))
    assert line_runs.delete_runs(docs_of(rows).limit(0)).count() == 0
