from __future__ import annotations

import zlib

import numpy as np
import pytest

from rainloom.llm import common, toxicity as t
from tests.llm.conftest import HARD_TEXTS


def brute_clause(symbols):
    """Clause score by running the five rules by hand over (symbol, weight) pairs."""
    scope, reported, target, insult, threat, score = 0, False, False, False, False, 0.0
    for symbol, weight in symbols:
        factor = 1.0
        if symbol == "I":
            factor = (0.3 if scope else 1) * (0.5 if reported else 1) * (1.25 if target else 1) * (1.1 if insult else 1)
            insult = True
        elif symbol == "T":
            factor = (0.2 if scope else 1) * (0.4 if reported else 1) * (1.5 if target else 1) * (1.2 if threat else 1)
            threat = True
        if symbol in "IT":
            score += weight * factor
        scope = t.SCOPE if symbol == "N" else max(scope - 1, 0) if symbol == "o" else scope
        reported |= symbol == "R"
        target |= symbol == "G"
    return score


def test_composed_grammar_equals_the_rules():
    rng = np.random.default_rng(2)
    scorer = t.Scorer({})
    for _ in range(3000):
        clause = [(str(s), 2.0 if s in "IT" else 0.0) for s in rng.choice(list("ITGNRooo"), rng.integers(1, 12))]
        assert abs(scorer._run(clause) - brute_clause(clause)) < 1e-9


def test_negation_reports_and_targets_change_a_clause():
    scorer = t.Scorer({"idiot": 4.0, "blöd*": 3.0})
    best = lambda text: scorer.features(text)[1]
    assert best("a fine day") == 0 and best("what an IDIOT") == 4.0
    assert best("you idiot") > best("an idiot") > best("he said idiot") > 0
    assert best("not an idiot") < best("an idiot") and best("not. an idiot") == best("an idiot")
    assert best("das blödsinnige") == 3.0 and best("i will kill you") == t.THREAT_WEIGHT


@pytest.fixture(scope="module")
def fitted(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = common.documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    return docs, labels, t.fit(docs, labels)


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    rows = t.score(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    y, s = rows["toxic"].to_numpy(), rows["score"].rank().to_numpy()
    pos = y.sum()
    auc = (s[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))
    assert auc > 0.94 and (rows["predicted"] == y).mean() > 0.97
    assert ((rows["predicted"] == 1) & (y == 0)).sum() <= 0.01 * len(y)


def test_only_training_folds_are_learned(spark, fitted):
    docs, labels, model = fitted
    other = labels.where(~t.held_out("doc_id")).unionByName(
        labels.where(t.held_out("doc_id")).selectExpr("doc_id", "quality", "1 - toxic as toxic"))
    again = t.fit(docs, other)
    assert again.lexicon == model.lexicon and np.allclose(again.coefficients, model.coefficients)


def test_hard_rows_and_missing_labels(spark, docs_of):
    docs = docs_of(HARD_TEXTS)
    labels = spark.createDataFrame([(1, 1), (None, 1)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        model = t.fit(docs, given)
        rows = t.score(docs, model).collect()
        assert sorted((str(r["doc_id"]), r["held_out"]) for r in rows) == sorted(
            (str(i), i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in HARD_TEXTS)
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert t.score(docs.limit(0), model).count() == 0
