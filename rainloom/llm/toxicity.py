"""Toxicity by a weighted finite-state pattern grammar over clauses.

The grammar composes five small transducers over the symbols of a clause: insult, threat, target,
negation and reported speech. Insult and threat write weighted matches, target strengthens them,
negation and reported speech weaken what follows. Clauses, not isolated words, are scored; a
document's clause scores are turned into a probability.

Lexical entries (whole words and word beginnings) with their weights and the final calibration are
learned from labelled rows outside the held-out fold. At most ``FIT_ROWS`` labelled rows, chosen by a
hash of ``doc_id``, are used; that is the only bound. Scoring reads every row and whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rainloom.llm import common
from rainloom.llm.quality import labelled_sample
from rainloom.session import materialize

FIT_ROWS = 12_000
FOLDS = 5
THRESHOLD = 0.5
#: lengths of learned word beginnings, least toxic documents of an entry, and its least log odds:
#: the estimate less ``CAUTION`` standard errors must exceed it
STEMS = range(5, 9)
MIN_DOCS = 5
MIN_ODDS = 1.0
CAUTION = 3.0

#: fixed values: the classes of function words that the grammar knows
TARGETS = frozenset("you your yours he she they him her them his their du dich dir ihr euch er sie tu toi te vous il elle ils elles tú te usted vosotros él ella ellos".split())
NEGATIONS = frozenset("not no never none isn't aren't wasn't don't doesn't didn't won't nicht kein keine nie niemals ne pas jamais aucun non nunca jamás ningún".split())
REPORTS = frozenset("said says say wrote quoted quote reported called according sagte schrieb laut zitierte dit disait selon écrit dijo según escribió citó".split())
THREATS = frozenset("kill hurt destroy burn shoot stab beat töten schlagen verletzen tuer frapper détruire matar golpear destruir".split())
#: weight of a threat word that the training rows say nothing about
THREAT_WEIGHT = 1.0

_CLAUSE = re.compile(r"[.!?;:\n,|]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
#: most other words that still separate a negation from what it governs
SCOPE = 3

RESULT = "doc_id long, held_out boolean, score double, predicted int, n_clauses long"


@dataclass(frozen=True)
class Transducer:
    """Deterministic weighted transducer over symbols.

    ``moves[state][symbol] = (next state, output symbol, factor)``; a missing move keeps state and
    symbol with factor 1. The factor multiplies the weight of the word that is read.
    """

    moves: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.moves.get(state, {}).get(symbol, (state, symbol, 1.0))


# symbols: I insult, T threat, G target, N negation, R report, o any other word
_NEGATE = Transducer({
    0: {"N": (SCOPE, "N", 1.0)},
    **{k: {"o": (k - 1, "o", 1.0), "N": (SCOPE, "N", 1.0), "I": (k, "I", 0.3), "T": (k, "T", 0.2)} for k in range(1, SCOPE + 1)},
})
_REPORT = Transducer({
    0: {"R": (1, "R", 1.0)},
    1: {"I": (1, "I", 0.5), "T": (1, "T", 0.4)},
})
_TARGET = Transducer({
    0: {"G": (1, "G", 1.0)},
    1: {"I": (1, "I", 1.25), "T": (1, "T", 1.5)},
})
_INSULT = Transducer({0: {"I": (1, "m", 1.0)}, 1: {"I": (1, "m", 1.1)}})
_THREAT = Transducer({0: {"T": (1, "m", 1.0)}, 1: {"T": (1, "m", 1.2)}})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Feed the output of the first into the second; states are pairs, factors multiply."""
    start, symbols = (0, 0), "ITGNRo"
    moves, todo = {}, [start]
    while todo:
        a, b = state = todo.pop()
        if state in moves:
            continue
        moves[state] = {}
        for symbol in symbols:
            a2, middle, f = first.step(a, symbol)
            b2, out, g = second.step(b, middle)
            moves[state][symbol] = ((a2, b2), out, f * g)
            todo.append((a2, b2))
    return _numbered(moves, start)


def _numbered(moves: dict, start) -> Transducer:
    names = {start: 0}
    for state in moves:
        names.setdefault(state, len(names))
    return Transducer({names[s]: {x: (names[n], o, f) for x, (n, o, f) in row.items()} for s, row in moves.items()})


def grammar() -> Transducer:
    """Negation, reported speech, target, insult and threat, one after another."""
    machine = _NEGATE
    for part in (_REPORT, _TARGET, _INSULT, _THREAT):
        machine = compose(machine, part)
    return machine


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of lexical entries (word, or ``stem*``) and the coefficients of the calibration."""

    lexicon: dict
    coefficients: np.ndarray | None


class Scorer:
    """Clause scores of texts under a lexicon; words are classified once and remembered."""

    REMEMBER = 300_000

    def __init__(self, lexicon: dict):
        self.lexicon, self.machine, self.known = lexicon, grammar().moves, {}
        #: a lexicon may have beginnings of any length, whatever lengths are learned
        self.stems = sorted({len(e) - 1 for e in lexicon if e.endswith("*")})

    def _classify(self, word: str) -> tuple[str, float] | None:
        entries = [self.lexicon[e] for e in entries_of(word, self.stems) if e in self.lexicon]
        if entries:
            return "T" if word in THREATS else "I", max(entries)
        for symbol, words in (("T", THREATS), ("G", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            if word in words:
                return symbol, THREAT_WEIGHT if symbol == "T" else 0.0
        return None

    def features(self, text: str) -> list[float]:
        """Log of the summed clause scores, the best clause, matched clauses, and matches per word."""
        known = self.known
        if len(known) > self.REMEMBER:
            known.clear()
        total = best = 0.0
        matched = n = 0
        for clause in _CLAUSE.split(text.lower()):
            words = _WORD.findall(clause)
            n += len(words)
            for w in words:
                if w not in known:
                    known[w] = self._classify(w)
            classes = [known[w] for w in words]
            if any(c is not None and c[1] for c in classes):
                score = self._run(classes)
                total += score
                best = max(best, score)
                matched += 1
        return [np.log1p(total), best, float(matched), total / (n + 20.0)]

    def _run(self, classes) -> float:
        state, score = 0, 0.0
        for c in classes:
            symbol, weight = c or ("o", 0.0)
            state, out, factor = self.machine[state][symbol]
            if out == "m":
                score += weight * factor
        return score


def entries_of(word: str, stems: Iterable[int] = STEMS) -> list[str]:
    """The lexical entries a word can match: itself and its beginnings."""
    return [word, *(word[:k] + "*" for k in stems if len(word) >= k)]


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0


def learn_lexicon(rows: DataFrame) -> dict:
    """Entries whose presence tells toxic documents apart, from rows (label, text)."""
    def count(batches):
        seen = {0.0: Counter(), 1.0: Counter()}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                words = set(_WORD.findall(text.lower()))
                seen[label].update({e for w in words for e in entries_of(w)})
        both = sorted(seen[1.0])                      # an entry without toxic documents is never chosen
        yield common.record_batch("entry string, pos long, neg long", both, [seen[1.0][e] for e in both], [seen[0.0][e] for e in both])
        rest = sorted(seen[0.0].keys() - seen[1.0].keys())
        yield common.record_batch("entry string, pos long, neg long", rest, [0] * len(rest), [seen[0.0][e] for e in rest])

    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_pos, n_neg = n.get(1.0, 0), n.get(0.0, 0)
    if not n_pos or not n_neg:
        return {}
    counts = rows.mapInArrow(count, "entry string, pos long, neg long").groupBy("entry").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= MIN_DOCS)
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    chosen = counts.select("entry", odds.alias("odds")).where(odds - CAUTION * error > MIN_ODDS).orderBy("entry")
    return {r["entry"]: r["odds"] for r in chosen.collect()}      # at most FIT_ROWS rows' entries with MIN_DOCS


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> ToxicityModel:
    """Lexicon and calibration from labelled rows outside the held-out fold.

    Without both classes the lexicon is empty and every score is the share of label 1 (0 if none).
    """
    chosen = labelled_sample(labels.where(~held_out("doc_id")), "toxic", limit)
    rows = common.id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")   # at most `limit` ids
    rows = materialize(rows, "toxic-sample")
    lexicon = learn_lexicon(rows)

    def run(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            values = np.array([scorer.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, 4)
            yield common.record_batch("doc_id long, label double, a double, b double, c double, d double", batch.column("doc_id"), batch.column("label"), *values.T)

    frame = rows.mapInArrow(run, "doc_id long, label double, a double, b double, c double, d double").toPandas()
    frame = frame.sort_values(list(frame.columns), ignore_index=True)
    y = frame["label"].to_numpy()
    if not len(y) or len(set(y)) < 2:
        rate = float(np.clip(y.mean() if len(y) else 0.0, 0.0, 1.0))
        return ToxicityModel({}, np.array([0, 0, 0, 0, np.log((rate + 1e-6) / (1 - rate + 1e-6))]))
    return ToxicityModel(lexicon, common.fit_logistic(frame[["a", "b", "c", "d"]].to_numpy(), y))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_clauses`` of every row.

    A null or empty text has no clauses and gets the score of a text without matches. A null id is
    not held out. Repeated rows are scored alike, each on its own.
    """
    def run(batches):
        scorer = Scorer(model.lexicon)
        for batch in batches:
            if batch.num_rows:
                x = np.array([scorer.features(t) for t in batch.column("text").to_pylist()])
                p = common.sigmoid(x @ model.coefficients[:-1] + model.coefficients[-1])
                yield common.record_batch(RESULT, batch.column("doc_id"), batch.column("held_out"), p, (p >= THRESHOLD).astype(np.int32), x[:, 2].astype(np.int64))

    flagged = common.id_and_text(docs).withColumn("held_out", F.coalesce(held_out("doc_id"), F.lit(False)))
    return flagged.mapInArrow(run, RESULT)
