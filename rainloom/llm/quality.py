"""Quality rules: base text rules, then a hashed n-gram classifier with calibrated probability.

Word unigrams, word bigrams and byte 4-grams of a text are hashed into ``2 ** BITS`` buckets each.
A logistic regression over their normalised frequencies is trained on labelled rows, calibrated on a
held-out part, and scored in Arrow batches against fixed thresholds.

Training uses at most ``FIT_ROWS`` labelled rows, chosen by a hash of ``doc_id``; that is the only
bound. Scoring and all counts read every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainloom.llm import common

FIT_ROWS = 2000
BITS = 13
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_QUALITY = 0.5
WINDOW = 5
ROUNDS = 160

#: fixed values: characters counted as symbols
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

BASE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean")
RESULT_SCHEMA = BASE_SCHEMA + ", quality double, kept boolean"


@dataclass(frozen=True)
class QualityModel:
    """Bucket weights of the three families, intercept, and slope and shift of the calibration."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


def _rows(data: np.ndarray, offsets: np.ndarray) -> dict:
    """Words of a slice with their hashes."""
    prefix = common.prefix_sums(data)
    starts, ends, row = common.word_spans(data, offsets)
    return {"prefix": prefix, "starts": starts, "ends": ends, "row": row,
            "hash": common.span_hashes(data, starts, ends, prefix)}


def base_counts(data: np.ndarray, offsets: np.ndarray, words: dict) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every row."""
    n = len(offsets) - 1
    row = words["row"]
    n_words = np.bincount(row, minlength=n)
    in_word = ~common._SPACE[data] & ((data & 0xC0) != 0x80)
    chars = common.per_row(in_word, offsets)
    symbols = common.per_row(_SYMBOL[data], offsets)
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    line_start = np.concatenate((offsets[:-1], breaks + 1))
    line_end = np.concatenate((offsets[1:], breaks))
    line_row = np.concatenate((np.arange(n), owner))
    order = np.lexsort((line_start, line_row))
    line_start, line_row = line_start[order], line_row[order]
    line_end = np.sort(line_end)
    begun = np.zeros(len(data) + 1, np.int64)
    begun[words["starts"]] = 1
    begun = np.concatenate(([0], np.cumsum(begun)))
    filled = begun[line_end] > begun[line_start]
    keys = common.span_hashes(data, line_start[filled], line_end[filled], words["prefix"])
    keys = common.mix(keys ^ common.mix(line_row[filled].astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(line_row[filled], minlength=n)
    dup_lines = lines - np.bincount(line_row[filled][first], minlength=n)
    covered = np.zeros(len(row), bool)
    if len(row) >= WINDOW:
        count = len(row) - WINDOW + 1
        key = common.mix(row[:count].astype(np.uint64))
        for k in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + words["hash"][k:k + count]
        inside = np.flatnonzero(row[:count] == row[WINDOW - 1:])
        twice = inside[common.repeated(common.mix(key[inside]))]
        edge = np.zeros(len(row) + 1, np.int64)
        edge[twice] += 1
        np.subtract.at(edge, twice + WINDOW, 1)
        covered = np.cumsum(edge)[:-1] > 0
    repeat = np.bincount(row[covered], minlength=n)
    return n_words, chars, symbols, dup_lines, repeat


def base_failed(n_words: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)


def _grams(data: np.ndarray, offsets: np.ndarray, words: dict):
    """(row, bucket) pairs of the three families, each with its own range of buckets."""
    shift, size = np.uint64(64 - BITS), 1 << BITS
    row, hashes = words["row"], words["hash"]
    yield row, (hashes >> shift).astype(np.int64)
    if len(row) > 1:
        pair = common.mix(hashes[:-1] * np.uint64(3) + hashes[1:])
        same = row[:-1] == row[1:]
        yield row[:-1][same], (pair[same] >> shift).astype(np.int64) + size
    else:
        yield row[:0], np.zeros(0, np.int64)
    if len(data) >= 4:
        code = data[:-3].astype(np.uint32)
        for k in (1, 2, 3):
            code |= data[k:len(data) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
        bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        same = owner[:-3] == owner[3:]
        yield owner[:-3][same], bucket[same].astype(np.int64) + 2 * size
    else:
        yield row[:0], np.zeros(0, np.int64)


def _mean_weights(data, offsets, words, weights: np.ndarray) -> np.ndarray:
    """Sum over the families of the mean weight of a row's grams."""
    n = len(offsets) - 1
    total = np.zeros(n)
    for row, bucket in _grams(data, offsets, words):
        seen = np.bincount(row, minlength=n)
        total += np.bincount(row, weights[bucket], minlength=n) / np.maximum(seen, 1)
    return total


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 3 << BITS
    for batch in common.slices(batches):
        data, offsets = common.packed(batch.column("text"))
        words = _rows(data, offsets)
        n = batch.num_rows
        parts = [[] for _ in range(n)]
        for row, bucket in _grams(data, offsets, words):
            key, count = np.unique(row.astype(np.int64) * size + bucket, return_counts=True)
            owner = key // size
            share = count / np.maximum(np.bincount(row, minlength=n), 1)[owner]
            for r, (lo, hi) in enumerate(zip(np.searchsorted(owner, np.arange(n)), np.searchsorted(owner, np.arange(n), "right"))):
                parts[r].append((key[lo:hi] % size, share[lo:hi]))
        columns = [np.concatenate([p[0] for p in parts[r]]).astype(np.int32).tobytes() for r in range(n)]
        shares = [np.concatenate([p[1] for p in parts[r]]).astype(np.float32).tobytes() for r in range(n)]
        yield common.record_batch("label double, buckets binary, shares binary",
                                  batch.column("label").to_numpy(zero_copy_only=False), columns, shares)


def labelled_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids, the same ones on every run: ordered by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    once = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("double").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> QualityModel | None:
    """Train on labelled rows; None if the labels found have fewer than two classes or five rows."""
    chosen = labelled_sample(labels, "quality", limit)
    rows = (common.id_and_text(docs).join(F.broadcast(chosen), "doc_id")      # at most `limit` ids
            .select("label", "text").mapInArrow(_training_rows, "label double, buckets binary, shares binary"))
    frame = rows.toPandas()
    if len(frame) < 5 or frame["label"].nunique() < 2:
        return None
    frame["size"] = frame["buckets"].map(len)
    frame = frame.sort_values(["size", "buckets"], ignore_index=True)          # order of arrival is not fixed
    y = frame["label"].to_numpy()
    columns = np.concatenate([np.frombuffer(b, np.int32) for b in frame["buckets"]])
    values = np.concatenate([np.frombuffer(b, np.float32) for b in frame["shares"]])
    row = np.repeat(np.arange(len(y)), [len(b) // 4 for b in frame["buckets"]])
    del frame
    size = 3 << BITS
    mean = np.bincount(columns, values, size) / len(y)
    scale = 1.0 / np.sqrt(mean + 1e-4)
    values *= scale[columns]
    held = np.arange(len(y)) % 5 == 0
    held &= len(y) >= 50
    train = (~held)[row]
    w, b = _train(row[train], columns[train], values[train], y, ~held, size)
    margin = np.bincount(row, values * w[columns], len(y)) + b
    fitted = held if held.any() and len(set(y[held])) == 2 else np.ones(len(y), bool)
    slope, shift = common.fit_logistic(margin[fitted, None], y[fitted], ridge=1e-4)
    return QualityModel((w * scale).astype(np.float64), float(b), float(slope), float(shift))


def _train(row, columns, values, y, used, size, ridge: float = 1e-4):
    """Full-batch Adam on the logistic loss."""
    w, b, m, v = np.zeros(size), 0.0, np.zeros(size + 1), np.zeros(size + 1)
    n = used.sum()
    for step in range(1, ROUNDS + 1):
        z = np.bincount(row, values * w[columns], len(y)) + b
        error = np.where(used, common.sigmoid(z) - y, 0.0) / n
        gradient = np.append(np.bincount(columns, values * error[row], size) + ridge * w, error.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient ** 2
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def score(docs: DataFrame, model: QualityModel | None, threshold: float = MIN_QUALITY) -> DataFrame:
    """One row per document (``RESULT_SCHEMA``).

    A null or empty text has no words and fails the base rules. ``quality`` is the calibrated
    probability of a good text (null without a model). ``kept`` is false if the base rules fail or
    the probability lies below ``threshold``. Repeated rows are judged alike, each on its own.
    """
    def judge(batches):
        for batch in common.slices(batches):
            data, offsets = common.packed(batch.column("text"))
            words = _rows(data, offsets)
            n_words, chars, symbols, dup, repeat = base_counts(data, offsets, words)
            failed = base_failed(n_words, repeat)
            if model is None:
                quality, kept = [None] * batch.num_rows, ~failed
            else:
                margin = _mean_weights(data, offsets, words, model.weights) + model.intercept
                quality = common.sigmoid(model.slope * margin + model.shift)
                kept = ~failed & (quality >= threshold)
            yield common.record_batch(RESULT_SCHEMA, batch.column("doc_id"), n_words, chars, symbols, dup, repeat, failed, quality, kept)

    return common.id_and_text(docs).mapInArrow(judge, RESULT_SCHEMA)


def keep_good(docs: DataFrame, model: QualityModel | None, threshold: float = MIN_QUALITY) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns."""
    names = docs.columns
    text = names.index("text")

    def keep(batches):
        for batch in common.slices(batches):
            data, offsets = common.packed(batch.column(text))
            words = _rows(data, offsets)
            n_words, *_, repeat = base_counts(data, offsets, words)
            kept = ~base_failed(n_words, repeat)
            if model is not None:
                margin = _mean_weights(data, offsets, words, model.weights) + model.intercept
                kept &= common.sigmoid(model.slope * margin + model.shift) >= threshold
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
