"""Helpers shared by the operators: sessions, Arrow text batches as numpy arrays, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: rows and bytes of one Arrow batch sent to a Python worker; texts can be long
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
#: bytes of text handled at once inside a worker (a longer single text is handled alone)
SLICE_BYTES = 1 << 20

#: fixed values: white space of the word definition ``[^\x20\x09-\x0D]+``
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def tune_arrow(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` with null as the empty text; other columns go."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def record_batch(schema: str, *columns) -> pa.RecordBatch:
    """A batch for ``mapInArrow`` from arrays or lists; ``schema`` as in ``"a long, b binary"``."""
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=_ARROW[k]) for k, c in zip(kinds, columns)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def packed(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the offset of every row (one more than rows)."""
    column = text.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = packed(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` within every row."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.float64 if mask.dtype.kind == "f" else np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits of an unsigned 64-bit array."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte range; equal ranges have equal hashes, wherever they lie."""
    prefix = prefix_sums(data) if prefix is None else prefix
    value = (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(value ^ ((ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data) + 1)[:len(data)]
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not in ``space``; runs end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:]] |= same
    found[order[:-1]] |= same
    return found


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Newton's method for a few dense features; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w * len(x)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty * len(x) + 1e-6)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
