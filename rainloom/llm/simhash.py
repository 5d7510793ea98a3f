"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has a bit for each bit that is set in over half of the hashes of the text's word
shingles. Two fingerprints that differ in at most two bits agree in at least one 32-bit half up to
one bit. For each half the anchors are the words of the perfect Hamming code over 31 bits, times the
free last bit: every half lies within one bit of its own ("home") anchor, so a linked partner lies
within two bits of that anchor (covering radius one plus threshold one). Each fingerprint is therefore
replicated to all anchors within two bits of each half, at most 17 a half, and every anchor compares
its home fingerprints with all of its replicas. Links are contracted to stars as they are found, so
a dense group never writes all its pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from rainloom.llm import common
from rainloom.llm.components import components, contract
from rainloom.session import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: pairs compared at once inside an anchor task
BLOCK = 1 << 20

_LINK = "u long, v long"
_REPLICA = "anchor long, fp long, home boolean"


def _flips() -> np.ndarray:
    """By syndrome: the 16 changes of at most two of 31 bits that lead to a code word (-1: none)."""
    table = np.full((32, 16), -1, np.int64)
    table[0, 0] = 0
    for s in range(1, 32):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s]
        table[s] = [1 << (s - 1), *pairs]
    return table


_FLIPS = _flips()


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one text, unsigned; no words give zero."""
    hashes = _hashes(text.encode("utf-8", "surrogatepass"), shingle, seed)
    return int(_vote(np.fromiter(hashes, np.uint64), np.array([0, len(hashes)]))[0]) if hashes else 0


def _hashes(data: bytes, shingle: int, seed: int) -> list[int]:
    words = data.lower().split()
    if not words:
        return []
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    runs = zip(*(words[k:] for k in range(shingle)))
    return list(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)))


def _vote(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Majority bits of each range of hashes; an empty range gives zero."""
    size = np.diff(ends)
    result = np.zeros(len(size), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for row in some:
            counted = bits[ends[row]:ends[row + 1]].sum(axis=0, dtype=np.int32)
            result[row] = np.packbits(2 * counted > size[row], bitorder="little").view(np.uint64)[0]
    return result


def _printed(rows: DataFrame, schema: str, shingle: int, seed: int) -> DataFrame:
    """The columns of ``schema`` but its last, ``fp``, which is the fingerprint of ``text``."""
    names = [field.split()[0] for field in schema.split(", ")[:-1]]

    def run(batches):
        for batch in common.slices(batches):
            found, ends = [], [0]
            for text in batch.column("text").cast("binary").to_pylist():
                found += _hashes(text or b"", shingle, seed)
                ends.append(len(found))
            fp = _vote(np.array(found, np.uint64), np.array(ends))
            yield common.record_batch(schema, *[batch.column(c) for c in names], fp.view(np.int64))

    return rows.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a bigint) of every row."""
    return _printed(common.id_and_text(docs), "doc_id long, fp long", shingle, seed)


def _syndrome(value: np.ndarray) -> np.ndarray:
    s = np.zeros(len(value), np.int64)
    for bit in range(31):
        s ^= np.where((value >> bit) & 1, bit + 1, 0)
    return s


def _replicate(batches):
    """Fingerprints at all their anchors; an anchor is the half's number, then a code word."""
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        rows = []
        for half in (0, 1):
            part = (fp.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0xFFFFFFFF
            flips = _FLIPS[_syndrome(part)]
            anchors = np.where(flips >= 0, part[:, None] ^ np.maximum(flips, 0), -1)
            anchors = np.column_stack([anchors, anchors[:, 0] ^ (1 << 31)])
            home = np.zeros(anchors.shape, bool)
            home[:, 0] = True
            used = anchors >= 0
            rows.append((anchors[used] | (half << 32), np.broadcast_to(fp[:, None], anchors.shape)[used], home[used]))
        yield common.record_batch(_REPLICA, *[np.concatenate(c) for c in zip(*rows)])


def _compare(anchor, fp, home, max_bits):
    """Links between home fingerprints and replicas of the same anchor, as arrays of pairs, in blocks."""
    at = np.flatnonzero(home)
    low, high = np.searchsorted(anchor, anchor[at], "left"), np.searchsorted(anchor, anchor[at], "right")
    count = high - low
    at, low, count = at[count > 1], low[count > 1], count[count > 1]
    ends = np.cumsum(count)
    start = 0
    while start < len(at):
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + BLOCK, "right")), start + 1)
        mine, n = at[start:stop], count[start:stop]
        other = np.repeat(low[start:stop] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        x, y = np.repeat(fp[mine], n), fp[other]
        near = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
        if near.any():
            yield x[near], y[near]
        start = stop


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) whose components are those of all links between distinct fingerprints ``fp``."""
    if max_bits > 2:
        raise ValueError("two halves find links of at most 2 differing bits")

    def run(batches):
        held, found = None, []
        def flush(rows):
            nonlocal found
            for pair in _compare(*rows, max_bits):
                found.append(pair)
                if sum(len(p[0]) for p in found) > BLOCK:
                    found = [contract(*(np.concatenate(c) for c in zip(*found)))]

        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home")]
            rows = rows if held is None else [np.concatenate(c) for c in zip(held, rows)]
            cut = np.searchsorted(rows[0], rows[0][-1])          # the last anchor may go on
            held = [c[cut:] for c in rows]
            flush([c[:cut] for c in rows])
        if held is not None:
            flush(held)
        if found:
            yield common.record_batch(_LINK, *contract(*(np.concatenate(c) for c in zip(*found))))

    spread = prints.select("fp").mapInArrow(_replicate, _REPLICA)
    return spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _LINK)


def _rooted(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, first_id, root`` of every distinct fingerprint: its smallest id, its component's root."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct, max_bits))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Components are those of links at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest ``doc_id`` in the component. Null and empty texts have fingerprint zero and link like
    any other. Rows with a null ``doc_id`` link too, but never name a component (a component of only
    such rows has a null id). Repeated rows each come back. Other columns are ignored.
    """
    prints = materialize(fingerprints(docs, shingle), "prints")
    rooted = _rooted(prints, max_bits)
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = materialize(rooted.join(lowest, "root").select("fp", "component_id"), "by_print")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: the first by id, of rows with that id by text.

    Components are told apart by their root fingerprint, so an id may repeat with other texts. Rows
    without an id stay.
    """
    names = docs.columns
    slim = common.id_and_text(docs).withColumn("digest", F.xxhash64("text"))
    prints = materialize(_printed(slim, "doc_id long, digest long, fp long", SHINGLE, SEED), "prints")
    rooted = materialize(_rooted(prints, MAX_BITS), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("low"))
    named = rooted.join(lowest, "root").where("first_id = low").select("fp", "root", "low")
    rows = prints.join(named, "fp").where("doc_id = low").groupBy("doc_id", "digest").agg(
        F.min("root").alias("root"), F.count(F.lit(1)).alias("n"))
    total = rows.groupBy("root").agg(F.sum("n").alias("rows"))
    chosen = materialize(rows.join(total, "root").select(
        F.col("doc_id").alias("__sim_id"), F.col("digest").alias("__sim_digest"), F.col("root").alias("__sim_root"),
        F.col("rows").alias("__sim_rows")), "chosen")
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = docs.join(chosen, (F.col("doc_id").cast("long") == F.col("__sim_id")) & (digest == F.col("__sim_digest")))
    single = found.where("__sim_rows = 1").select(*names)
    first = found.where("__sim_rows > 1").groupBy("__sim_root").agg(
        F.min(F.struct(F.col("text").alias("__sim_text"), *[F.col(c) for c in names])).alias("__sim_row"))
    return single.unionByName(first.select("__sim_row.*").select(*names)).unionByName(docs.where("doc_id is null"))
