"""Ranked lexical search by K2-treaps over the term-document grid.

Documents are indexed in ranges: consecutive documents of an input partition, up to a bound of
postings. A range's grid has a row for each of its terms (frequent ones first) and a column for each
document (in ``doc_id`` order); a cell holds the impact of the term in the document. The treap is the
quadtree of the grid: a node is a non-empty square, four bits tell which of its quadrants are not
empty, and its value is the square's largest impact, stored as the difference to its parent's.

An item descends all its terms' row paths jointly, over halved document ranges: the weighted maxima of
the cells where its rows meet a range add up to a bound of every score in it. Ranges are opened best
bound first, some at a time, until no bound can reach the last of the best documents found.

Index folder, Parquet datasets: ``shards`` (one row per range) and ``stats`` (documents with a term
and terms with repeats, of the whole table).
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rainloom.llm import common
from rainloom.session import SMALL_GROUPS

TOP = 20
#: postings and documents of one range
SHARD_POSTINGS, SHARD_DOCS = 1 << 20, 1 << 14
#: items whose texts reach this many bytes, or this many items, are searched together
ITEM_BYTES, ITEM_ROWS = 4 << 20, 2000
#: ranges of an item opened at once
OPENED = 96

SHARD_SCHEMA = "n_docs int, height int, ids binary, nulls binary, terms binary, holders binary, bits binary, maxima binary"
HIT_SCHEMA = "item long, doc_id long, score long"


def _byte_table() -> bytes:
    """Bytes of a term as they count (A to Z lower-cased), all others as a blank."""
    term = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    return bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in set(term) else 0x20 for b in range(256))


_BYTES = _byte_table()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_BYTES).split()


def impact(tf, m):
    """Impact of a term that occurs ``tf`` times in a document of length factor ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_factor(n, n_docs: int, n_terms: int):
    return 75 + (25 * n * n_docs) // max(n_terms, 1)


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def collection_stats(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and terms with repeats."""
    def run(batches):
        for batch in common.slices(batches):
            sizes = [len(terms_of(t)) for t in batch.column("text").cast("binary").to_pylist()]
            yield common.record_batch("n_docs long, n_terms long", [sum(s > 0 for s in sizes)], [sum(sizes)])

    found = common.id_and_text(docs).select("text").mapInArrow(run, "n_docs long, n_terms long")
    return tuple(v or 0 for v in found.agg(F.sum("n_docs"), F.sum("n_terms")).first())


def build_treap(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
    """Quadrant bits of all inner nodes and maxima of all nodes, in level order.

    ``rows`` and ``cols`` are the distinct places of ``values`` in a grid of ``2 ** height`` a side.
    Node ``i`` has the bits from ``4 * i``; the k-th set bit (from 0) leads to node ``k + 1``.
    """
    code = np.zeros(len(rows), np.int64)
    for level in range(height - 1, -1, -1):
        code = (code << 2) | (((rows >> level) & 1) << 1) | ((cols >> level) & 1)
    order = np.argsort(code)
    code, values = code[order], values[order].astype(np.int64)
    levels = [(code, values)]
    for _ in range(height):
        upper = levels[-1][0] >> 2
        first = np.flatnonzero(np.concatenate(([True], upper[1:] != upper[:-1])))
        levels.append((upper[first], np.maximum.reduceat(levels[-1][1], first)))
    levels.reverse()
    bits = []
    for (above, _), (below, _) in zip(levels, levels[1:]):
        mine = np.zeros(4 * len(above), bool)
        mine[4 * np.searchsorted(above, below >> 2) + (below & 3)] = True
        bits.append(mine)
    return np.concatenate(bits) if bits else np.zeros(0, bool), np.concatenate([v for _, v in levels])


def _parents(bits: np.ndarray) -> np.ndarray:
    """Parent of every node but the first."""
    return np.flatnonzero(bits) >> 2


class Treap:
    """A range's treap, opened for searches."""

    def __init__(self, height: int, bits: np.ndarray, maxima: np.ndarray):
        self.height, self.bits, self.maxima = height, bits, maxima
        self.rank = np.cumsum(bits, dtype=np.int32)          # of a set bit: the node it leads to

    def search(self, rows: np.ndarray, weights: np.ndarray, top: int, floor: int = 0) -> list[tuple[int, int]]:
        """(score, column) of the ``top`` columns with the highest scores above 0 and not below ``floor``,
        equal scores by column: the sum of ``weights`` times the rows' impacts in the column."""
        start, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
        cells, bound = np.zeros((1, len(rows)), np.int64), np.array([int(weights.sum()) * int(self.maxima[0])])
        best: list[tuple[int, int]] = []                      # (-score, column)
        while len(start):
            if len(start) > OPENED:
                pick = np.zeros(len(start), bool)
                pick[np.argpartition(-bound, OPENED)[:OPENED]] = True
                rest = ~pick
                now = start[pick], level[pick], cells[pick]
                start, level, cells, bound = start[rest], level[rest], cells[rest], bound[rest]
            else:
                now = start, level, cells
                start, level, cells, bound = start[:0], level[:0], cells[:0], bound[:0]
            s, l, c = (np.concatenate((x, x)) for x in now)
            half = np.repeat([0, 1], len(now[0]))
            down = self.height - 1 - l
            at = 4 * c + 2 * ((rows[None, :] >> down[:, None]) & 1) + half[:, None]
            there = c >= 0
            there &= self.bits[np.where(there, at, 0)]
            c = np.where(there, self.rank[np.where(there, at, 0)], -1)
            b = np.where(there, self.maxima[np.maximum(c, 0)], 0).astype(np.int64) @ weights
            s, l = s + (half << down), l + 1
            leaf = l == self.height
            for score, column in zip(b[leaf & (b > 0) & (b >= floor)].tolist(), s[leaf & (b > 0) & (b >= floor)].tolist()):
                best.append((-score, column))
            best = sorted(best)[:top]
            if len(best) == top:
                floor = max(floor, -best[-1][0])
            on = ~leaf & (b > 0)
            start, level = np.concatenate((start, s[on])), np.concatenate((level, l[on]))
            cells, bound = np.concatenate((cells, c[on])), np.concatenate((bound, b[on]))
            full = len(best) == top
            hope = (bound > floor) | ((bound == floor) & ((start < best[-1][1]) if full else True))
            start, level, cells, bound = start[hope], level[hope], cells[hope], bound[hope]
        return [(-score, column) for score, column in best]


def _shard(ids: list, texts: list[np.ndarray], vocabulary: dict[bytes, int], n_docs: int, n_terms: int):
    """One row of ``shards``: ``texts`` holds the term numbers of every document."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    pairs = np.repeat(np.arange(len(order)), lengths) * len(vocabulary) + np.concatenate([texts[i] for i in order])
    pairs, tf = np.unique(pairs, return_counts=True)
    cols, numbers = np.divmod(pairs, max(len(vocabulary), 1))
    holders = np.bincount(numbers, minlength=len(vocabulary))
    by_row = np.argsort(-holders, kind="stable")
    row_of = np.empty(len(by_row), np.int64)
    row_of[by_row] = np.arange(len(by_row))
    height = max(1, (max(len(order), len(vocabulary)) - 1).bit_length())
    bits, maxima = build_treap(row_of[numbers], cols, impact(tf, length_factor(lengths, n_docs, n_terms)[cols]), height)
    lower = np.concatenate((maxima[:1], maxima[_parents(bits)] - maxima[1:]))
    words = list(vocabulary)
    return common.record_batch(
        SHARD_SCHEMA, [len(order)], [height], [np.array([ids[i] or 0 for i in order], "<i8").tobytes()],
        [np.packbits([ids[i] is None for i in order]).tobytes()], [b" ".join([words[i] for i in by_row.tolist()])],
        [holders[by_row].astype("<u4").tobytes()], [np.packbits(bits).tobytes()], [lower.astype("<u4").tobytes()])


def write_index(docs: DataFrame, path: str, shard_postings: int = SHARD_POSTINGS, shard_docs: int = SHARD_DOCS) -> None:
    """Index every document. Null and empty texts, and texts without terms, have no postings; a null
    ``doc_id`` comes before all others; repeated rows are documents of their own."""
    n_docs, n_terms = collection_stats(docs)
    docs.sparkSession.createDataFrame([(n_docs, n_terms)], "n_docs long, n_terms long").coalesce(1).write.parquet(f"{path}/stats")

    def run(batches):
        ids, texts, held = [], [], 0
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        for batch in common.slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast("binary").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                ids.append(key)
                texts.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
                held += len(words)
                if held >= shard_postings or len(ids) >= shard_docs:
                    yield _shard(ids, texts, vocabulary, n_docs, n_terms)
                    ids, texts, held = [], [], 0
                    vocabulary.clear()
        if ids:
            yield _shard(ids, texts, vocabulary, n_docs, n_terms)

    common.id_and_text(docs).mapInArrow(run, SHARD_SCHEMA).write.options(
        compression="zstd", **SMALL_GROUPS).parquet(f"{path}/shards")


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, Counter]]]:
    """Items with their terms' counts, in blocks of bounded size, read one after another."""
    block, size = [], 0
    for row in items.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).toLocalIterator():
        text = (row[1] or "").encode()
        block.append((row[0], Counter(terms_of(text))))
        size += len(text)
        if size >= ITEM_BYTES or len(block) >= ITEM_ROWS:
            yield block
            block, size = [], 0
    if block:
        yield block


def holders_of(spark: SparkSession, path: str, terms: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the terms (of one block of items)."""
    shared = spark.sparkContext.broadcast(terms)
    schema = "term binary, holders long"

    def run(batches):
        wanted = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                found = [(w, n) for w, n in zip(row["terms"].split(b" "), np.frombuffer(row["holders"], "<u4").tolist()) if w in wanted]
                yield common.record_batch(schema, [w for w, _ in found], [n for _, n in found])

    shards = spark.read.parquet(f"{path}/shards").select("terms", "holders")
    rows = shards.mapInArrow(run, schema).groupBy("term").agg(F.sum("holders").alias("holders"))
    return {bytes(r["term"]): r["holders"] for r in rows.collect()}      # no more rows than the block has terms


def _block_hits(spark: SparkSession, path: str, block: list[tuple[object, Counter]], n_docs: int, top: int) -> DataFrame:
    """``item`` (its place in the block), ``doc_id``, ``score``: the best of every index partition."""
    holders = holders_of(spark, path, {w for _, words in block for w in words})
    weights = {w: weight(n_docs, n) for w, n in holders.items()}
    asked = [{w: n * weights[w] for w, n in words.items() if weights.get(w)} for _, words in block]
    shared = spark.sparkContext.broadcast(asked)

    def run(batches):
        asked = shared.value
        wanted = {w for words in asked for w in words}
        best = [[] for _ in asked]                       # (-score, is null, id) of the partition so far
        for batch in batches:
            for row in batch.to_pylist():
                rows = {w: i for i, w in enumerate(row["terms"].split(b" ")) if w in wanted}
                n, bits = row["n_docs"], np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
                lower = np.frombuffer(row["maxima"], "<u4").view(np.int32)       # impacts end at a million
                maxima, parents = lower.copy(), _parents(bits).astype(np.int32)
                # level by level: a node's maximum is its parent's less the stored difference
                done = 1
                while done < len(maxima):
                    end = int(np.searchsorted(parents, done)) + 1
                    maxima[done:end] = maxima[parents[done - 1:end - 1]] - lower[done:end]
                    done = end
                del parents, lower
                treap = Treap(row["height"], bits, maxima)
                ids, nulls = np.frombuffer(row["ids"], "<i8"), np.unpackbits(np.frombuffer(row["nulls"], np.uint8))
                for mine, words in zip(best, asked):
                    here = [(rows[w], v) for w, v in words.items() if w in rows]
                    if not here:
                        continue
                    at, value = (np.array(x, np.int64) for x in zip(*here))
                    floor = -mine[-1][0] if len(mine) == top else 0
                    mine += [(-s, not nulls[c], int(ids[c])) for s, c in treap.search(at, value, top, floor)]
                    mine.sort()
                    del mine[top:]
        hits = [(i, key if known else None, -score) for i, mine in enumerate(best) for score, known, key in mine]
        if hits:
            yield common.record_batch(HIT_SCHEMA, *map(list, zip(*hits)))

    return spark.read.parquet(f"{path}/shards").mapInArrow(run, HIT_SCHEMA)


def search(
    items: DataFrame, path: str, top: int = TOP, id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``top`` best documents of every item, by a written index.

    Scores are exact. Equal scores rank by ascending ``doc_id``, null first. Items without terms known to
    the index (null and empty texts too) have no rows; a repeated item has its rows once for each
    repetition. Other columns are ignored.
    """
    spark = items.sparkSession
    n_docs = spark.read.parquet(f"{path}/stats").first()["n_docs"]
    kind = items.schema[id_col].dataType.simpleString()
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    result = None
    for block in _item_blocks(items, id_col, text_col):
        ranked = _block_hits(spark, path, block, n_docs, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], f"item long, {id_col} {kind}")
        rows = ranked.join(F.broadcast(names), "item").select(id_col, "rank", "doc_id", "score")
        result = rows if result is None else result.unionByName(rows)
    if result is None:
        return spark.createDataFrame([], f"{id_col} {kind}, rank int, doc_id long, score long")
    return result


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SQL = f"""
with docs as (select row_number() over () as row_id, doc_id, {_TERMS} as terms from documents),
held as (select row_id, doc_id, terms, len(terms) as n from docs where len(terms) > 0),
whole as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from held),
words as (select row_id, unnest(terms) as term from held),
postings as (select row_id, term, count(*) as tf from words group by 1, 2),
weights as (select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from postings, whole group by term, n_docs),
asked as (select item_row, item_id, term, count(*) as times from (
  select row_number() over () as item_row, item_id, unnest({_TERMS}) as term from benchmark) group by 1, 2, 3),
scores as (select item_row, item_id, row_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) as bigint) as score,
  any_value(doc_id) as doc_id
  from asked join postings using (term) join weights using (term) join held using (row_id), whole group by 1, 2, 3)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by item_row order by score desc, doc_id) as rank from scores where score > 0) where rank <= 20
"""
