"""Benchmark decontamination: edit matching by pigeonhole pieces and Myers' bit-parallel distance.

Texts are lower-cased and runs of white space become one space. A test item of m characters may
differ by ``budget(m)`` edits. It is cut into budget + 1 pieces; in any match within the budget one
piece is untouched. All pieces of all items are searched at once (Aho-Corasick); around every piece
hit the whole item is verified against the text with the bit-parallel recurrence.

Items are handled in blocks of bounded size, one pass over the documents for each block, so the size
of the benchmark is limited neither by a task's memory nor by the driver's. A benchmark of one block
needs no shuffle; hits of several blocks are united by a digest of the text.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rainloom.llm import common
from rainloom.session import materialize

#: share of an item's characters that may be edited, and the least characters of a piece
ERROR_RATE = 0.05
MIN_PIECE = 20
#: characters of the items of one block, about
BLOCK_CHARS = 1 << 20

HITS = "doc_id long, items array<long>"
BLOCK_HITS = "key string, item long"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    return max(0, min(int(length * ERROR_RATE), length // MIN_PIECE - 1))


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget + 1 nearly equal pieces of an item."""
    parts = budget(len(item)) + 1
    cuts = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """An item prepared for approximate search by Myers' recurrence."""

    def __init__(self, item: str):
        self.length, self.limit = len(item), budget(len(item))
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def within(self, text: str) -> bool:
        """Whether some part of ``text`` is within the limit of the item."""
        full, top = (1 << self.length) - 1, 1 << self.length - 1
        plus, minus, score = full, 0, self.length
        for c in text:
            eq = self.masks.get(c, 0)
            diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
            up = minus | ~(diagonal | plus) & full
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            if score <= self.limit:
                return True
            up, down = up << 1 & full, down << 1 & full
            plus = down | ~(diagonal | up) & full
            minus = up & diagonal
        return False


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.patterns: list[tuple[int, Pattern]] = []
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list] = {}
        for item_id, raw in items:
            item = normalise(raw)
            if not item:
                continue
            for offset, piece in pieces(item):
                owners.setdefault(piece, []).append((len(self.patterns), offset))
            self.patterns.append((item_id, Pattern(item)))
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def items_in(self, text: str) -> list[int]:
        """Ids of the items that ``text`` (normalised) contains within their budgets."""
        found, tried = set(), set()
        for last, (length, places) in self.automaton.iter(text):
            for number, offset in places:
                start = last - length + 1 - offset
                item_id, p = self.patterns[number]
                if item_id in found or (number, start) in tried:
                    continue
                tried.add((number, start))
                if p.within(text[max(0, start - p.limit):start + p.length + p.limit]):
                    found.add(item_id)
        return sorted(found)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, streamed to the driver partition by partition."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    for item_id, text in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        if size + len(text) > BLOCK_CHARS and block:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


_built: dict[str, Matcher] = {}


def _matcher(shared, name: str) -> Matcher:
    """The matcher of a broadcast block; a worker keeps the last one it built."""
    if name not in _built:
        _built.clear()
        _built[name] = Matcher(shared.value)
    return _built[name]


def _items_in(texts: pa.Array, shared, name: str) -> list[list[int]]:
    """Sorted ids of one block's items in every text."""
    matcher = _matcher(shared, name)
    return [matcher.items_in(normalise(t)) if matcher.patterns else [] for t in texts.to_pylist()]


def _text_key() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def _block_hits(docs: DataFrame, block: list[tuple[int, str]]) -> DataFrame:
    """``key, item`` of the texts that hold an item of the block, written before the block is let go."""
    shared, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches):
        for batch in batches:
            rows = [(key, item) for key, items in zip(batch.column("key").to_pylist(), _items_in(batch.column("text"), shared, name))
                    for item in items]
            if rows:
                yield common.record_batch(BLOCK_HITS, *map(list, zip(*rows)))

    keyed = docs.select(_text_key().alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hits = materialize(keyed.mapInArrow(run, BLOCK_HITS).distinct(), "benchmark-hits")
    shared.destroy()
    return hits


def _hits_by_text(docs: DataFrame, benchmark: DataFrame) -> DataFrame | list[tuple[int, str]]:
    """The items themselves if they are one block (or none); otherwise ``key, items`` of all texts with hits.

    One pass over the documents for each block; driver and workers hold one block at a time. Hits
    depend on the text alone, so a digest of it unites them.
    """
    blocks = _blocks(benchmark)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        return first
    hits = _block_hits(docs, first)
    for block in itertools.chain([second], blocks):
        hits = hits.unionByName(_block_hits(docs, block))
    return materialize(hits.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items")), "benchmark-hits")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, items, contaminated`` of every row of ``docs``.

    ``items`` are the sorted ids of the benchmark items found. Null and empty texts contain nothing;
    items with a null id, null text or no words are nowhere. An item id with several texts is found
    if one of them is. Repeated rows come back each.
    """
    rows, hits = common.id_and_text(docs), _hits_by_text(docs, benchmark)
    if isinstance(hits, DataFrame):
        found = rows.select("doc_id", _text_key().alias("key")).join(hits, "key", "left").select(
            "doc_id", F.coalesce("items", F.array().cast("array<long>")).alias("items"))
    else:
        shared, name = docs.sparkSession.sparkContext.broadcast(hits), uuid.uuid4().hex

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    yield common.record_batch(HITS, batch.column("doc_id"), _items_in(batch.column("text"), shared, name))

        found = rows.mapInArrow(run, HITS)
    count = F.size("items").cast("long")
    return found.select("doc_id", count.alias("n_items"), "items", (count > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark item, with all their columns."""
    hits = _hits_by_text(docs, benchmark)
    if isinstance(hits, DataFrame):
        return docs.join(hits.select(F.col("key").alias(hit := f"hit_{uuid.uuid4().hex}")), _text_key() == F.col(hit), "left_anti")
    shared, name = docs.sparkSession.sparkContext.broadcast(hits), uuid.uuid4().hex

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not items for items in _items_in(texts, shared, name)]))

    return docs.mapInArrow(run, docs.schema)
