"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Both tokenizers cut the same bytes, so a link (a token of each whose byte ranges overlap) is one stretch
between neighbouring token ends of either side. Links are inverted: for each pair of ids a bitmap of the
documents it occurs in, cut into blocks of consecutive documents. Multiplicities are kept in planes:
plane ``p`` holds the documents whose number of such links has bit ``p`` set. The popcounts of the
planes, times their powers of two, give a pair's links; the popcount of their union gives its
documents. Within a block a plane's bitmap is stored as sorted 16-bit places or, where that is
shorter, as bits. A pair's corpus-wide count goes back to the blocks that hold the pair, where its
postings add it to the documents' scores; texts are encoded once.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rainloom.llm import common
from rainloom.llm.token_files import Encoder
from rainloom.session import materialize

#: documents and links of one block, about; a document is never cut
BLOCK_DOCS, BLOCK_LINKS = 1 << 15, 1 << 20
#: a pair is the first id, shifted, plus the second
B_BITS = 20

_PER_DOC = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())]
_BLOCK = pa.schema([("block", pa.int64()), *[(n, pa.list_(t)) for n, t in _PER_DOC],
                    ("pairs", pa.binary()), ("sizes", pa.list_(pa.binary())), ("places", pa.list_(pa.binary())), ("bits", pa.list_(pa.binary()))])
BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs binary, sizes array<binary>, places array<binary>, bits array<binary>")
HELD_SCHEMA = "pair long, block long, n_docs long, n_links long"
RESULT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")


class Side:
    """Bytes, byte lengths and decimal forms of a tokenizer's ids."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def _visible() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(256)}


class Pair:
    """A byte-level tokenizer (A) and a sentence-piece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.encoder = Encoder(a_path)                   # of this object alone: the setting below is kept
        self.first = self.encoder.tokenizer
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=b_path)
        byte_of, n_a, n_b = _visible(), self.first.get_vocab_size(), self.second.get_piece_size()
        shown = [self.first.id_to_token(i) or "" for i in range(n_a)]
        self.a = Side([bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s in shown])
        self.b = Side([self._b_bytes(i) for i in range(n_b)])
        #: ids with the mark that follows them: inside a group, after its A ids, after its B ids
        self.n_printed = max(n_a, n_b)
        shown = [f"{i}{mark}".encode() for mark in ",|;" for i in range(self.n_printed)]
        width = max(map(len, shown))
        self.printed = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in shown), np.uint8).reshape(-1, width)
        self.printed_lengths = np.array(list(map(len, shown)), np.int64)

    def _b_bytes(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for each text; none where a side's bytes are not those of blank + text."""
        spaced = [" " + t for t in texts]
        a = [array(self.encoder.code, ids).tolist() for ids in self.encoder.encode_after_blank(texts)]
        b = self.second.encode(texts, num_threads=1)
        return [(x, y) if t and self.a.joined(x) == (raw := s.encode()) and self.b.joined(y) == raw else ([], [])
                for t, s, x, y in zip(texts, spaced, a, b)]


@cache
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


class Aligned:
    """Groups and links of some encoded texts, laid end to end; token ends are marked byte by byte."""

    def __init__(self, pair: Pair, encoded: list[tuple[list[int], list[int]]]):
        sizes = np.array([(len(a), len(b)) for a, b in encoded], np.int64).reshape(-1, 2)
        self.a_at, self.b_at = (np.concatenate(([0], np.cumsum(n))) for n in sizes.T)
        a_ids, b_ids = (np.fromiter(chain.from_iterable(e[k] for e in encoded), np.int64, n)
                        for k, n in ((0, self.a_at[-1]), (1, self.b_at[-1])))
        a_end, b_end = np.cumsum(pair.a.lengths[a_ids]), np.cumsum(pair.b.lengths[b_ids])
        ends_a, ends_b = (np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, bool) for _ in range(2))
        ends_a[a_end] = ends_b[b_end] = True
        ends, cut = np.flatnonzero(ends_a | ends_b), ends_a & ends_b
        at_a, at_b = (np.cumsum(marks, dtype=np.int32)[ends] - marks[ends] for marks in (ends_a, ends_b))
        self.pairs = (a_ids[at_a] << B_BITS) | b_ids[at_b]
        of_a = np.repeat(np.arange(len(encoded)), sizes[:, 0])             # text of every A token
        self.text = of_a[at_a]
        self.n_links = np.bincount(self.text, minlength=len(encoded))
        self.n_groups = np.bincount(of_a[cut[a_end]], minlength=len(encoded))
        groups = np.cumsum(cut, dtype=np.int32)
        self._print(pair, a_ids, b_ids, cut[a_end], cut[b_end], groups[a_end] - cut[a_end], groups[b_end] - cut[b_end])

    def _print(self, pair, a_ids, b_ids, closes_a, closes_b, group_a, group_b):
        """Digests of the texts' groups: A ids of a group, then its B ids, each with the mark after it."""
        n_groups = int(closes_a.sum())
        n_a, n_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        codes[np.arange(len(a_ids)) + (np.cumsum(n_b) - n_b)[group_a]] = a_ids + closes_a * pair.n_printed
        codes[np.arange(len(b_ids)) + np.cumsum(n_a)[group_b]] = b_ids + 2 * closes_b * pair.n_printed
        shown = pair.printed[codes].ravel()
        shown = memoryview(shown[shown != 0].tobytes())
        length = np.concatenate(([0], np.cumsum(pair.printed_lengths[codes])))
        cuts = length[self.a_at + self.b_at].tolist()
        self.digests = [hashlib.sha256(shown[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]


def pack(pairs: np.ndarray, places: np.ndarray, n_docs: int) -> tuple[np.ndarray, list, list, list]:
    """Distinct pairs of links (``pairs``, ``places`` of their documents) and their planes.

    Of each plane: the popcount of every pair's bitmap, the places of the sparse ones and the bits of
    those that hold over a sixteenth of the documents.
    """
    held, times = np.unique((pairs << 16) | places, return_counts=True)
    codes, docs = held >> 16, held & 0xFFFF
    distinct, row = np.unique(codes, return_inverse=True)
    sizes, sparse, dense = [], [], []
    for plane in range(int(times.max()).bit_length() if len(times) else 0):
        on = (times >> plane) & 1 == 1
        size = np.bincount(row[on], minlength=len(distinct))
        many = size * 16 > n_docs
        is_dense = many[row[on]]
        grid = np.zeros((int(many.sum()), n_docs), bool)
        grid[(np.cumsum(many) - 1)[row[on][is_dense]], docs[on][is_dense]] = True
        sizes.append(size.astype("<u4").tobytes())
        sparse.append(docs[on][~is_dense].astype("<u2").tobytes())
        dense.append(np.packbits(grid, axis=1).tobytes())
    return distinct, sizes, sparse, dense


def unpack(size: bytes, sparse: bytes, dense: bytes, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of the pair, place of the document) of all bits of one plane."""
    size = np.frombuffer(size, "<u4").astype(np.int64)
    many = size * 16 > n_docs
    width = -(-n_docs // 8)
    grid = np.unpackbits(np.frombuffer(dense, np.uint8).reshape(-1, width), axis=1, count=n_docs) if many.any() else np.zeros((0, n_docs), np.uint8)
    row, place = np.nonzero(grid)
    return (np.concatenate((np.repeat(np.arange(len(size)), np.where(many, 0, size)), np.flatnonzero(many)[row])),
            np.concatenate((np.frombuffer(sparse, "<u2").astype(np.int64), place)))


def inverted(docs: DataFrame, a_path: str, b_path: str, block_docs: int = BLOCK_DOCS, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per block of documents: what is known of each document, and the block's pair bitmaps.

    ``a_path`` and ``b_path`` are tokenizer files on every executor.
    """
    def run(batches):
        pair, part, number = _pair(a_path, b_path), TaskContext.get().partitionId(), 0
        columns, links, places, held = [[] for _ in _PER_DOC], [], [], 0

        def block():
            nonlocal number
            n = len(columns[0])
            packed = pack(np.concatenate(links), np.concatenate(places), n)
            values = [(part << 32) + number, *columns, packed[0].astype("<i8").tobytes(), *packed[1:]]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK)], schema=_BLOCK)

        for batch in common.slices(batches):
            encoded = pair.encode(batch.column("text").to_pylist())
            found = Aligned(pair, encoded)
            cut = np.concatenate(([0], np.cumsum(found.n_links)))
            keys, start = batch.column("doc_id").to_pylist(), 0
            while start < len(encoded):
                room = int(np.searchsorted(cut, cut[start] + max(block_links - held, 1), "left"))
                end = min(max(room, start + 1), len(encoded), start + block_docs - len(columns[0]))
                at = slice(start, end)
                links.append(found.pairs[cut[start]:cut[end]])
                places.append(found.text[cut[start]:cut[end]] - start + len(columns[0]))
                for column, values in zip(columns, (
                        keys[at], np.diff(found.a_at)[at].tolist(), np.diff(found.b_at)[at].tolist(),
                        found.n_groups[at].tolist(), found.n_links[at].tolist(), found.digests[at])):
                    column += values
                held, start = held + int(cut[end] - cut[start]), end
                if held >= block_links or len(columns[0]) >= block_docs:
                    yield block()
                    columns, links, places, held = [[] for _ in _PER_DOC], [], [], 0
        if columns[0]:
            yield block()

    return common.id_and_text(docs).mapInArrow(run, BLOCK_SCHEMA)


def held_pairs(blocks: DataFrame) -> DataFrame:
    """``pair, block, n_docs, n_links``: documents and links of every pair in every block."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs, n = np.frombuffer(row["pairs"], "<i8"), len(row["doc_id"])
                n_links, union = np.zeros(len(pairs), np.int64), []
                for plane, (size, *bitmap) in enumerate(zip(row["sizes"], row["places"], row["bits"])):
                    n_links += np.frombuffer(size, "<u4").astype(np.int64) << plane
                    at, place = unpack(size, *bitmap, n)
                    union.append((at << 16) | place)
                merged = np.unique(np.concatenate(union)) if union else np.zeros(0, np.int64)
                yield common.record_batch(
                    HELD_SCHEMA, pairs, np.full(len(pairs), row["block"]), np.bincount(merged >> 16, minlength=len(pairs)), n_links)

    return blocks.select("block", "doc_id", "pairs", "sizes", "places", "bits").mapInArrow(run, HELD_SCHEMA)


def pair_counts(held: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links, best`` of every pair; ``best``: no other first id has more links with its second."""
    counts = held.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    second = F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("second")
    highest = counts.groupBy(second).agg(F.max("n_links").alias("highest"))       # at most one row per id of B
    return counts.withColumn("second", second).join(F.broadcast(highest), "second").select(
        "pair", "n_docs", "n_links", (F.col("n_links") == F.col("highest")).alias("best"))


def _returned(blocks: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of pairs (``block, pair, n_links, best``) added up in their documents by the postings."""
    def run(block, scored):
        if not block.num_rows:
            return pa.Table.from_batches([common.record_batch(RESULT_SCHEMA, *[[]] * 8)])
        row = block.to_pylist()[0]
        n, pairs = len(row["doc_id"]), np.frombuffer(row["pairs"], "<i8")
        at = np.searchsorted(pairs, scored.column("pair").to_numpy())
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        count[at] = scored.column("n_links").to_numpy()
        best[at] = scored.column("best").to_numpy(zero_copy_only=False)
        count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for plane, bitmap in enumerate(zip(row["sizes"], row["places"], row["bits"])):
            of, place = unpack(*bitmap, n)
            np.add.at(count_sum, place, count[of] << plane)
            np.add.at(n_best, place, best[of] << plane)
        return pa.Table.from_batches([common.record_batch(
            RESULT_SCHEMA, *[row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], n_best, count_sum, row["groups_sha256"])])

    return blocks.groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(run, RESULT_SCHEMA)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    A (byte level) encodes a blank and the text, B (sentence pieces) the text, special tokens as plain
    text. Null and empty texts, and texts whose tokens do not spell the blank and the text, have no
    tokens: zeros and an empty digest. ``n_best`` counts links whose pair no first id beats for its
    second id, ``count_sum`` adds the corpus-wide counts of the links' pairs. Repeated rows and rows
    without a ``doc_id`` each count and come back; an empty table gives no rows; other columns are
    ignored.
    """
    blocks = materialize(inverted(docs, a_path, b_path), "pair_blocks")
    held = held_pairs(blocks)
    scores = held.select("pair", "block").join(pair_counts(held), "pair").select("block", "pair", "n_links", "best")
    return _returned(blocks, scores)
