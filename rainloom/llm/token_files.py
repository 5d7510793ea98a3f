"""Token ids in binary shard files, reached by a minimal perfect hash index.

Layout below a folder, each a Parquet dataset so that any Hadoop file system can hold it:

``shards``: one row per shard: ``part, seq`` (their order is the order of the ids), ``n_docs``,
    ``n_ids``, ``width`` (bytes of an id), ``ends`` (little-endian int64: where each document ends,
    in ids) and ``payload`` (the raw little-endian ids). A shard holds no document keys.
``index``: one row per key bucket: a level-wise minimal perfect hash function of the bucket's keys
    (bit arrays and their ranks) and, by slot, the key's fingerprint, shard and place in the shard.

A key is hashed to a bucket, then to a slot; the stored fingerprint rejects unknown keys (but for one
in 2^32); the slot leads to the shard and the offsets of the document.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rainloom.llm import common

END_ID = 0
#: ids of one shard, about, and keys of one index bucket, about
SHARD_IDS = 1 << 20
BUCKET_KEYS = 1 << 14
#: pieces whose ids a worker remembers; it then starts afresh
CACHE_WORDS = 450_000
#: slots per key on every level of the hash function
GAMMA = 2
#: stands for a null key
NULL_KEY = -(1 << 63)

SHARD_SCHEMA = "part long, seq long, n_docs long, n_ids long, width int, keys binary, ends binary, payload binary"
PLACE_SCHEMA = "key long, part long, seq long, place long"
INDEX_SCHEMA = "bucket long, n_keys long, sizes array<long>, bits binary, fingerprints binary, part binary, seq binary, place binary, copies binary"


#: fixed values: ASCII marks, none of which is a letter, a digit or white space
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _visible_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_VISIBLE = _visible_bytes()


class _Known(dict):
    """Remembers what ``make`` gives for each key."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        self[key] = value = self.make(key)
        return value


class Encoder:
    """Ids of whole texts from the ``tokenizers`` library.

    A byte-level vocabulary splits texts before spaces and around runs of letters, so a text's ids
    are those of its pieces between single spaces, and equal pieces are encoded once. Pieces made of
    letters, marks after them and single line breaks go to the vocabulary's model word by word; all
    others to the whole tokenizer. A text with a piece that is empty or has white space at its edges
    is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.end = array(self.code, [END_ID]).tobytes()
        self._forget()

    def _forget(self) -> None:
        #: pieces at the start of a text or line, and those after a space
        self.first, self.later = _Known(lambda p: self._piece(p, "")), _Known(lambda p: self._piece(p, " "))
        self.marks = _Known(self._whole)

    def _raw(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str, lead: str) -> bytes:
        shown = word if word.isascii() else "".join(map(_VISIBLE.__getitem__, word.encode()))
        return self._raw([t.id for t in self.model.tokenize(_VISIBLE[32] + shown if lead else shown)])

    def _piece(self, piece: str, lead: str) -> bytes | None:
        """Ids of a piece; None if it depends on its neighbours."""
        if piece.isalpha():
            return self._word(piece, lead)
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        known, out = self.later if lead else self.first, []
        for line in piece.split("\n"):
            word = line.rstrip(MARKS)
            if not word.isalpha():
                return self._whole(lead + piece)
            if out:
                out.append(self.marks["\n"])
                known = self.first
            out.append(known[word])
            if len(word) < len(line):
                out.append(self.marks[line[len(word):]])
        return b"".join(out)

    def _bound_memory(self) -> None:
        if len(self.first) + len(self.later) + len(self.marks) > CACHE_WORDS:
            self._forget()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text with the end id, as raw bytes."""
        self._bound_memory()
        result, later = [], self.later.__getitem__
        for text in texts:
            start, *pieces = text.split(" ")
            try:
                ids = b"".join([self.first[start], *map(later, pieces)])
            except TypeError:                 # a piece that cannot stand alone
                ids = self._whole(text) if text else b""
            result.append(ids + self.end)
        return result

    def encode_after_blank(self, texts: list[str]) -> list[bytes]:
        """The ids of a blank and every text, without the end id."""
        self._bound_memory()
        result, later = [], self.later.__getitem__
        for text in texts:
            try:
                result.append(b"".join(map(later, text.split(" "))))
            except TypeError:
                result.append(self._whole(" " + text))
        return result


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def keys_of(docs: DataFrame) -> DataFrame:
    """The distinct keys of documents; a null id has the key ``NULL_KEY``."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()


def write_shards(docs: DataFrame, tokenizer: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``text`` and write shards in ascending ``doc_id`` order (equal ids by their text).

    ``tokenizer`` is the path of a tokenizer file on every executor. A null text is empty and has the
    end id only; a null id sorts first. Rows of one id lie together in one shard.
    """
    keyed = common.id_and_text(docs).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), "text")

    def run(batches):
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        blobs, own, last, held = [], [], None, 0

        def shard():
            nonlocal seq
            ends = np.cumsum([len(b) // encoder.width for b in blobs], dtype="<i8")
            row = common.record_batch(
                SHARD_SCHEMA, [part], [seq], [len(blobs)], [int(ends[-1])], [encoder.width],
                [np.array(own, "<i8").tobytes()], [ends.tobytes()], [b"".join(blobs)])
            seq += 1
            blobs.clear()
            own.clear()
            return row

        for batch in common.slices(batches):
            keys = batch.column("key").to_pylist()
            for key, blob in zip(keys, encoder.encode(batch.column("text").to_pylist())):
                if held >= shard_ids and key != last:
                    yield shard()
                    held = 0
                blobs.append(blob)
                own.append(key)
                held, last = held + len(blob) // encoder.width, key
        if blobs:
            yield shard()

    ordered = keyed.repartitionByRange("key").sortWithinPartitions("key", "text")
    written = ordered.mapInArrow(run, SHARD_SCHEMA)
    written.write.option("compression", "zstd").parquet(f"{path}/shards")


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return common.mix(keys.view(np.uint64) + np.uint64((level * 0xD6E8FEB86659FD93 + 0x51ED270B) & ((1 << 64) - 1)))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return _level_hash(keys, 1 << 20).astype(np.uint32)


def build_function(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, one after another, for distinct keys.

    On each level every remaining key hashes to a slot; keys alone in theirs are placed there.
    """
    sizes, bits, left, level = [], [], np.asarray(keys, np.int64), 0
    while len(left):
        size = max(64, GAMMA * len(left))
        slot = (_level_hash(left, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[slot]]
        level += 1
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots_of(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of every key, 0 to n - 1 for the keys the function was built from; -1 if it has none."""
    keys = np.asarray(keys, np.int64)
    rank = np.concatenate(([0], np.cumsum(bits)))
    slot, base = np.full(len(keys), -1, np.int64), 0
    open_ = np.arange(len(keys))
    for level, size in enumerate(sizes):
        at = base + (_level_hash(keys[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        slot[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + size
    return slot


def _bucketed(keys: DataFrame, n_buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(n_buckets)))


def write_index(spark: SparkSession, path: str, bucket_keys: int = BUCKET_KEYS) -> None:
    """Build the index of written shards; every distinct key gets one slot."""
    def places(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], "<i8")
                yield common.record_batch(
                    PLACE_SCHEMA, keys, np.full(len(keys), row["part"]), np.full(len(keys), row["seq"]), np.arange(len(keys)))

    shards = spark.read.parquet(f"{path}/shards")
    n_buckets = max(1, -(-(shards.agg(F.sum("n_docs")).first()[0] or 0) // bucket_keys))
    first = F.min(F.struct("part", "seq", "place")).alias("at")
    placed = (shards.select("part", "seq", "keys").mapInArrow(places, PLACE_SCHEMA)
              .groupBy("key").agg(first, F.count(F.lit(1)).alias("copies")).select("key", "at.*", "copies"))

    def build(table):
        import pyarrow as pa

        keys = table.column("key").to_numpy()
        sizes, bits = build_function(keys)
        slot = slots_of(keys, sizes, bits)
        by_slot = np.empty(len(keys), np.int64)
        by_slot[slot] = np.arange(len(keys))
        columns = [table.column(c).to_numpy()[by_slot].astype("<i8").tobytes() for c in ("part", "seq", "place", "copies")]
        return pa.Table.from_batches([common.record_batch(
            INDEX_SCHEMA, [table.column("bucket")[0].as_py()], [len(keys)], [sizes], [np.packbits(bits).tobytes()],
            [_fingerprint(keys)[by_slot].astype("<u4").tobytes()], *[[c] for c in columns])])

    index = _bucketed(placed, n_buckets).groupBy("bucket").applyInArrow(build, INDEX_SCHEMA)
    index.withColumn("n_buckets", F.lit(n_buckets)).write.option("compression", "zstd").parquet(f"{path}/index")


def _running(rows: DataFrame, amount: str) -> DataFrame:
    """``rows`` (part, seq, ...) with ``before``: the sum of ``amount`` before them, in two levels."""
    within = Window.partitionBy("part").orderBy("seq")
    totals = rows.groupBy("part").agg(F.sum(amount).alias("_total"))
    bases = totals.withColumn("_base", F.sum("_total").over(Window.orderBy("part")) - F.col("_total")).drop("_total")
    summed = rows.withColumn("before", F.sum(amount).over(within) - F.col(amount))
    return summed.join(bases, "part").withColumn("before", F.col("before") + F.col("_base")).drop("_base")


def write(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Shards and index of ``docs``; an empty table gives empty datasets."""
    write_shards(docs, tokenizer, path)
    write_index(docs.sparkSession, path)


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """``key, part, seq, place, copies`` of the keys (column ``key``) that the index holds."""
    spark = keys.sparkSession
    index = spark.read.parquet(f"{path}/index")
    first = index.select("n_buckets").first()
    n_buckets = first[0] if first else 1
    asked = _bucketed(keys.select("key").distinct(), n_buckets)
    schema = "key long, part long, seq long, place long, copies long"

    def find(asked, stored):
        import pyarrow as pa

        keys = asked.column("key").to_numpy() if asked.num_rows else np.zeros(0, np.int64)
        if not stored.num_rows or not len(keys):
            return pa.Table.from_batches([common.record_batch(schema, *[np.zeros(0, np.int64)] * 5)])
        row = stored.slice(0, 1).to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        slot = slots_of(keys, row["sizes"], bits)
        known = (slot >= 0) & (np.frombuffer(row["fingerprints"], "<u4")[np.maximum(slot, 0)] == _fingerprint(keys))
        at = slot[known]
        values = [np.frombuffer(row[c], "<i8")[at] for c in ("part", "seq", "place", "copies")]
        return pa.Table.from_batches([common.record_batch(schema, keys[known], *values)])

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, schema)


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, place, before, n_tokens, ids_crc32`` of every stored document, from the files.

    ``before`` counts the ids before it within its shard.
    """
    schema = "part long, seq long, place long, before long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")
                ends = np.frombuffer(row["ends"], "<i8")
                starts = np.concatenate(([0], ends[:-1]))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ends)
                yield common.record_batch(
                    schema, np.full(n, row["part"]), np.full(n, row["seq"]), np.arange(n), starts, ends - starts, np.array(crc, np.int64))

    stored = spark.read.parquet(f"{path}/shards").select("part", "seq", "width", "ends", "payload")
    return stored.mapInArrow(run, schema)


def read_documents(keys: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the given keys, read from the files by the index.

    Unknown keys give no row; rows of a repeated key give one each.
    """
    spark = keys.sparkSession
    found = lookup(keys, path).withColumn("place", F.explode(F.sequence("place", F.col("place") + F.col("copies") - 1)))
    sizes = spark.read.parquet(f"{path}/shards").select("part", "seq", "n_ids")
    bases = _running(sizes, "n_ids").select("part", "seq", F.col("before").alias("shard_start"))
    rows = decoded(spark, path).join(found, ["part", "seq", "place"]).join(bases, ["part", "seq"])
    return rows.select(
        F.nullif("key", F.lit(NULL_KEY)).alias("doc_id"), (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
