"""Exact Jaccard join of word n-gram sets by partitioning the universe of n-grams.

Sets of one size band hash the universe into the same ``m`` segments. Two sets of sizes a and b that
reach the similarity differ in at most ``budget(a, b)`` n-grams, so by the pigeonhole rule they agree
on some segments: if a set gives its segments weights 0 (not asked), 1 (equal subsets) or 2 (subsets
that differ by one n-gram) that add up to more than its budget, every partner meets it in one of
them. Weights go to the cheapest segments:

1. Subsets are counted by key. A subset nobody else has costs nothing; a set with more such segments
   than its budget has no partner and leaves (most sets do).
2. N-grams that no other of the remaining sets has differ from every partner, so a set with too many
   of them leaves as well, and subsets are counted anew.
3. The others ask for their cheapest subsets. Where these are frequent, one-deletion neighbourhoods of
   the set's segments are indexed and counted too, and the weights are dealt again by cost; a partner
   that meets a set in frequent subsets only is in the same position, so beyond their rare subsets
   these sets need look at each other only.
4. Candidates are verified on the whole sets. Every set is first compared with one centre, the typical
   set it shares most buckets with. A bucket never gives all its pairs: pivots are compared with the
   bucket, then everything that fell into one component is settled; two sets that must differ too much,
   by their own n-grams and by what each shares with their common centre, are no pair. The number of
   pivots grows from round to round, best-linked members first, until no bucket joins two components.

A set takes part in its own band and, if it may have partners there, in the band above.
N-grams are told apart by XXH64 hashes, sets by 128-bit digests of their hashes.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rainloom.llm import common
from rainloom.llm.components import components
from rainloom.session import materialize

SHINGLE = 5
SEED = 29
#: holders of a subset beyond which it is called frequent
HOT = 32
#: bits of the filter that keeps most sets without candidates from being sent to the verification
FILTER_BITS = 1 << 24
_BITMAP = 1 << 15                  # bits of one bitmap of Spark's bitmap functions

_PRINT = "doc_id long, digest binary, n int, t_own int, h_own int, t_above int, h_above int, keys array<long>"
_SET = "digest binary, hashes array<long>, sketch binary"
_NEIGHBOUR = "key long, node long, seg int, whole boolean"
_ASKED = "node long, seg int, weight int"
_LINK = "u long, v long, shared int"


@dataclass(frozen=True)
class Rule:
    """Similarity of ``num / den`` or more, and the size bands and segments it asks for."""

    num: int = 80
    den: int = 100

    def holds(self, inter: int, union: int) -> bool:
        return self.den * inter >= self.num * union

    def budget(self, a, b):
        """The largest symmetric difference of similar sets of sizes a and b."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def largest(self, a):
        """The largest size of a partner."""
        return a * self.den // self.num

    @cached_property
    def upper(self) -> np.ndarray:
        """Largest size of every band; a band's sizes differ by a factor of about 1.7."""
        ends = [1]
        while ends[-1] < 1 << 40:
            low = ends[-1] + 1
            ends.append(max(low, self.largest(low), low * 17 // 10))
        return np.array(ends, np.int64)

    @cached_property
    def most(self) -> np.ndarray:
        """Largest budget in every band."""
        return self.budget(self.upper, self.upper)

    @cached_property
    def spare(self) -> np.ndarray:
        """Segments used beyond the budget plus one: so many subsets may be shared by chance."""
        return 1 + self.most // 8

    @cached_property
    def segments(self) -> np.ndarray:
        """Segments of every band."""
        return self.most + 1 + self.spare

    def roles(self, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Band of each size, segments used and budget there, and those in the band above (0: no part).

        A set uses the first segments only, as many as its own budget asks for. The larger of two sets
        uses all that the smaller does, so they agree on some of the smaller one's.
        """
        band = np.searchsorted(self.upper, n)
        far = self.largest(n)
        h_own = self.budget(n, np.minimum(far, self.upper[band]))
        above = far > self.upper[band]
        h_above = self.budget(n, np.minimum(far, self.upper[band + 1]))
        return (band, h_own + 1 + self.spare[band], h_own, np.where(above, h_above + 1 + self.spare[band + 1], 0),
                np.where(above, h_above, 0))


def shingles(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a UTF-8 text; the whole text if it has fewer words."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = zip(*(words[k:] for k in range(size))) if len(words) >= size else [words]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64))


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return [shingles(text or b"", size) for text in batch.column("text").cast("binary").to_pylist()]


def _spread(hashes: np.ndarray, band: int, m: int) -> np.ndarray:
    """Segment of every n-gram in a band."""
    return (common.mix(hashes ^ np.uint64(0x9E6D5A3B71C4F28D + band * 2654435761)) % np.uint64(m)).astype(np.int64)


def _subset_key(sums: np.ndarray, segs: np.ndarray, band: int) -> np.ndarray:
    """Key of a subset, given as the sum of its mixed hashes, of a segment of a band."""
    return common.mix(sums ^ common.mix(segs.astype(np.uint64) + np.uint64((band + 1) << 40)))


def segment_keys(hashes: np.ndarray, band: int, m: int, used: int) -> np.ndarray:
    """Keys of the set's subsets in the first ``used`` of a band's ``m`` segments."""
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, _spread(hashes, band, m), common.mix(hashes))
    return _subset_key(sums[:used], np.arange(used), band)


def _prints(docs: DataFrame, size: int, rule: Rule) -> DataFrame:
    """Digest, size and roles of every row's set, and the keys of its subsets: those of its own band
    first, then those of the band above. Of equal sets in a row only the first has the keys."""
    def run(batches):
        for batch in common.slices(batches):
            sets = _sets(batch, size)
            n = np.array([len(s) for s in sets], np.int64)
            band, t_own, h_own, t_above, h_above = rule.roles(n)
            digests, seen, keys = list(map(_digest, sets)), set(), []
            for s, d, b, own, above in zip(sets, digests, band.tolist(), t_own.tolist(), t_above.tolist()):
                if len(s) and d not in seen:
                    seen.add(d)
                    parts = [segment_keys(s, b, int(rule.segments[b]), own)]
                    if above:
                        parts.append(segment_keys(s, b + 1, int(rule.segments[b + 1]), above))
                    keys.append(np.concatenate(parts).view(np.int64))
                else:
                    keys.append(np.zeros(0, np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            yield common.record_batch(
                _PRINT, batch.column("doc_id"), digests, *[c.astype(np.int32) for c in (n, t_own, h_own, t_above, h_above)],
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys))))

    return common.id_and_text(docs).mapInArrow(run, _PRINT).withColumn("row", F.monotonically_increasing_id())


def _filter_slot() -> F.Column:
    """Bit of the candidate filter that belongs to a digest."""
    return F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % F.lit(FILTER_BITS) + 1


def _hashes_of(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``id, hashes, sketch`` of the chosen sets (``digest, id``), from the texts.

    A bitmap of fixed size keeps most other sets from being shuffled; the join by digest is exact.
    """
    slot = _filter_slot()
    bitmaps = chosen.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bitmap in bitmaps.collect():           # at most FILTER_BITS / 8 bytes in all
        bits[(bucket - 1) * _BITMAP // 8:bucket * _BITMAP // 8] = np.frombuffer(bitmap, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        bits = shared.value
        for batch in common.slices(batches):
            known = {_digest(s): s for s in _sets(batch, size)}
            at = np.array([int.from_bytes(d[:4], "big") for d in known], np.int64) % FILTER_BITS
            wanted = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            rows = [(d, s.view(np.int64), sketch(s).tobytes()) for (d, s), w in zip(known.items(), wanted) if w and len(s)]
            if rows:
                yield common.record_batch(_SET, *map(list, zip(*rows)))

    found = common.id_and_text(docs).select("text").mapInArrow(run, _SET)
    chosen = materialize(chosen, "chosen")
    return found.join(chosen, "digest").groupBy("id").agg(
        F.first("hashes").alias("hashes"), F.first("sketch").alias("sketch"))


def _accompanied(hashes: DataFrame, rule: Rule) -> DataFrame:
    """``id, n, own`` of the sets that may have a partner; ``own`` n-grams are in no other of the sets.

    A partner lacks all of them, so too many leave too little to share.
    """
    grams = hashes.select("id", F.explode("hashes").alias("gram"))
    alone = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("holders"), F.min("id").alias("id")).where("holders = 1")
    own = alone.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("own"))
    return hashes.select("id", F.size("hashes").alias("n")).join(own, "id", "left").select(
        "id", "n", F.coalesce("own", F.lit(0)).alias("own")).where(rule.den * (F.col("n") - F.col("own")) >= rule.num * F.col("n"))


def _neighbours(hard: DataFrame, rule: Rule) -> DataFrame:
    """Whole subsets and one-deletion neighbours of all segments of the given nodes (``node, hashes``)."""
    def run(batches):
        for batch in batches:
            for node, hashes in zip(batch.column("node").to_pylist(), _values(batch.column("hashes"))):
                band, t_own, _, t_above, _ = (int(r[0]) for r in rule.roles(np.array([len(hashes)])))
                band, used = (band + 1, t_above) if node & 1 else (band, t_own)
                segs, mixed, sums = _spread(hashes, band, int(rule.segments[band])), common.mix(hashes), np.zeros(rule.segments[band], np.uint64)
                np.add.at(sums, segs, mixed)
                segs, mixed = segs[segs < used], mixed[segs < used]
                all_segs = np.concatenate((np.arange(used), segs))
                keys = _subset_key(np.concatenate((sums[:used], sums[segs] - mixed)), all_segs, band).view(np.int64)
                yield common.record_batch(
                    _NEIGHBOUR, keys, np.full(len(keys), node), all_segs.astype(np.int32), np.arange(len(keys)) < used)

    return hard.select("node", "hashes").mapInArrow(run, _NEIGHBOUR)


def allocate(first: list[int], second: list[int], total: int) -> list[int]:
    """Weights 0 to 2 of segments that add up to ``total`` (if they can), cheapest steps first."""
    weights = [0] * len(first)
    steps = [(cost, i) for i, cost in enumerate(first)]
    heapq.heapify(steps)
    while total > 0 and steps:
        _, i = heapq.heappop(steps)
        weights[i] += 1
        total -= 1
        if weights[i] == 1:
            heapq.heappush(steps, (second[i], i))
    return weights


def _dealt(costs: DataFrame) -> DataFrame:
    """Weights of the segments of every node (``node, total, segs``: structs of seg, first, second)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segs = row["segs"]
                weights = allocate([s["first"] for s in segs], [s["second"] for s in segs], row["total"])
                asked = [(s["seg"], w) for s, w in zip(segs, weights) if w]
                yield common.record_batch(
                    _ASKED, [row["node"]] * len(asked), *map(list, zip(*asked)))

    return costs.mapInArrow(run, _ASKED)


_SIDE = "key long, id long, side int, probe boolean"


def _frequent_buckets(hard: DataFrame, hashes: DataFrame, rule: Rule) -> DataFrame:
    """Buckets of the sets whose cheapest subsets are frequent (``node, id, total``), weights dealt anew.

    ``side`` is 0 in buckets of equal subsets; in those of neighbourhoods 1 for the whole subset, 2 for
    one with a deletion, and only different sides need be compared.
    """
    near = materialize(_neighbours(hard.join(hashes, "id"), rule), "neighbours")
    counts = near.groupBy("key").agg(F.count_if("whole").alias("n_whole"), F.count_if(~F.col("whole")).alias("n_cut"))
    priced = near.join(counts, "key")
    others = F.col("n_whole") - 1
    costs = priced.groupBy("node", "seg").agg(
        F.sum(F.when(F.col("whole"), others).otherwise(0)).alias("first"),
        F.sum(F.when(F.col("whole"), F.col("n_cut")).otherwise(F.col("n_whole"))).alias("second"))
    by_node = costs.groupBy("node").agg(F.collect_list(F.struct("seg", "first", "second")).alias("segs"))
    asked = materialize(_dealt(by_node.join(hard.select("node", "total"), "node")), "asked")
    rows = near.join(asked, ["node", "seg"], "left").select(
        "key", F.shiftright("node", 1).alias("id"), "whole", F.coalesce("weight", F.lit(0)).alias("weight"))
    equal = rows.where("whole").select("key", "id", F.lit(0).alias("side"), (F.col("weight") > 0).alias("probe"))
    both = counts.where("n_whole > 0 and n_cut > 0").select("key")
    cut = rows.join(both, "key", "left_semi").select(
        F.xxhash64("key", F.lit("cut")).alias("key"), "id", F.when(F.col("whole"), 1).otherwise(2).alias("side"),
        (F.col("weight") > 1).alias("probe"))
    return equal.unionByName(cut)


def _without_twins(rows: DataFrame) -> DataFrame:
    """Buckets that may join two sets; of buckets with the same members one."""
    signs = [F.sum(F.xxhash64("id", "side", "probe", F.lit(k)).cast("decimal(38,0)")).alias(f"sign{k}") for k in (0, 1)]
    found = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("probe").alias("asked"), *signs)
    chosen = found.where("members > 1 and asked").groupBy("members", "sign0", "sign1").agg(F.min("key").alias("key"))
    return rows.join(chosen.select("key"), "key", "left_semi")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Sixteen bits of every hash, in order: sets share no more hashes than their sketches share values."""
    return (hashes >> np.uint64(48)).astype("<u2")


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two ascending sketches share, counting repeats: no fewer than their sets share."""
    short, long_ = sorted((x, y), key=len)
    value, first, times = np.unique(short, return_index=True, return_counts=True)
    other = np.searchsorted(long_, value, "right") - np.searchsorted(long_, value, "left")
    return int(np.minimum(times, other).sum())


def exactly_shared(x: np.ndarray, y: np.ndarray) -> int:
    short, long_ = sorted((x, y), key=len)
    at = np.searchsorted(long_, short)
    return int((long_[np.minimum(at, len(long_) - 1)] == short).sum())


def _values(column: pa.Array) -> list[np.ndarray]:
    """The sets or sketches of a column."""
    if pa.types.is_list(column.type):
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
        return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    return [np.frombuffer(x, "<u2") for x in column.to_pylist()]


def _similar(pairs: DataFrame, sides: DataFrame, shared, rule: Rule, every: bool = False) -> DataFrame:
    """Pairs (u, v) that reach the similarity, or ``every`` pair, if ``shared`` tells what they share;
    ``sides``: id and set."""
    def run(batches):
        for batch in batches:
            keep, inters = [], []
            for x, y in zip(_values(batch.column("x")), _values(batch.column("y"))):
                inter = shared(x, y) if every or max(len(x), len(y)) <= rule.largest(min(len(x), len(y))) else 0
                keep.append(every or rule.holds(inter, len(x) + len(y) - inter))
                inters.append(inter)
            yield common.record_batch(_LINK, batch.column("u"), batch.column("v"), inters).filter(pa.array(keep, pa.bool_()))

    first, second = (sides.toDF("u", "x"), sides.toDF("v", "y"))
    return pairs.join(first, "u").join(second, "v").select("u", "v", "x", "y").mapInArrow(run, _LINK)


def _verified(pairs: DataFrame, hashes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (u, v) whose whole sets reach the similarity.

    Sketches, a quarter of the size, go first: they overrate what two sets share, so they only dismiss
    pairs that cannot be similar.
    """
    likely = materialize(_similar(pairs, hashes.select("id", "sketch"), most_shared, rule), "likely")
    return _similar(likely.select("u", "v"), hashes.select("id", "hashes"), exactly_shared, rule).select("u", "v")


def _may_link(rule: Rule) -> F.Column:
    """Whether a member and a pivot (columns ``p_``) can be similar, by what is known of each.

    Own n-grams are in no other set. The rest of each splits into what is in its centre (``inter``) and
    what is not; with the same centre both parts differ by at least their difference in size.
    """
    rest, p_rest = F.col("n") - F.col("own"), F.col("p_n") - F.col("p_own")
    inside, outside = F.col("inter") - F.col("p_inter"), rest - F.col("inter") - (p_rest - F.col("p_inter"))
    differ = F.when(F.col("centre") == F.col("p_centre"), F.abs(inside) + F.abs(outside)).otherwise(F.abs(rest - p_rest))
    return (rule.den - rule.num) * (F.col("n") + F.col("p_n")) >= (rule.den + rule.num) * (F.col("own") + F.col("p_own") + differ)


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that may still join two components, with their labels."""
    now = buckets.join(labels, "id")
    open_ = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("probe").alias("asked"))
    return materialize(now.join(open_.where("low < high and asked").select("key"), "key", "left_semi"), "open_buckets")


def _centred(now: DataFrame, labels: DataFrame, hashes: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Labels with each set's centre and what it shares with it, and the pairs (u, v) compared for that, with
    ``linked``.

    Every bucket names its member with the most company (in a group of near copies that is the text
    most like all others); a set's centre is the one that most of its buckets name.
    """
    named = now.groupBy("key").agg(F.max(F.struct("company", F.xxhash64("id").alias("h"), "id")).alias("best"))
    votes = now.join(named, "key").groupBy("id", "best").agg(F.count(F.lit(1)).alias("votes"))
    chosen = votes.groupBy("id").agg(F.max(F.struct("votes", "best")).alias("most")).select(
        F.col("id").alias("u"), F.col("most.best.id").alias("v")).where("u <> v")
    shared = materialize(_similar(chosen, hashes.select("id", "hashes"), exactly_shared, rule, every=True), "centres")
    sizes = labels.select("id", "n")
    compared = shared.join(sizes.toDF("u", "n_u"), "u").join(sizes.toDF("v", "n_v"), "v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"),
        (rule.den * F.col("shared") >= rule.num * (F.col("n_u") + F.col("n_v") - F.col("shared"))).alias("linked"))
    centred = labels.drop("centre", "inter").join(shared.select(F.col("u").alias("id"), F.col("v").alias("centre"), F.col("shared").alias("inter")), "id", "left")
    return centred.withColumn("centre", F.coalesce("centre", "id")).withColumn(
        "inter", F.coalesce("inter", F.col("n") - F.col("own"))), materialize(compared, "compared")


def _linked(buckets: DataFrame, sized: DataFrame, hashes: DataFrame, rule: Rule) -> DataFrame | None:
    """Star edges (u, v) that connect what all links among the buckets' candidates connect; None without any.

    At first each set meets its centre. Each round then compares up to ``8 ** round`` pivots of a bucket
    with those members in other components that may be similar: pivots with the most links so far, then
    those with the most company. A pivot has then met its whole bucket and asks no more, so the rounds
    end. No pair is compared twice.
    """
    company = buckets.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("others"))
    labels = materialize(buckets.join(company, "key").groupBy("id").agg(F.sum("others").alias("company")).join(sized, "id").select(
        "id", F.col("id").alias("root"), F.lit(0).cast("long").alias("links"), "company", "n", "own"), "labels")
    now = _open(buckets, labels)
    labels, compared = _centred(now, labels, hashes, rule)
    seen, found, edges, turn = compared.select("u", "v").distinct(), compared.where("linked").select("u", "v").distinct(), None, 0
    while True:
        if not found.isEmpty():
            stars = components(found if edges is None else edges.unionByName(found))
            edges = stars.select(F.col("node").alias("u"), F.col("root").alias("v"))
            new = found.select(F.explode(F.array("u", "v")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("new"))
            labels = labels.drop("root").join(new, "id", "left").join(stars, labels["id"] == stars["node"], "left").select(
                "id", F.coalesce("root", "id").alias("root"), (F.col("links") + F.coalesce("new", F.lit(0))).alias("links"),
                "company", "n", "own", "centre", "inter")
        if turn == 0 or not found.isEmpty():
            labels = materialize(labels, "labels")
        now = _open(buckets, labels)
        lot = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(1 << min(3 * turn, 40)))
        told = ("id", "side", "root", "n", "own", "centre", "inter")
        best = F.max(F.struct("links", "company", F.xxhash64("id").alias("h"), *told)).alias("best")
        pivots = now.where("probe").groupBy("key", lot.alias("lot")).agg(best)
        pivots = materialize(pivots.select("key", *[F.col(f"best.{c}").alias(f"p_{c}") for c in told]), "pivots")
        if pivots.isEmpty():
            return edges
        pairs = now.join(pivots, "key").where("root <> p_root and (side = 0 or side <> p_side)").where(_may_link(rule)).select(
            F.least("id", "p_id").alias("u"), F.greatest("id", "p_id").alias("v")).distinct()
        pairs = materialize(pairs.join(seen, ["u", "v"], "left_anti"), "pairs")
        seen = seen.unionByName(pairs)
        found = materialize(_verified(pairs, hashes, rule), "links")
        done = pivots.select("key", F.col("p_id").alias("id"), F.lit(True).alias("met")).distinct()
        buckets = now.join(done, ["key", "id"], "left").select(
            "key", "id", "side", (F.col("probe") & F.col("met").isNull()).alias("probe"))
        turn += 1


def join_sets(docs: DataFrame, size: int = SHINGLE, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Prints of all rows, the distinct sets (``digest, id, first_id, n``) and star edges between set ids.

    The edges lead from each set to the smallest of its component, if that is another; None: no edges.
    """
    prints = materialize(_prints(docs, size, rule), "prints")
    roles = [F.first(c).alias(c) for c in ("n", "t_own", "h_own", "t_above", "h_above")]
    sets = prints.where("n > 0").groupBy("digest").agg(F.min("row").alias("id"), F.min("doc_id").alias("first_id"), *roles)
    sets = materialize(sets, "sets")
    # a node is a set in one of its bands: twice its id, plus one in the band above
    keyed = prints.select(F.col("row").alias("id"), "t_own", "keys").join(sets.select("id"), "id").select(
        "id", "t_own", F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("key", (F.col("id") * 2 + (F.col("at") >= F.col("t_own")).cast("long")).alias("node"))
    keyed = keyed.where("key is not null and node is not null").repartition("key")
    # the same columns and filters on both sides: one shuffle then serves both
    shared = keyed.groupBy("key").agg(F.count("node").alias("holders")).where("holders > 1")
    found = keyed.join(shared, "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("subsets"))
    nodes = sets.select(F.explode(F.expr(
        "filter(array(named_struct('node', id * 2, 't', t_own, 'h', h_own), named_struct('node', id * 2 + 1, 't', t_above, 'h', h_above)), x -> x.t > 0)")
    ).alias("x")).select("x.*")
    # a set is left with candidates if no more subsets than its budget are its own
    active = found.join(nodes, "node").where("t - size(subsets) <= h").select(
        "node", F.shiftright("node", 1).alias("id"), "t", (F.col("h") + 1).alias("total"), "subsets")
    active = materialize(active, "active")
    hashes = materialize(_hashes_of(docs, sets.join(active.select("id").distinct(), "id", "left_semi").select("digest", "id"), size), "hashes")
    sized = materialize(_accompanied(hashes, rule), "sized")
    hashes = materialize(hashes.join(sized.select("id"), "id", "left_semi"), "accompanied")
    held = active.join(sized.select("id"), "id", "left_semi").select(
        "node", "t", "total", F.explode("subsets.key").alias("key")).repartition("key")
    again = held.groupBy("key").agg(F.count("node").alias("holders")).where("holders > 1")
    active = held.join(again, "key").groupBy("node", "t", "total").agg(
        F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("subsets")).where("t - size(subsets) < total").select(
        "node", F.shiftright("node", 1).alias("id"), "total",
        (F.col("total") - F.col("t") + F.size("subsets")).alias("need"), "subsets")
    active = materialize(active, "active")
    hard = active.where(F.element_at("subsets", F.col("need")).getField("holders") > HOT).select("node", "id", "total")
    asks = (F.col("at") < F.col("need")) & (F.col("subset.holders") <= HOT)
    rows = active.select("id", "need", F.posexplode("subsets").alias("at", "subset")).select(
        F.col("subset.key").alias("key"), "id", F.lit(0).alias("side"), asks.alias("probe"))
    if not hard.isEmpty():
        rows = rows.unionByName(_frequent_buckets(hard, hashes, rule).withColumn("key", F.xxhash64("key", F.lit("hard"))))
    buckets = materialize(_without_twins(rows), "buckets")
    return prints, sets, _linked(buckets, sized, hashes, rule)


def components_of(docs: DataFrame, size: int = SHINGLE, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links of similar sets. A text without words
    (null, empty, white space) has no set and is its own component. Rows with a null ``doc_id`` link
    too but never name a component (a component of only such rows has a null id). Repeated rows each
    come back. Other columns are ignored; an empty table gives no rows.
    """
    prints, sets, links = join_sets(docs, size, rule)
    if links is None:
        rooted = sets.withColumn("root", F.col("id"))
    else:
        rooted = sets.join(links, sets["id"] == links["u"], "left").withColumn("root", F.coalesce("v", "id"))
    rooted = materialize(rooted.select("digest", "first_id", "root"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(lowest, "root").select(F.col("digest").alias("set_digest"), "component_id"), "named")
    rows = prints.join(named, F.col("digest") == F.col("set_digest"), "left")
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
