"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all
   words; a target stops at twice its source's words and the excess is shared again by weight.
2. Every source is cut into blocks: a keyed hash permutes its documents, and a document belongs to
   the block its permuted position falls in. Whole passes over the source are taken first; of the
   rest, blocks are taken in block order until the target is met, and of the block that crosses the
   target, the documents that fill the remainder best, largest first.
3. The block counts of all sources are the quotas of the tree's root. A node splits its quotas
   between two children by drawing from the urn without replacement (a multivariate hypergeometric
   draw), down to the output shards. The quotas of the shards add up exactly to the root's.
4. A second permutation orders each source's blocks; every shard draws its own disjoint range of
   that order, and each shard is shuffled locally by a keyed hash.

All draws are keyed hashes of ids, so reruns agree. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.session import materialize

#: fixed values: weights by the source's place in code-point order, the share of all words, the limit
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_REPEATS = 2
SEED = 17
#: words of one block, and of one task's part of an output shard, about
BLOCK_WORDS = 20_000
PART_WORDS = 2_000_000
#: the tree has as many levels as the words ask for, this many at most; more words split the shards
MAX_LEVELS = 12
#: most blocks of one source; beyond it blocks grow, so the tree's work does not
MAX_BLOCKS = 65_536
#: bits of a permuted position
POSITION_BITS = 32

#: names of helper columns beside those of the documents
_KEY, _AT = "__mix_key", "__mix_at"

WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column | str) -> Column:
    """Words of a text; null counts 0. White space is replaced and empty pieces are not counted."""
    value = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    blank = F.translate(value, "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(blank, " +"), "")).cast("long")


def _hash(*columns, salt: int) -> Column:
    return F.xxhash64(*columns, F.lit(SEED), F.lit(salt))


def _key(text: str = "text") -> Column:
    return _hash("doc_id", "source", text, salt=1)


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sharing the excess again by weight ends with one common rate: every target is the smaller of its
    limit and rate times weight. Sorted by limit per weight, the sources that reach their limit are a
    prefix, so the rate follows from running sums over the (few) sources.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    rows = by.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(MAX_REPEATS))
    first = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    after = first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything.orderBy("source")) * (SHARE_PERCENT / 100.0)
    rate = (F.col("total") - F.coalesce(F.col("full"), F.lit(0.0))) / F.col("left")
    rows = (rows.withColumn("total", total)
            .withColumn("full", F.sum("limit").over(before)).withColumn("left", F.sum("weight").over(after))
            .withColumn("rate", rate)
            .withColumn("open_rate", F.when(F.col("rate") * F.col("weight") < F.col("limit"), F.col("rate"))))
    common_rate = F.max("open_rate").over(everything.orderBy("source"))
    return (rows.withColumn("common", common_rate)
            .select("source", "source_size", F.least(F.col("limit"), F.coalesce(F.col("common"), F.lit(float("inf"))) * F.col("weight")).alias("target")))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _fill(documents: Column, room: Column) -> Column:
    """Keys of the documents that fill ``room`` best, largest first; one more if that comes closer."""
    start = F.struct(room.alias("room"), F.array().cast("array<bigint>").alias("taken"), F.lit(None).cast("struct<size:bigint,key:bigint>").alias("next"))

    def step(state, doc):
        fits = doc["size"] <= state["room"]
        return F.struct(
            F.when(fits, state["room"] - doc["size"]).otherwise(state["room"]).alias("room"),
            F.when(fits, F.concat(state["taken"], F.array(doc["key"]))).otherwise(state["taken"]).alias("taken"),
            F.when(fits, state["next"]).otherwise(F.struct(doc["size"].alias("size"), doc["key"].alias("key"))).alias("next"))

    def finish(state):
        closer = state["next"].isNotNull() & (2 * state["room"] > state["next"]["size"])
        return F.when(closer, F.concat(state["taken"], F.array(state["next"]["key"]))).otherwise(state["taken"])

    ordered = F.reverse(F.array_sort(documents))
    return F.aggregate(ordered, start, step, finish)


def plan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, source, size, key, source_size, target, block, whole, extra`` of every row.

    ``whole`` passes plus ``extra`` (0 or 1) are the times a document is taken. Rows alike in id,
    source and text share one ``key`` and are taken alike.
    """
    slim = docs.select("doc_id", "source", n_words(text).alias("size"), _key(text).alias("key"))
    return _planned(materialize(slim, "mix-sizes"))


def _planned(slim: DataFrame) -> DataFrame:
    """``key`` → source figures, block and times taken, for rows (doc_id, source, size, key)."""
    goal = materialize(targets(slim), "mix-targets")
    # one row per source: targets() proves the bound, the number of distinct sources
    blocks = F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("long")
    goal = goal.withColumn("n_blocks", blocks).withColumn(
        "whole", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("int"))
    goal = goal.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    position = F.shiftrightunsigned(_hash("key", salt=2), 64 - POSITION_BITS)
    g = goal.withColumnRenamed("source", "_s")
    placed = slim.join(g, _same(F.col("source"), F.col("_s"))).drop("_s").withColumn(
        "block", F.shiftright(position * F.col("n_blocks"), POSITION_BITS))
    sums = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("whole").alias("whole"))
    groups = F.floor(F.col("block") / 256)
    within = Window.partitionBy("source", "group").orderBy("block")
    grouped = sums.withColumn("group", groups)
    totals = grouped.groupBy("source", "group").agg(F.sum("words").alias("group_words"))
    base = totals.withColumn("base", F.sum("group_words").over(Window.partitionBy("source").orderBy("group")) - F.col("group_words"))
    b = base.select(F.col("source").alias("_s"), F.col("group").alias("_g"), "base")
    cut = (grouped.withColumn("before", F.sum("words").over(within) - F.col("words"))
           .join(b, _same(F.col("source"), F.col("_s")) & (F.col("group") == F.col("_g"))).drop("_s", "_g")
           .withColumn("before", F.col("before") + F.col("base")))
    state = F.when(F.col("before") + F.col("words") <= F.col("rest"), 1).when(F.col("before") >= F.col("rest"), 0).otherwise(2)
    cut = materialize(cut.select("source", "block", "words", "whole", state.alias("state"), (F.col("rest") - F.col("before")).alias("room")), "mix-blocks")
    c = cut.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "state", "room")
    stated = placed.join(c, _same(F.col("source"), F.col("_s")) & (F.col("block") == F.col("_b"))).drop("_s", "_b")
    # one crossing block per source; its documents are bounded by the block's size
    crossing = stated.where("state = 2").groupBy("source", "room", "key").agg(F.sum("size").alias("size")).groupBy("source", "room").agg(
        F.collect_list(F.struct("size", "key")).alias("members"))
    chosen = crossing.select(F.explode(_fill(F.col("members"), F.col("room"))).alias("_k"), F.lit(1).alias("_in")).distinct()
    return stated.join(chosen, F.col("key") == F.col("_k"), "left").select(
        "doc_id", "source", "size", "key", "source_size", "target", "block", "whole",
        F.when(F.col("state") == 2, F.coalesce("_in", F.lit(0))).otherwise(F.col("state")).alias("extra"))


def split_quotas(quotas: DataFrame, levels: int) -> DataFrame:
    """(shard, source, n): the quotas (source, n) split among ``2 ** levels`` shards.

    A node's row holds its urn, one entry per source. The left child gets half of the node's blocks
    (an odd one by a keyed coin), each block in turn with the chance left-to-draw / left-in-urn, which
    is a draw without replacement: the counts by source are multivariate hypergeometric.
    """
    urn = F.array_sort(F.collect_list(F.struct("source", F.col("n").cast("long").alias("n"))))
    node = quotas.groupBy().agg(urn.alias("urn")).select(F.lit(1).cast("long").alias("node"), "urn")
    for _ in range(levels):
        total = F.aggregate("urn", F.lit(0).cast("long"), lambda a, q: a + q["n"])
        coin = F.pmod(_hash("node", salt=3), F.lit(2))
        node = node.withColumn("total", total).withColumn("draws", F.floor((F.col("total") + coin) / 2).cast("long"))
        start = F.struct(
            F.col("total").alias("urn_left"), F.col("draws").alias("to_draw"),
            F.array().cast("array<bigint>").alias("out"))

        def source_step(state, q):
            def block_step(b, i):
                chance = F.pmod(_hash("node", b["urn_left"], salt=4), F.lit(1 << 52)) / float(1 << 52)
                hit = (chance * b["urn_left"] < b["to_draw"]).cast("long")
                return F.struct((b["urn_left"] - 1).alias("urn_left"), (b["to_draw"] - hit).alias("to_draw"), (b["k"] + hit).alias("k"))

            begin = F.struct(state["urn_left"].alias("urn_left"), state["to_draw"].alias("to_draw"), F.lit(0).cast("long").alias("k"))
            items = F.when(q["n"] > 0, F.sequence(F.lit(1).cast("long"), q["n"])).otherwise(F.array().cast("array<bigint>"))
            end = F.aggregate(items, begin, block_step)
            return F.struct(end["urn_left"].alias("urn_left"), end["to_draw"].alias("to_draw"), F.concat(state["out"], F.array(end["k"])).alias("out"))

        drawn = node.withColumn("left", F.aggregate("urn", start, source_step, lambda e: e["out"]))
        left = F.zip_with("urn", "left", lambda q, k: F.struct(q["source"].alias("source"), k.alias("n")))
        right = F.zip_with("urn", "left", lambda q, k: F.struct(q["source"].alias("source"), (q["n"] - k).alias("n")))
        children = F.array(*[
            F.struct((F.col("node") * 2 + side).alias("node"), urn.alias("urn")) for side, urn in enumerate((left, right))])
        node = materialize(drawn.select(F.explode(children).alias("c")).select("c.*"), "mix-tree")
    return node.select((F.col("node") - (1 << levels)).alias("shard"), F.explode("urn").alias("q")).select("shard", "q.source", "q.n")


def assign(planned: DataFrame, levels: int) -> DataFrame:
    """(key, shards): the output shard of every time a document is taken, from ``_planned`` rows."""
    taken = planned.withColumn("times", F.col("whole") + F.col("extra"))
    units = taken.where("times > 0").groupBy("source", "block").agg(F.max("times").alias("times"))
    units = units.select("source", "block", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("pass"))
    quotas = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy(_hash("block", "pass", salt=5), "block", "pass")
    ranked = units.withColumn("rank", F.row_number().over(order).cast("long"))
    ends = Window.partitionBy("source").orderBy("shard")
    leaves = split_quotas(quotas, levels).withColumn("end", F.sum("n").over(ends))
    bounds = leaves.groupBy(F.col("source").alias("_s")).agg(F.array_sort(F.collect_list("end")).alias("ends"))
    placed = ranked.join(bounds, _same(F.col("source"), F.col("_s"))).select(
        F.col("source").alias("_s"), F.col("block").alias("_b"), "pass",
        F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard"))
    rows = taken.join(placed, _same(F.col("source"), F.col("_s")) & (F.col("block") == F.col("_b")) & (F.col("pass") <= F.col("times")))
    return rows.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("pass", "shard"))).alias("shards"))


def _levels(planned: DataFrame, levels: int | None) -> tuple[int, int]:
    """Levels of the tree, and further ones by which its shards are spread over tasks."""
    words = planned.agg(F.sum(F.col("size") * (F.col("whole") + F.col("extra")))).first()[0] or 0
    wanted = max(int(words) // PART_WORDS, 1).bit_length() - 1
    levels = min(wanted, MAX_LEVELS) if levels is None else levels
    return levels, max(wanted - levels, 0)


def _draw(docs: DataFrame, planned: DataFrame, levels: int | None) -> DataFrame:
    """The mixed rows of ``docs``, for its plan."""
    names = docs.columns
    levels, parts = _levels(planned, levels)
    shards = assign(planned, levels)
    keyed = docs.withColumn(_KEY, _key())
    rows = keyed.join(shards.select(F.col("key").alias(_KEY), F.explode("shards").alias(_AT)), _KEY)
    order = _hash(_KEY, F.col(f"{_AT}.pass"), salt=6)
    part = F.pmod(order, F.lit(1 << parts))
    spread = rows.repartition(1 << (levels + parts), F.col(f"{_AT}.shard"), part).sortWithinPartitions(F.col(f"{_AT}.shard"), part, order)
    return spread.select(*names)


def mix(docs: DataFrame, levels: int | None = None) -> DataFrame:
    """The mixed rows: every document as often as it is taken, with the columns of ``docs``.

    Rows are grouped by output shard (``2 ** levels``, by default enough for ``PART_WORDS`` words
    each) and shuffled within it; the shards of a very large mixture are spread over several tasks.
    """
    return _draw(docs, materialize(plan(docs), "mix-plan"), levels)


def mix_counts(docs: DataFrame, levels: int | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row, counted in a drawn mixture.

    The mixture of all documents is drawn and shuffled, texts included, and its rows are counted:
    ``taken`` is the document's words times the rows it has there, 0 without any. Null and empty texts have size 0 and
    take 0 words; a null source is a source of its own. Repeated rows come back each, and share
    the rows of the mixture evenly.
    """
    planned = materialize(plan(docs), "mix-plan")
    mixed = _draw(docs.select("doc_id", "source", "text"), planned, levels)
    # of the finished mixture only the keys of its rows are written; writing them keeps its order
    keys = materialize(mixed.select(_key().alias("key")), "mix-drawn")
    drawn = keys.groupBy("key").agg(F.count(F.lit(1)).alias("drawn"))
    alike = planned.groupBy("key").agg(F.count(F.lit(1)).alias("alike"))
    times = alike.join(drawn, "key").select("key", "drawn", "alike")
    taken = F.coalesce(F.expr("size * drawn div alike"), F.lit(0))
    return planned.join(times, "key", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"))
