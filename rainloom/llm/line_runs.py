"""Removal of repeated runs of lines: a suffix array over line ids by distributed prefix doubling.

The lines of all documents (those with a word) form one long sequence of line ids. Prefix doubling
ranks the suffix that starts at each line: ranks by one line come from the sorted distinct lines, and
ranks by d + s lines from the sorted distinct pairs of ranks at a place and s lines further. Only
suffixes that are tied with another are carried on; a rank is the number of tied suffixes before it,
summed over range partitions. Suffixes of equal rank at depth ``MIN_LINES`` are the common-prefix
intervals of that depth. Within an interval the first place (smallest id, then line) stays, and the
lines covered by the others are deleted; neighbouring and overlapping ones join to maximal runs.

Everything is DataFrame operations. A frequent line is one row among the distinct pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.session import materialize

MIN_LINES = 3
#: stands for a null id: larger than any other
NULL_ID = (1 << 63) - 1

_BLANK = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text")).withColumn("digest", F.xxhash64("text"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) for distinct pairs (a, b, n): one more than the sum of ``n`` over smaller pairs."""
    sorted_ = materialize(pairs.repartitionByRange("a", "b").withColumn("part", F.spark_partition_id()), "line-pairs")
    totals = sorted_.groupBy("part").agg(F.sum("n").alias("total"))            # one row per partition
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("a", "b")) - F.col("n")
    return sorted_.withColumn("within", within).join(bases, "part").select("a", "b", (F.col("base") + F.col("within") + 1).alias("rank"))


def _refine(places: DataFrame) -> DataFrame:
    """Places (id, digest, p, a, b) with ``rank`` by (a, b); 0 where the pair is null or occurs once."""
    pairs = places.where("a is not null and b is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranks = _ranked(pairs)
    return places.join(ranks, ["a", "b"], "left").select("id", "digest", "p", F.coalesce("rank", F.lit(0)).alias("rank"))


def _deleted(docs: DataFrame, min_lines: int) -> DataFrame:
    """(id, digest, numbers): for documents with repeated runs, the numbers of their lines to delete."""
    numbered = F.transform(_lines(F.col("text")), lambda l, i: F.struct(
        i.alias("line"), F.when(F.length(F.trim(l, F.lit(_BLANK))) > 0, F.xxhash64(l)).alias("a"), F.xxhash64(F.lit(1), l).alias("b")))
    filled = F.filter(numbered, lambda x: x["a"].isNotNull())
    # rows alike in id and text are one document
    once = _keyed(docs).select("id", "digest", filled.alias("lines")).groupBy("id", "digest").agg(F.first("lines").alias("lines"))
    once = materialize(once.where(F.size("lines") >= min_lines), "line-documents")
    places = once.select("id", "digest", F.posexplode("lines").alias("p", "x")).select("id", "digest", "p", "x.a", "x.b")
    ranked, depth = materialize(_refine(places), "line-ranks"), 1
    in_order = Window.partitionBy("id", "digest").orderBy("p")
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ahead = F.lead("rank", step).over(in_order)
        pairs = ranked.select("id", "digest", "p", F.nullif("rank", F.lit(0)).alias("a"), F.nullif(ahead, F.lit(0)).alias("b"))
        ranked, depth = materialize(_refine(pairs), "line-ranks"), depth + step
    tied = ranked.where("rank > 0")
    here = F.struct("id", "digest", "p")
    first = tied.groupBy("rank").agg(F.min(here).alias("first"))
    later = tied.join(first, "rank").where(here != F.col("first"))
    covered = later.select("id", "digest", F.explode(F.sequence(F.col("p"), F.col("p") + (min_lines - 1))).alias("q"))
    by_doc = covered.groupBy("id", "digest").agg(F.collect_set("q").alias("places"))
    run_starts = F.array_except("places", F.transform("places", lambda q: q + 1))
    return by_doc.join(once, ["id", "digest"]).select(
        "id", "digest", F.size(run_starts).cast("long").alias("n_runs"), F.transform("places", lambda q: F.get("lines", q)["line"]).alias("numbers"))


def delete_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_runs, text`` of every row: the text without later copies.

    A line is deleted if it lies in a run of ``min_lines`` lines (counting only lines with a word)
    that also starts earlier: in a smaller ``doc_id``, or in the same text further up. ``n_lines``
    counts lines with a word, ``n_runs`` maximal deleted runs. A null text is empty; a null id counts
    as the largest. Rows alike in id and text are one document and come back alike, each; rows of one
    id with other texts are ordered by a hash of the text.
    """
    numbers = _deleted(docs, min_lines)
    rows = _keyed(docs).join(numbers, ["id", "digest"], "left")
    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("numbers"))
    filled = F.size(F.filter(lines, lambda l: F.length(F.trim(l, F.lit(_BLANK))) > 0))
    return rows.select(
        F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), filled.cast("long").alias("n_lines"),
        F.when(F.col("numbers").isNull(), 0).otherwise(F.size("numbers")).cast("long").alias("n_removed"),
        F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"),
        F.when(F.col("numbers").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")).alias("text"))


#: ``delete_runs`` in SQL, for documents whose ids differ
SQL = """
with rows as (select doc_id, coalesce(text, '') as body from documents),
pieces as (select doc_id, string_split(body, chr(10)) as l from rows),
lines as (select doc_id, unnest(l) as s, unnest(range(1, len(l) + 1)) as line from pieces),
filled as (
  select doc_id, s, line, row_number() over (partition by doc_id order by line) as p
  from lines where trim(s, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
runs as (
  select doc_id, p, s, lead(s, 1) over (partition by doc_id order by p) as s2, lead(s, 2) over (partition by doc_id order by p) as s3
  from filled),
placed as (
  select doc_id, p, row_number() over (partition by s, s2, s3 order by doc_id, p) as k from runs where s3 is not null),
gone as (select distinct doc_id, p + d as p from placed, (values (0), (1), (2)) v(d) where k > 1),
marked as (
  select f.doc_id, f.line, g.p is not null as del,
    g.p is not null and not coalesce(lag(g.p is not null) over (partition by f.doc_id order by f.p), false) as opens
  from filled f left join gone g on f.doc_id = g.doc_id and f.p = g.p),
counted as (
  select doc_id, count(*) as n_lines, count(*) filter (where del) as n_removed, count(*) filter (where opens) as n_runs
  from marked group by doc_id),
kept as (
  select l.doc_id, string_agg(l.s, chr(10) order by l.line) as body
  from lines l left join marked m on l.doc_id = m.doc_id and l.line = m.line
  where not coalesce(m.del, false) group by l.doc_id)
select r.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, coalesce(n_runs, 0) as n_runs, coalesce(k.body, '') as text
from rows r left join counted c on r.doc_id = c.doc_id left join kept k on r.doc_id = k.doc_id
"""
