"""URL allow and block rules by a sort-merge range join.

A rule (host, path) fits its host and all subdomains if the URL's path starts with the rule's. The
canonical key of a host and path is the reversed host labels, a separator, and the path; all keys a
rule covers for one exact host form an interval that starts at the rule's own key. A URL is probed
once for each suffix of its host. Rules and probes are sorted together by key. Intervals are nested
or disjoint, so the sweep carries the stack of the last rule at or before a probe; the entries that
are a prefix of the probe's key are the active rules, and the longest is the top. The winner among a
URL's probes is the longest rule.

The sweep runs on range partitions of the sorted keys. What a partition needs from those before it is
one stack, the last one there, found from one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.session import materialize

ALLOW, BLOCK = "allow", "block"
#: verdict where no rule fits
DEFAULT_VERDICT = ALLOW

#: fixed values: the rules of the registered query, as (host, path, verdict)
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATOR = "\x01"


def host_of(url: Column | str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    value = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    return F.translate(F.regexp_extract(value, r"(?s)^.*?://([^/?#]*)", 1), _CAPITALS, _SMALL)


def path_of(url: Column | str) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    value = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    return F.regexp_extract(value, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.concat_ws(".", F.transform(labels, lambda x: F.translate(x, _SEPARATOR, "�"))), F.lit(_SEPARATOR), path)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule key with ``stack``: the rules it lies in, itself included.

    A rule given twice for one host and path blocks if any of them does. Rules with a null host, path
    or verdict are no rules.
    """
    clean = rules.where("host is not null and path is not null and verdict in ('allow', 'block')").select(
        F.translate("host", _CAPITALS, _SMALL).alias("host"), "path", "verdict")
    once = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))     # "block" > "allow"
    keyed = once.select(
        _key(_reversed_labels(F.col("host")), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict", "path", F.length("host").alias("host_n"))
    # a rule's ancestors have its host and a shorter path, so their keys are prefixes of its key
    shorter = keyed.withColumn("cut", F.explode(F.sequence(F.lit(0), F.length("path"))))
    prefixes = shorter.select("key", F.expr("left(key, length(key) - cut)").alias("prefix"))
    held = keyed.select(F.col("key").alias("prefix"), "rule", "verdict", "host_n")
    entry = F.struct(F.length("prefix").alias("n"), F.col("prefix").alias("prefix"), F.col("rule"), F.col("verdict"), F.col("host_n"))
    return prefixes.join(held, "prefix").groupBy("key").agg(F.array_sort(F.collect_list(entry)).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id``, ``url``).

    ``rule`` is the longest rule that fits (by host and path together, then the longer host), null if
    none does; then ``verdict`` is ``default``. Null URLs and URLs without ``://`` have an empty host
    and path. Repeated rows come back each; other columns are ignored. No rules leave all to default.
    """
    urls = pages.select(F.col("page_id"), host_of("url").alias("host"), path_of("url").alias("path"))
    distinct = urls.select("host", "path").distinct()
    labels = distinct.withColumn("labels", _reversed_labels(F.col("host")))
    probes = labels.select("host", "path", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("depth"), "labels").select(
        "host", "path", _key(F.slice("labels", F.lit(1), F.col("depth")), F.col("path")).alias("key"))
    empty = F.lit(None)
    stacks = rule_stacks(rules)
    kind = stacks.schema["stack"].dataType
    events = stacks.select("key", F.lit(0).alias("kind"), empty.cast("string").alias("host"), empty.cast("string").alias("path"), "stack").unionByName(
        probes.select("key", F.lit(1).alias("kind"), "host", "path", empty.cast(kind).alias("stack")))
    sorted_ = materialize(events.repartitionByRange("key", "kind", "host").withColumn("range", F.spark_partition_id()), "url-sweep")
    last = sorted_.where("kind = 0").groupBy("range").agg(F.max_by("stack", "key").alias("last"))
    ranges = sorted_.select("range").distinct().join(last, "range", "left")      # one row per partition
    carried = ranges.select("range", F.last("last", ignorenulls=True).over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = sorted_.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1").join(carried, "range")
    active = F.filter(F.coalesce("open", "carried"), lambda e: F.startswith(F.col("key"), e["prefix"]))
    top = swept.select("host", "path", F.try_element_at(active, F.lit(-1)).alias("top")).where("top is not null")
    strength = F.struct(F.length("top.rule").alias("n"), F.col("top.host_n").alias("host_n"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))
    best = top.groupBy("host", "path").agg(F.max(strength).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_frame(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


#: ``judge`` with ``RULES`` in SQL
SQL = f"""
with parts as (
  select page_id, url, strpos(url, '://') as mark from pages),
urls as (
  select page_id,
    case when mark > 0 then translate(regexp_extract(substr(url, mark + 3), '^[^/?#]*', 0), '{_CAPITALS}', '{_SMALL}') else '' end as host,
    case when mark > 0 then regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from parts),
rules(rule_host, rule_path, rule_verdict) as (values {", ".join(str(r) for r in RULES)}),
fits as (
  select page_id, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from urls join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select u.page_id, host, path, rule, coalesce(rule_verdict, '{DEFAULT_VERDICT}') as verdict
from urls u left join fits f on u.page_id = f.page_id and place = 1
"""
