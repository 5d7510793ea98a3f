"""Registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rainloom.llm import (
    common, decontaminate, jaccard_join, line_runs, mixing, pii, quality, ranked_search, simhash, suffix_dedup,
    token_alignment, token_files, toxicity, url_rules,
)
from rainloom.session import scratch_dir

#: tokenizer file, on every executor
TOKENIZER = "byte_bpe_50k.json"
SECOND_TOKENIZER = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(query):
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.tune_arrow(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = tuned
    return query


@register
def op1_quality_rules(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@register
def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(common.documents(spark, sf_dir))


@register
def op3_url_rules(spark, sf_dir):
    return url_rules.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), url_rules.rule_frame(spark))


SQL["op3_url_rules"] = url_rules.SQL


@register
def op4_pii(spark, sf_dir):
    return pii.counts(common.documents(spark, sf_dir))


@register
def op5_line_runs(spark, sf_dir):
    return line_runs.delete_runs(common.documents(spark, sf_dir))


SQL["op5_line_runs"] = line_runs.SQL


@register
def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(common.documents(spark, sf_dir))


@register
def op7_toxicity(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@register
def op8_mixing(spark, sf_dir):
    return mixing.mix_counts(common.documents(spark, sf_dir))


@register
def op9_decontamination(spark, sf_dir):
    return decontaminate.matches(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op10_token_files(spark, sf_dir):
    docs, path = common.documents(spark, sf_dir), scratch_dir(spark, "tokens")
    token_files.write(docs, tokenizer_path(), path)
    return token_files.read_documents(token_files.keys_of(docs), path)


@register
def op11_token_alignment(spark, sf_dir):
    return token_alignment.align(common.documents(spark, sf_dir), tokenizer_path(), tokenizer_path(SECOND_TOKENIZER))


@register
def op12_ranked_search(spark, sf_dir):
    path = scratch_dir(spark, "k2-treap")
    ranked_search.write_index(common.documents(spark, sf_dir), path)
    return ranked_search.search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), path)


SQL["op12_ranked_search"] = ranked_search.SQL


@register
def op13_jaccard_join(spark, sf_dir):
    return jaccard_join.components_of(common.documents(spark, sf_dir))
