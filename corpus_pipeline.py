"""The training-data pipeline: documents through five operators, each stage's rows the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainloom.llm import common, decontaminate, mixing, quality, simhash, token_files
from rainloom.llm.queries import tokenizer_path
from rainloom.session import materialize, scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    common.tune_arrow(spark)
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    common.tune_arrow(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    common.tune_arrow(spark)
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it: not at all, once or twice."""
    common.tune_arrow(spark)
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files with their index; one row per stored document, read back from them."""
    common.tune_arrow(spark)
    path = scratch_dir(spark, "tokens")
    token_files.write(docs, tokenizer_path(), path)
    return token_files.read_documents(token_files.keys_of(docs), path)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: not to be stated in SQL: the classifier, the fingerprints and the tokenizer are outside it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
