"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    bpe, fingerprints, inner_products, packing, page_text, periodic_runs, personal_data, quality_classifier, quality_rules,
    ranked_search, simhash, token_counts, token_files,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The public vocabularies, on every executor at the same path.
BYTE_BPE = path("byte_bpe_50k.json")
WORD_BPE = path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), BYTE_BPE)


@query("op2_quality_rules", quality_rules.rules_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_token_files(token_files.write_token_files(documents(spark, sf_dir), BYTE_BPE, end_id=2))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), WORD_BPE)


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), WORD_BPE)


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(documents(spark, sf_dir)).drop("text_hash")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(documents(spark, sf_dir))


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


@query("op9_page_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_top_products", inner_products.products_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("key") % 20 == 0)


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.with_planted_runs(documents(spark, sf_dir)))


@query("op13_ranked_search", ranked_search.ranked_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
