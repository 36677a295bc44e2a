"""The queries over documents, embeddings and pages, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coinfold.llm.audit import AUDIT_SQL, filter_audit
from coinfold.llm.mixing import MIX_SQL, mix
from coinfold.llm.packing import pack
from coinfold.llm.periodic import run_report
from coinfold.llm.repeats import REPEATS_SQL, repeat_report
from coinfold.llm.secrets import secret_report
from coinfold.llm.sharding import SHARDS_SQL, assign_shards
from coinfold.llm.simhash import simhash_groups
from coinfold.llm.topk import top_products
from coinfold.llm.toxicity import toxicity
from coinfold.llm.url_rules import judge_sql, judge_urls
from coinfold.llm.vectors import near_vectors
from coinfold.llm.warc import ARCHIVE_SQL, archived

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql:
            ORACLE_SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


@query(MIX_SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query()
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


@query(judge_sql())
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query(SHARDS_SQL)
def op5_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


@query(ARCHIVE_SQL)
def op8_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


@query(AUDIT_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"))


@query(REPEATS_SQL)
def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))
