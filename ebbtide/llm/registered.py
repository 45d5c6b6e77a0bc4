"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from ebbtide.llm import (
    licenses, merkle, packing, pieces, projections, quality_rules, repair, simhash, site_style,
    small_world, substrings, suffixes, url_rules)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(function):
    QUERIES[function.__name__] = function
    return function


@register
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_votes(table(spark, folder, "documents"))


@register
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"), shingle=3, radius=2)


@register
def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    out = substrings.substring_dedup(table(spark, folder, "documents"), window=20)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), BYTE_BPE, capacity=1024, special=True)


URL_RULES = (
    url_rules.UrlRule("block", "net", "/"),
    url_rules.UrlRule("allow", "example.net", "/en/"),
    url_rules.UrlRule("block", "example.com", "/de/"),
    url_rules.UrlRule("allow", "org", "/fr/"),
)


@register
def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), URL_RULES)


ORACLES["op7_url_rules"] = url_rules.urls_sql(URL_RULES)


@register
def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoding_digests(table(spark, folder, "documents"), PIECE_BPE)


@register
def op3_site_style(spark: SparkSession, folder: str) -> DataFrame:
    return site_style.main_text(table(spark, folder, "pages"))


@register
def op9_projections(spark: SparkSession, folder: str) -> DataFrame:
    return projections.embedding_links(table(spark, folder, "embeddings"), least=0.9)


@register
def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"), inside=True)


ORACLES["op1_licenses"] = licenses.licenses_sql()


@register
def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.suffix_dedup(table(spark, folder, "documents"), window=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest_digests(table(spark, folder, "documents"))


ORACLES["op11_manifest"] = merkle.manifest_sql()


@register
def op12_repairs(spark: SparkSession, folder: str) -> DataFrame:
    return repair.conversation_repairs(table(spark, folder, "conversations"))


@register
def op13_small_world(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return small_world.nearest_neighbours(rows.where("vec_id % 50 = 0"), rows, k=5)


ORACLES["op13_small_world"] = small_world.nearest_sql()
