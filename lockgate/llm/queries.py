"""The registered queries of the operators, with the parameters of production, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lockgate.llm import (
    decontaminate,
    jaccard_join,
    merkle,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secrets,
    sharding,
    substring_dedup,
    token_counts,
    url_filter,
    warc,
)
from lockgate.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rid")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), least=0)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=24)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("rid")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.find(texts))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_mixing,
        op3_decontamination,
        op4_warc,
        op5_sharding,
        op6_quality_classifier,
        op7_url_filter,
        op8_substring_dedup,
        op9_quality_rules,
        op10_jaccard_join,
        op11_periodic_runs,
        op12_secret_scan,
        op13_merkle_manifest,
    )
}
ORACLES = {
    "op3_decontamination": decontaminate.ORACLE,
    "op4_warc": warc.ORACLE,
    "op7_url_filter": url_filter.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_secret_scan": secrets.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
