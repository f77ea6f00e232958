"""A corpus pipeline of five stages, each one of the operators in ``lockgate.llm``.

1. quality rules: rows that the base rules or the outlier test reject go
2. n-gram Jaccard join: one row of each group of near-duplicates stays
3. benchmark decontamination: rows that hold a window of a benchmark item go
4. mixing: rows stay by the rates that bring the domains to their target weights
5. sharding: the rows that are left are dealt to shards

Every stage but the last returns the columns of ``documents``. Between stages the rows are written as Parquet. Null and empty
texts, repeated rows, empty tables and further columns pass the stages as their operators say: rows without words fail the
quality rules, equal rows are one group of copies, an empty table stays empty, further columns stay with their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lockgate.llm import common, decontaminate, jaccard_join, mixing, quality_rules, sharding

DOMAINS = {"clean": "toxic = 0", "toxic": "toxic = 1"}
TARGETS = {"clean": 0.99, "toxic": 0.01}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tidy(spark)
    judged = common.stored(quality_rules.judge(docs), "judged")
    return common.without(docs, judged.filter("NOT kept").select("rid"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tidy(spark)
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tidy(spark)
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poor rows are gone by now, so the domains are clean and toxic text; at most one copy of a row, so rates end at 1.

    The clean domain has the largest target and keeps all of its tokens.
    """
    common.tidy(spark)
    labels = common.table(spark, sf_dir, "labels")
    rated = common.stored(mixing.mix(docs, labels, domains=DOMAINS, targets=TARGETS, max_rate=1.0), "rated")
    return common.without(docs, rated.filter("n_copies = 0").select("rid"))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tidy(spark)
    return sharding.assign(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: The outlier test, the classifier and the sampled splitters cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
