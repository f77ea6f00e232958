"""Allow and block rules for URLs, matched by hash prefixes.

The distinct (host, path) pairs of the URLs are expanded into every host suffix at a dot, times every prefix of the path
that is as long as some rule's path. The first 32 bits of the SHA-256 of ``host + path`` are joined with those of the
rules; the full digests then confirm the hit. The longest rule wins; of equally long ones the one with the longer host,
then the first by text, then block before allow.

Host and path are taken literally: after the first ``://``, ports and user names included. URLs that are null or lack
``://`` have an empty host and path and no rule fits. A rule with an empty host or a null part fits nothing. Without a
fitting rule the verdict is ``default``. Repeated pages give repeated rows; null ids stay; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


#: The labels of host from the i-th to the last.
SUFFIX = "array_join(slice(split(host, '[.]', -1), i, size(split(host, '[.]', -1))), '.')"


def _prefix(digest: str) -> Column:
    """32 bits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict for each row of ``pages``."""
    rules = rules.filter("host <> '' AND path IS NOT NULL AND action IS NOT NULL").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "action"
    )
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("digest", F.sha2("rule", 256))
    rules = rules.withColumn("short", _prefix("digest")).withColumn("n_host", F.length("rule_host"))
    # how long paths in rules are: no more numbers than the longest path has characters
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())

    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    places = rows.select("host", "path").filter("host <> ''").distinct()
    suffixes = f"transform(sequence(1, size(split(host, '[.]', -1))), i -> {SUFFIX})"
    spans = "filter(array(" + ", ".join(f"{n}" for n in lengths) + "), n -> n <= length(path))" if lengths else "array()"
    expanded = (
        places.withColumn("suffix", F.explode(F.expr(suffixes)))
        .withColumn("span", F.explode(F.expr(spans).cast("array<int>")))
        .withColumn("expression", F.expr("concat(suffix, substring(path, 1, span))"))
        .withColumn("full", F.sha2("expression", 256))
        .withColumn("start", _prefix("full"))
    )
    hits = expanded.join(rules, F.col("start") == F.col("short")).filter("full = digest AND suffix = rule_host AND span = length(rule_path)")
    first = F.min_by(F.struct("rule", "action"), F.struct((-F.length("rule")).alias("n"), (-F.col("n_host")).alias("h"), "rule", (F.col("action") != "block").alias("a")))
    best = hits.groupBy("host", "path").agg(first.alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )


#: The same rows in DuckDB.
ORACLE = f"""
WITH rules(h, p, action) AS (VALUES {", ".join(map(str, RULES))}),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
hits AS (
  SELECT host, path, h || p AS rule, action,
    row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, length(h) DESC, h || p, action DESC) AS k
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, u.host, u.path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN hits ON u.host = hits.host AND u.path = hits.path AND k = 1
"""
