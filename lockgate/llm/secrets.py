"""Secrets in texts: fixed patterns, and strings that two character Markov models call random.

DataFrame operations only. A pattern's matches and the gaps between them come as two arrays of the same scan; the start
of a match is the running sum of the lengths before it, taken by a window over the matches of one text, so long texts with
many matches stay linear. Positions count code points.

The models are first-order chains over the ``SYMBOLS`` letters, digits and signs of a token. One is counted from random
strings, one from ordinary identifiers; the log-likelihood ratio of a pair of characters is kept in thousandths, so sums
are exact. ``train`` takes any table of labelled samples (token, label); ``samples`` makes one of a corpus: what the
patterns caught is labelled random (of assignments only values with a digit), every other token of the corpus ordinary.
Each distinct token counts once, so copies and boilerplate weigh nothing. The random model is mixed with an even chain,
as keys of other alphabets than those caught are random too; the ordinary one falls back on how often a character occurs. The models have at most ``2 * SYMBOLS ** 2`` counts, which is
all that the driver sees.

Null and empty texts have no spans. Repeated rows are each judged. A corpus without secrets has an even random chain.
Every kind is looked for in the whole text, whether or not another kind covers a place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm import common

# The patterns of the contract. Case classes are spelled out, as engines fold case differently.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
# A longest run of these characters that is too short is no finding, so the bound may stand in the pattern.
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE, LEAST_ACCESS = 8, 16

TOKEN = r"[A-Za-z0-9+/_-]"
SYMBOLS = 66
LEAST_CANDIDATE = 12
LEAST_SAMPLE = 4
CANDIDATE = rf"{TOKEN}{{{LEAST_CANDIDATE},}}"
SAMPLE = rf"{TOKEN}{{{LEAST_SAMPLE},}}"
PAIRS = r"(?=(..))"
MIX = 0.5
#: Thousandths of a nat that a token must be likelier as a random string.
THRESHOLD = 12_000

KINDS = ["assign", "access", "hex", "markov"]


def _hits(pattern: str, group: int = 0) -> Column:
    """Each match with the length of the gap before it; one row more, without a match, ends the text."""
    text, wanted = F.col("text"), F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    matches = F.regexp_extract_all(text, wanted, F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, wanted, F.lit(group))
    pieces = F.zip_with(matches, values, lambda m, v: F.struct(F.length(m).alias("len"), v.alias("value")))
    hits = F.zip_with(gaps, pieces, lambda g, p: F.struct(g.alias("gap"), p["len"].alias("len"), p["value"].alias("value")))
    return F.when(text.rlike(pattern), hits)


def matches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, key, one array of matches a kind), stored: the texts are read once for all patterns."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    patterns = [_hits(ASSIGN, 2), _hits(ACCESS), _hits(HEX), _hits(CANDIDATE)]
    return common.stored(rows.select("rid", "key", *[p.alias(k) for p, k in zip(patterns, KINDS)]), "matches")


def spans(found: DataFrame) -> DataFrame:
    """(rid, kind, start, end, value) of every match; kind is the place in ``KINDS``."""
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).alias("hits")) for i, k in enumerate(KINDS)])
    of_kind = found.select("rid", F.explode(kinds).alias("k")).filter("k.hits IS NOT NULL")
    pieces = of_kind.select("rid", "k.kind", F.posexplode("k.hits").alias("place", "hit")).select("rid", "kind", "place", "hit.*")
    before = Window.partitionBy("rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(before)
    placed = pieces.withColumn("end", end).filter("len IS NOT NULL")
    return placed.select("rid", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value")


def is_base() -> Column:
    """Whether a match of a fixed pattern is long enough."""
    kind, size = F.col("kind"), F.length("value")
    return F.when(kind == 0, size >= LEAST_VALUE).when(kind == 1, size >= LEAST_ACCESS).otherwise(kind == 2)


def samples(docs: DataFrame, placed: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (token, label) of a corpus: 1 for what the patterns caught, 0 for every other token."""
    caught = placed.filter(is_base()).filter("kind > 0 OR value RLIKE '[0-9]'")
    random = caught.select(F.explode(F.regexp_extract_all("value", F.lit(SAMPLE), F.lit(0))).alias("token")).distinct()
    tokens = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(SAMPLE), F.lit(0))).alias("token")).distinct()
    plain = tokens.join(random, "token", "left_anti")
    return random.withColumn("label", F.lit(1)).unionByName(plain.withColumn("label", F.lit(0)))


@dataclass(frozen=True)
class Model:
    """Thousandths of a nat for each pair of characters, by 128 * first + second."""

    ratios: tuple[int, ...]

    def score(self, token: Column) -> Column:
        """Sum over the pairs of a token; the pairs are cut by one linear scan."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")
        pairs = F.regexp_extract_all(token, F.lit(PAIRS), F.lit(1))
        place = lambda p: F.ascii(p) * 128 + F.ascii(F.substring(p, 2, 1)) + 1
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda s, p: s + F.element_at(table, place(p)))


def _alphabet() -> list[str]:
    return [*map(chr, range(65, 91)), *map(chr, range(97, 123)), *map(chr, range(48, 58)), *"+/_-"]


def train(labelled: DataFrame) -> Model:
    """The two models of samples (token, label), as ratios. Tokens may hold other characters; such pairs are not counted."""
    pairs = labelled.select("label", F.explode(F.regexp_extract_all("token", F.lit(PAIRS), F.lit(1))).alias("pair"))
    counted = pairs.filter(F.col("pair").rlike(rf"\A{TOKEN}{{2}}\z")).groupBy("label", "pair").count()
    seen = {(r["label"], r["pair"]): r["count"] for r in counted.collect()}
    symbols = _alphabet()
    ratios = [0] * (128 * 128)
    ends = {s: sum(seen.get((0, a + s), 0) for a in symbols) for s in symbols}
    overall = {s: (ends[s] + 1) / (sum(ends.values()) + SYMBOLS) for s in symbols}
    for first in symbols:
        random_all, plain_all = (sum(seen.get((label, first + s), 0) for s in symbols) for label in (1, 0))
        for second in symbols:
            share = seen.get((1, first + second), 0) / random_all if random_all else 1 / SYMBOLS
            random = MIX * share + (1 - MIX) / SYMBOLS
            plain = (seen.get((0, first + second), 0) + SYMBOLS * overall[second]) / (plain_all + SYMBOLS)
            ratios[128 * ord(first) + ord(second)] = math.floor(1000 * math.log(random / plain) + 0.5)
    return Model(tuple(ratios))


def scan(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(key, spans) of every row: array of (start, kind, end), by start and kind.

    Without a model one is trained from the corpus itself. Rows without any match do not move.
    """
    found = matches(docs, key, text)
    placed = common.stored(spans(found), "spans")
    model = model or train(samples(docs, placed, text))
    judged = placed.filter(F.when(F.col("kind") < 3, is_base()).otherwise(model.score(F.col("value")) >= threshold))
    listed = judged.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    rows = found.select("rid", "key", reduce(or_, [F.col(k).isNotNull() for k in KINDS]).alias("any"))
    matched = rows.filter("any").join(listed, "rid", "left").select("key", F.coalesce("spans", F.array()).alias("spans"))
    empty = rows.filter("NOT any").select("key", F.array().cast(matched.schema["spans"].dataType).alias("spans"))
    return matched.unionByName(empty).withColumnRenamed("key", key)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""
    names = F.array(*map(F.lit, KINDS))

    def listed(which: Column) -> Column:
        entry = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        return F.array_join(F.transform(which, entry), ",")

    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return scanned.select(
        "doc_id",
        *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(F.encode(listed(F.filter("spans", lambda s: s["kind"] < 3)), "utf-8"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        n(3).alias("n_markov"),
    )


def _pieces_sql(kind: int, pattern: str, group: int = 0) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT rid, {kind} AS kind, unnest(range(1, len(m) + 1)) AS place, unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap,
unnest(list_transform(m, lambda x: length(x))) AS len, unnest(v) AS value FROM (
SELECT rid, string_split_regex(text, '{quoted}') AS g, regexp_extract_all(text, '{quoted}', 0) AS m, regexp_extract_all(text, '{quoted}', {group}) AS v FROM docs)"""


ORACLE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({" UNION ALL ".join([_pieces_sql(0, ASSIGN, 2), _pieces_sql(1, ACCESS), _pieces_sql(2, HEX), _pieces_sql(3, CANDIDATE)])}),
placed AS MATERIALIZED (SELECT rid, kind, len, value, CAST(sum(gap + len) OVER (PARTITION BY rid, kind ORDER BY place) AS BIGINT) AS stop FROM pieces),
base AS (SELECT * FROM placed WHERE (kind = 0 AND length(value) >= {LEAST_VALUE}) OR (kind = 1 AND length(value) >= {LEAST_ACCESS}) OR kind = 2),
random AS (SELECT DISTINCT unnest(regexp_extract_all(value, '{SAMPLE}', 0)) AS token FROM base WHERE kind > 0 OR regexp_matches(value, '[0-9]')),
tokens AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{SAMPLE}', 0)) AS token FROM docs),
labelled AS (SELECT token, 1 AS label FROM random UNION ALL SELECT token, 0 FROM tokens WHERE token NOT IN (SELECT token FROM random)),
pairs AS (SELECT label, substr(token, CAST(i AS INT), 1) AS a, substr(token, CAST(i + 1 AS INT), 1) AS b
  FROM (SELECT label, token, unnest(range(1, length(token))) AS i FROM labelled)),
counted AS MATERIALIZED (SELECT a, b, count(*) FILTER (label = 1) AS c1, count(*) FILTER (label = 0) AS c0 FROM pairs GROUP BY ALL),
symbols AS (SELECT chr(CAST(i AS INT)) AS s FROM range(128) t(i) WHERE regexp_full_match(chr(CAST(i AS INT)), '{TOKEN}')),
cells AS (SELECT x.s AS a, y.s AS b, coalesce(c1, 0) AS c1, coalesce(c0, 0) AS c0 FROM symbols x CROSS JOIN symbols y LEFT JOIN counted ON a = x.s AND b = y.s),
totals AS (SELECT *, sum(c1) OVER (PARTITION BY a) AS t1, sum(c0) OVER (PARTITION BY a) AS t0,
  (sum(c0) OVER (PARTITION BY b) + 1)::DOUBLE / (sum(c0) OVER () + {SYMBOLS})::DOUBLE AS overall FROM cells),
model AS MATERIALIZED (SELECT a, b, CAST(floor(1000 * ln(({MIX}::DOUBLE * CASE WHEN t1 > 0 THEN c1::DOUBLE / t1::DOUBLE ELSE 1::DOUBLE / {SYMBOLS} END
  + {1 - MIX}::DOUBLE / {SYMBOLS}) / ((c0::DOUBLE + {SYMBOLS}::DOUBLE * overall) / (t0 + {SYMBOLS})::DOUBLE)) + 0.5::DOUBLE) AS BIGINT) AS ratio FROM totals),
candidates AS (SELECT DISTINCT value FROM placed WHERE kind = 3),
judged AS (SELECT value, sum(ratio) AS score FROM (
  SELECT value, substr(value, CAST(i AS INT), 1) AS a, substr(value, CAST(i + 1 AS INT), 1) AS b
  FROM (SELECT value, unnest(range(1, length(value))) AS i FROM candidates)) JOIN model USING (a, b) GROUP BY 1),
found AS (SELECT rid, kind, stop - len AS start, stop FROM base
  UNION ALL SELECT rid, kind, stop - len, stop FROM placed JOIN judged USING (value) WHERE kind = 3 AND score >= {THRESHOLD}),
named AS (SELECT *, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'markov' END || ':' || start || ':' || stop AS entry FROM found)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
sha256(coalesce(string_agg(entry, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
coalesce(string_agg(entry, ',' ORDER BY start, kind), '') AS spans, count(*) FILTER (kind = 3) AS n_markov
FROM docs LEFT JOIN named USING (rid) GROUP BY rid, doc_id
"""
