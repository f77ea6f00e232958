"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

The words of all documents are counted for the terms of the test items. Each window of 10 consecutive item words takes its
``LISTS`` rarest terms, and postings (document, position) are stored for those terms alone. A posting less the term's place
in the item is the diagonal on which the item would lie in the document; where the lists of all rare terms of a
window meet on one diagonal, the words of the document are compared with all words of the item there, so only exact
occurrences count. ``near`` answers proximity queries from the same kind of index.

Words are lower-cased by A-Z only and cut at ASCII characters other than letters and digits; whole texts are used. Texts
are known by their 64-bit hash, so copies are indexed once and a repeated or null doc_id is no matter. Null or empty texts have
no words. Items without words match nothing; items with a null id hit words but are not listed or counted.
Equal item ids are one item in the list, each with its own words. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm import common

WINDOW = 10
LISTS = 2
CUTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    """The words of a text column; null has none."""
    cut = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), CUTS)
    return F.array_remove(cut, "")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))


def test_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """item (a key of its own), item_id, item_words and the length of its windows."""
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("item_words", words()).filter("size(item_words) > 0")
    rows = rows.select(F.xxhash64("item_id", F.concat_ws(" ", "item_words")).alias("item"), "item_id", "item_words").distinct()
    return common.stored(rows.withColumn("width", F.least(F.lit(window), F.size("item_words"))), "items")


def frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` (term) occurs in the texts; 0 where it does not."""
    found = docs.select(F.explode(words()).alias("word")).join(terms, F.col("word") == F.col("term"), "left_semi")
    counts = found.groupBy("word").count()
    return terms.join(counts, F.col("term") == F.col("word"), "left").select("term", F.coalesce("count", F.lit(0)).alias("times"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, th, pos) of ``terms`` in all texts, stored in the shared folder."""
    placed = docs.select("th", F.posexplode(words()).alias("pos", "word"))
    return common.stored(placed.join(terms, F.col("word") == F.col("term")).select("term", "th", "pos"), "postings")


def rare_places(items: DataFrame, counts: DataFrame, lists: int = LISTS, window: int = WINDOW) -> DataFrame:
    """item, width, the start and the words of each of its windows, and the places of the window's rarest terms.

    A row frame of ``window`` words runs over each item, so an item of any length takes linear time.
    """
    words_of = items.select("item", "width", F.size("item_words").alias("size"), F.posexplode("item_words").alias("place", "term"))
    ahead = Window.partitionBy("item").orderBy("place").rowsBetween(0, window - 1)
    framed = words_of.join(counts, "term").select(
        "item", "width", "size", F.col("place").alias("start"),
        F.collect_list(F.struct("times", "place")).over(ahead).alias("ranks"), F.collect_list("term").over(ahead).alias("phrase"),
    )
    rarest = F.slice(F.array_sort("ranks"), 1, lists)["place"]
    return framed.filter("start <= size - width").select("item", "width", "start", "phrase", rarest.alias("places"))


def occurrences(docs: DataFrame, items: DataFrame, lists: int = LISTS, window: int = WINDOW) -> DataFrame:
    """Exact occurrences of item windows: th, item_id, the first word in the text and the number of words.

    A window is likely where all its rarest terms stand on one diagonal of a text. The places of a text are gathered and
    its words cut around them, so a text is carried once, however many places it has.
    """
    placed = items.select("item", F.posexplode("item_words").alias("place", "term"))
    counts = common.stored(frequencies(docs, common.stored(placed.select("term").distinct(), "terms")), "frequencies")
    rare = common.stored(rare_places(items, counts, lists, window), "windows")
    wanted = rare.select("item", F.explode("places").alias("place")).distinct().join(placed, ["item", "place"])
    wanted = common.stored(wanted, "rare")
    index = build_index(docs, common.stored(wanted.select("term").distinct(), "terms"))

    on_diagonal = index.join(wanted, "term").select("th", "item", (F.col("pos") - F.col("place")).alias("diagonal"), "place")
    asked = rare.select("item", "start", "width", F.size("places").alias("needed"), F.explode("places").alias("place"))
    # Most diagonals hold fewer terms than any window of the item needs; only the others are held against the windows.
    fewest = rare.groupBy("item").agg(F.min(F.size("places")).alias("fewest"))
    many = on_diagonal.groupBy("th", "item", "diagonal").agg(F.collect_set("place").alias("places")).join(fewest, "item").filter("size(places) >= fewest")
    placed = many.select("th", "item", "diagonal", F.explode("places").alias("place"))
    met = placed.join(asked, ["item", "place"]).groupBy("th", "item", "diagonal", "start", "width", "needed").agg(F.count("*").alias("met"))
    likely = met.filter("met = needed AND diagonal + start >= 0").select("th", "item", "start", "width", (F.col("diagonal") + F.col("start")).alias("first_word"))
    likely = common.stored(likely, "likely")

    spots = likely.groupBy("th").agg(F.collect_list(F.struct("item", "start", "width", "first_word")).alias("spots"))
    texts = common.among(docs.filter("text IS NOT NULL"), likely).groupBy("th").agg(F.first("text").alias("text"))
    read = spots.join(texts.select("th", words().alias("doc_words")), "th")
    cut = "transform(spots, x -> struct(x.item, x.start, x.first_word, x.width, slice(doc_words, int(x.first_word) + 1, x.width) AS found))"
    found = read.select("th", F.explode(F.expr(cut)).alias("x")).select("th", "x.*")
    same = found.join(rare.select("item", "start", "phrase"), ["item", "start"]).filter("found = phrase")
    named = same.join(items.select("item", "item_id"), "item")
    return common.stored(named.select("th", "item_id", "first_word", F.col("width").alias("n")), "occurrences")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and item_ids for each row of ``docs``."""
    docs = documents(docs)
    found = occurrences(docs, test_items(items, window=window), lists, window)
    hit = found.select("th", F.explode(F.expr("sequence(first_word, first_word + n - 1)")).alias("pos")).distinct()
    hit = hit.groupBy("th").agg(F.count("*").alias("hits"))
    listed = found.groupBy("th").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    of_text = common.stored(hit.join(listed, "th"), "hits").withColumnRenamed("th", "hit_th")
    rows = docs.select("doc_id", "th", F.size(words()).cast("long").alias("n_words"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (
        rows.join(of_text, F.col("th") == F.col("hit_th"), "left")
        .select("doc_id", "n_words", F.coalesce("hits", F.lit(0)).cast("long").alias("n_hit"), ids.alias("item_ids"))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("item_ids").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            "item_ids",
        )
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    found = occurrences(documents(docs), test_items(items)).select("th").distinct()
    keys = common.among(docs.select(common.row_key(docs).alias("rid"), F.xxhash64("text").alias("th")), found).join(found, "th", "left_semi")
    return common.without(docs, common.stored(keys.select("rid").distinct(), "contaminated"))


def near(docs: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """Proximity matches: th, query_id and first_word wherever all ``terms`` of a query lie within ``span`` words.

    ``queries``: query_id and terms, an array of words as ``words`` cuts them. A match starts at one of the terms.
    Postings are dealt to blocks of ``span`` positions, so only positions close to each other meet.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct("terms")).alias("term"))
    size = asked.groupBy("query_id").agg(F.count("*").alias("size"))
    index = build_index(docs, common.stored(asked.select("term").distinct(), "terms"))
    placed = index.join(asked, "term").withColumn("block", F.floor(F.col("pos") / span))
    starts = placed.select("th", "query_id", F.col("pos").alias("first_word"), F.explode(F.expr("array(block, block + 1)")).alias("block"))
    inside = starts.join(placed, ["th", "query_id", "block"]).filter(f"pos >= first_word AND pos < first_word + {span}")
    met = inside.groupBy("th", "query_id", "first_word").agg(F.count_distinct("term").alias("met"))
    return met.join(size, "query_id").filter("met = size").select("th", "query_id", "first_word")


#: The same rows in DuckDB.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
spans AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS phrase FROM spans),
places AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS phrase
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT rid, item_id, s, n FROM places JOIN win USING (n, phrase)),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS pos FROM occ) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS joined FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""
