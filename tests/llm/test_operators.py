"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and odd columns."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lockgate.llm import (
    common,
    decontaminate,
    jaccard_join,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    url_filter,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, th string, n_words string, rid int"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def corpus() -> list[tuple]:
    rng = random.Random(4)
    texts: list[str | None] = [None, "", "  \n\t ", "one", "one two three", "One TWO three", "é" * 30, "same " * 3000]
    base = words(rng, 120)
    for k in range(12):
        near = list(base)
        for _ in range(k // 2):
            near[rng.randrange(len(near))] = f"new{rng.random()}"
        texts.append(" ".join(near))
    passage = words(rng, 60)
    for _ in range(6):
        texts.append(" ".join(words(rng, 80) + passage + words(rng, 70)))
    texts += [" ".join(words(rng, rng.randint(1, 150))) for _ in range(20)]
    texts += [" ".join(words(rng, 6))] * 2 + ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g h j"]
    texts.append(" ".join(words(rng, 20_000)))
    rows = [(i, t, ("en", None)[i % 7 == 0], f"s{i % 3}", 1, 5, "x", "y", 3) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (1000, rows[9][1], "de", None, None, None, None, None, None), (None, rows[10][1], "de", "s", 1, 1, "", "", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return common.stored(spark.createDataFrame(corpus(), DOCS).repartition(3), "test-docs")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(1, 0, 0), (None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def shingle_sets() -> dict[int, set]:
    found = {}
    for row in corpus():
        w = (row[1] or "").encode().lower().split()
        found[row[0]] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    return found


def test_jaccard_join(docs, no_docs):
    sets = {k: v for k, v in shingle_sets().items() if k is not None}
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    got = jaccard_join.join(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root(r.doc_id))
    assert sum(root(i) != i for i in sets) > 5
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(i for i in sets if root(i) == i)
    assert jaccard_join.join(no_docs).count() == 0


def test_subsets_of_light_sets_decide_exactly():
    for a in range(1, 15):
        for b in jaccard_join.partner_sizes(a):
            for both in range(min(a, b) + 1):
                assert (100 * both >= 75 * (a + b - both)) == (both >= jaccard_join.least_overlap(a, b))
    assert jaccard_join.choose_boundary({}, 1.0) == 0
    assert jaccard_join.choose_boundary({5: 100}, 10.0) >= 5


def brute_statistics(text: str) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    where: dict = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i : i + 3]), []).append(i)
    again = {k for v in where.values() if len(v) > 1 for i in v for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


@pytest.mark.parametrize("text", ["", "a", "a b c a b c", "é #x\né #x\n\n\n \n", "x\x1cy\x85z\xa0w", "a a a a", "l\nl\r\nl\n", "<b>|&"])
def test_text_statistics(text):
    assert quality_rules.text_statistics(text.encode(), common.WordIds()) == brute_statistics(text)


def test_quality_rules(spark, docs, no_docs):
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(corpus())
    by_id = {r[0]: r[1] or "" for r in corpus()}
    for r in got:
        if r.doc_id is not None:
            expected = brute_statistics(by_id[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
            assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
            assert not (r.base_failed and r.kept)
    assert quality_rules.judge(no_docs).count() == 0
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, 90)), "en", "s") for i in range(150)]
    rows += [(200 + i, " ".join(w + "###" for w in words(rng, 90)), "en", "s") for i in range(20)]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in judged if not r.kept} == set(range(200, 220))


def test_quality_rules_judges_the_last_small_pool(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, 90)), "en", "s") for i in range(150)]
    rows += [(200, " ".join(words(rng, 90)), "rare", "t"), (201, " ".join(w + "###" for w in words(rng, 90)), "rare", "t")]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in judged if not r.kept} == {201} and len(judged) == 152


def test_mcd_steps_find_the_clean_majority(spark):
    rng = np.random.default_rng(1)
    clean, bad = rng.normal(0, 1, (300, 4)), rng.normal(8, 0.3, (60, 4))
    rows = [("g", *map(float, r)) for r in np.concatenate([clean, bad])]
    model = quality_rules.fit(spark.createDataFrame(rows, "g string, f0 double, f1 double, f2 double, f3 double")).first()
    assert np.abs(np.array(model["mean"]) - clean.mean(0)).max() < 0.25
    assert abs(quality_rules.consistency(0.75) - 1.4) < 0.1


BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short item"), (3, None), (4, "..."), (None, "solo")]


def test_decontamination(spark, no_docs):
    texts = [
        (1, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda y"),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota other"),
        (3, "a short-item here and SHORT item"),
        (4, None),
        (5, ""),
        (6, "solo É solo"),
        (1, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda y"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([*BENCH, BENCH[0]], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].contaminated) == (13, 11, 1, True)
    assert got[1].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert (got[2].n_hit, got[2].items_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert (got[3].n_words, got[3].n_hit, got[3].item_ids) == (7, 4, ["2"])
    assert (got[4].n_words, got[5].n_words) == (0, 0)
    assert (got[6].n_words, got[6].n_hit, got[6].n_items) == (3, 2, 0)
    assert decontaminate.decontaminate(docs, items).count() == 7
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [2, 4, 5]
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice("pqrst") for _ in range(40))) for i in range(10)]
    docs = decontaminate.documents(spark.createDataFrame(texts, "doc_id long, text string"))
    queries = spark.createDataFrame([("x", ["p", "q", "s"]), ("y", ["t", "none"])], "query_id string, terms array<string>")
    got = {(r.doc_id, r.first_word) for r in decontaminate.near(docs, queries, 4).join(docs, "th").filter("query_id = 'x'").collect()}
    expected = set()
    for i, text in texts:
        w = text.split()
        expected |= {(i, k) for k in range(len(w)) if w[k] in "pqs" and {"p", "q", "s"} <= set(w[k : k + 4])}
    assert got == expected and expected


def test_mixing(docs, no_docs, labels, spark):
    got = mixing.mix(docs, labels).collect()
    assert len(got) == len(corpus()) and all(r.rate >= 0 and abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-6 for r in got)
    assert mixing.mix(no_docs, labels).count() == 0
    assert mixing.mix(docs, labels.limit(0)).filter("p_good < 0.999 OR rate < 0.999").count() == 0
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    rows = spark.createDataFrame([(int(n), *map(float, r)) for n, r in zip(rng.integers(1, 500, 400), p)], "n_tokens long, p_a double, p_b double, p_c double")
    targets = np.array([0.2, 0.1, 0.4])
    gradients = mixing.fit(rows, ["a", "b", "c"], targets, 4.0)
    local = rows.toPandas()
    rate = mixing._rates(p, gradients, 4.0)
    reached = (p * (local.n_tokens.to_numpy() * rate)[:, None]).sum(0) / local.n_tokens.sum()
    assert np.abs(reached - targets).max() < 1e-3


def test_sharding(docs, no_docs):
    got = sharding.assign(docs, 4).collect()
    by_id = {r[0]: r[1] or "" for r in corpus()}
    assert len(got) == len(corpus())
    for r in got:
        text = by_id[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(text) + 8, zlib.crc32(text), "bytes")
    for k in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
    assert sharding.assign(no_docs, 4).count() == 0


def test_shards_are_even_and_split_only_large_groups(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng, rng.randint(5, 60)))) for i in range(3000)] + [(5000 + i, "the same text " * 12) for i in range(1500)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.05 * sizes.mean() and sizes.min() > 0.95 * sizes.mean()


def test_written_shards_hold_all_rows(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(corpus()) and set(docs.columns) < set(back.columns)


def test_token_counts(docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    by_id = {r[0]: r[1] or "" for r in corpus()}
    got = token_counts.count_tokens(docs, path).collect()
    assert len(got) == len(corpus())
    for r in got:
        n = len(library.encode(by_id[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(by_id[r.doc_id].encode()), n, n > 2048)
    assert token_counts.count_tokens(no_docs, path).count() == 0
    rng, one = random.Random(1), token_counts.counter(path)
    pool = [chr(i) for i in range(0x250)] + list("'sStTdDlLaeiou01 \n") * 8 + ["<|endoftext|>", "<|startoftext", "it's", "́", "Å", "漢", "😀", "İ", "²", "­"]
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert one.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "z" * 3_000_000), (2, None, "<p>é</p>"), (None, "u", "<p>é</p>"), (6, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    found = warc.archive(pages).collect()
    got = {r.page_id: r for r in found}
    assert len(found) == len(rows)
    payload = {i: (h or "").encode() for i, _, h in rows}
    for i, r in got.items():
        assert (r.payload_bytes, r.payload_digest) == (len(payload[i]), base64.b32encode(hashlib.sha1(payload[i]).digest()).decode())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), 6: ("response", None), None: ("revisit", 2),
    }
    folder = f"file://{tmp_path}"
    index = warc.write(pages, folder)
    one = warc.lookup(index, folder, spark.createDataFrame([(5,)], "page_id long")).collect()
    assert len(one) == 1 and bytes(one[0].payload) == b"z" * 3_000_000
    assert warc.archive(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.archive(pages.filter("page_id < 3")).collect()} == {"response", "revisit"}


def test_bundles_are_plain_zstandard_with_a_seek_table(tmp_path):
    import zstandard

    bundle = warc.Bundle(str(tmp_path))
    records = [warc.record(str(i), None, bytes([65 + i]) * 700_000, "D", None) for i in range(5)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    data = (tmp_path / bundle.name).read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(records)
    reader = warc.Reader(str(tmp_path), bundle.name)
    for (frame, place), record in zip(places, records):
        assert reader.frame(frame)[place : place + len(record)] == record


URLS = [
    ("http://www.EXAMPLE.com/en/1", "www.example.com/en/", "allow"),
    ("https://a.b.example.com/en/", "example.com/en/", "block"),
    ("https://example.com/english", "com/", "allow"),
    ("https://example.com", None, "allow"),
    ("https://example.com?x=/en/", None, "allow"),
    ("https://notexample.com/en/", "com/", "allow"),
    ("ftp://x.net/es/a?b#c", "net/es/", "block"),
    ("x.net/es/", None, "allow"),
    ("https://net/fr/", "net/fr/", "block"),
    ("https://com:80/en/", None, "allow"),
    (None, None, "allow"),
    ("", None, "allow"),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, (u, _, _) in enumerate(URLS)] + [(1, URLS[1][0], 2)], "page_id long, url string, host int")
    got = url_filter.judge(pages, url_filter.rule_table(spark)).collect()
    assert len(got) == len(URLS) + 1
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {i: (rule, v) for i, (_, rule, v) in enumerate(URLS)}
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    assert url_filter.judge(pages, url_filter.rule_table(spark).limit(0)).filter("verdict <> 'allow'").count() == 0


def test_quality_classifier(spark, docs, no_docs, labels):
    got = quality_classifier.score(docs, labels).collect()
    assert len(got) == len(corpus())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert quality_classifier.score(no_docs, labels).count() == 0
    assert {r.score for r in quality_classifier.score(docs, labels.limit(0)).collect()} == {0.5}


def test_neighbours_match_brute_force(spark):
    rng = random.Random(9)
    good, bad = words(rng, 60), words(rng, 60)
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    space = quality_classifier.fit(docs, labels)
    texts = [t.encode() for _, t in rows[:50]]
    cosines = space.project(texts) @ space.vectors.T
    for row, score in zip(cosines, space.scores(texts)):
        near = np.sort(row)[-quality_classifier.NEIGHBOURS :]
        assert near.sum() == 0 or 0 <= score <= 1
    found = {r.doc_id: r.predicted for r in quality_classifier.score(docs, labels).filter("held_out").collect()}
    assert np.mean([p == i % 2 for i, p in found.items()]) > 0.95


def test_compact_windows_are_the_minima_of_all_long_subsequences():
    rng = np.random.default_rng(5)
    for values in (rng.integers(0, 1000, 90), rng.integers(0, 3, 60), np.zeros(40, int), np.arange(50)):
        found = substring_dedup.compact_windows(values.astype(np.uint64), 7)
        for i in range(len(values)):
            for j in range(i + 6, len(values)):
                owners = [c for low, c, high in found if low <= i <= c <= j <= high]
                assert len(owners) == 1 and values[owners[0]] == values[i : j + 1].min()


def test_substring_dedup(docs, no_docs):
    got = substring_dedup.dedup_report(docs).collect()
    texts = {r[0]: (r[1] or "").encode().lower().split() for r in corpus()}
    holders: dict = {}
    for i, w in texts.items():
        for k in range(len(w) - 49):
            holders.setdefault(tuple(w[k : k + 50]), set()).add(i)
    must = set().union(*(v for v in holders.values() if len(v) > 1))
    found = {r.doc_id for r in got}
    assert must <= found and len(must) > 10
    assert found <= must | set(range(8, 20)) | {1000, None}  # near copies besides exact repeats
    covered = {(r.doc_id, k) for r in got for k in range(r.start_word, r.start_word + r.n_words)}
    for i, w in texts.items():
        for k in range(len(w) - 49):
            others = holders[tuple(w[k : k + 50])] - {i}
            if others and i not in (None,):
                assert all((i, x) in covered for x in range(k, k + 50))
    assert all(r.partner_id is not None for r in got if r.doc_id is not None)
    assert substring_dedup.dedup_report(no_docs).count() == 0


def linked(spark, texts: list[list[str]], keys: list[tuple[int, int, int]]) -> list[tuple]:
    """The passages (a, b, pa, pb) of texts 1, 2, ... that share the given keys (h, th, c)."""
    docs = spark.createDataFrame([(k + 1, " ".join(t)) for k, t in enumerate(texts)], "th long, text string")
    found = substring_dedup._linked(spark.createDataFrame(keys, "h long, th long, c int"), docs)
    return [tuple(r) for r in found.filter("n IS NOT NULL").select("a", "b", "pa", "pb").collect()]


def named(name: str, n: int) -> list[str]:
    return [f"{name}{k}" for k in range(n)]


def test_substring_dedup_keeps_matched_texts_as_partners(spark):
    """Drifting versions: 1 is near 2 and 2 is near 3, but 1 is not near 3."""
    base = named("w", 100)
    edited = [[f"{k}{w}" if i in places else w for i, w in enumerate(base)] for k, places in enumerate(((20, 60), (), (40, 80)))]
    got = linked(spark, edited, [(7, 1, 10), (7, 2, 10), (7, 3, 10)])
    assert {p[:2] for p in got} == {(1, 2), (2, 3)}


def test_substring_dedup_checks_every_place_of_a_diagonal(spark):
    """A chance hit lies before a passage with an inserted word on the same diagonal."""
    passage = named("p", 60)
    texts = [named("a", 100) + passage + named("b", 50), named("c", 100) + passage[:25] + ["new"] + passage[25:] + named("d", 50)]
    got = linked(spark, texts, [(8, 1, 5), (8, 2, 5), (7, 1, 110), (7, 2, 110)])
    assert got and all(p[2] >= 90 for p in got)


def test_substring_dedup_is_done_with_a_key_only_at_its_place(spark):
    """2 shares one passage with 1 and only collides with it on key 7, where 2 and 3 share another passage."""
    one, other = named("p", 60), named("q", 60)
    texts = [one + named("a", 100), one + named("b", 100) + other, other + named("c", 100)]
    got = linked(spark, texts, [(7, 1, 110), (7, 2, 190), (7, 3, 30), (8, 1, 20), (8, 2, 20)])
    assert {p[:2] for p in got} == {(1, 2), (2, 3)}


def test_substring_dedup_finds_a_second_passage_of_a_pair(spark):
    """2 and 3 share two passages; the first text of the second one's key is a stranger."""
    one, other = named("p", 60), named("q", 60)
    texts = [named("s", 100), one + named("b", 100) + other, one + named("c", 70) + other]
    got = linked(spark, texts, [(8, 2, 20), (8, 3, 20), (7, 1, 30), (7, 2, 190), (7, 3, 160)])
    assert {p[:2] for p in got} == {(2, 3)} and sorted(p[2] - p[3] for p in got) == [0, 30]


def test_substring_dedup_names_the_component_of_linked_texts(spark):
    shared = named("w", 120)
    rows = [(5, shared), (3, shared[:70] + named("a", 20)), (9, named("b", 20) + shared[60:]), (20, named("c", 60)), (21, named("c", 60))]
    got = substring_dedup.dedup_report(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3), (9, 3), (20, 20), (21, 20)}


def test_substring_dedup_finds_edited_copies_of_a_frequent_passage(spark):
    """Copies with an edit every 40 words: windows of 50 words have a similarity of 0.80 to the original."""
    rng = random.Random(71)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(base))]
    for k in range(1, 12):
        text = list(base)
        for place in range(3 * k, len(text), 40):
            text[place] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    got = substring_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(12))


def test_url_filter_keeps_all_labels_of_a_host(spark):
    host = "a." * 100_001 + "example"
    rows = spark.createDataFrame([(host, 1), (host, 2)], "host string, i int").select("i", F.expr(url_filter.SUFFIX)).collect()
    assert dict(map(tuple, rows)) == {1: host, 2: host[2:]}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, 5000 + k) for k in range(50)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top: dict = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in list(top)}


def test_hot_keys_are_salted_and_nothing_is_lost(docs, monkeypatch):
    before = {(r.doc_id, r.component_id) for r in jaccard_join.join(docs).collect()}
    monkeypatch.setattr(jaccard_join, "SALT_ROWS", 1)
    assert {(r.doc_id, r.component_id) for r in jaccard_join.join(docs).collect()} == before


def test_without(docs):
    keyed = docs.withColumn("rid", common.row_key(docs.drop("rid")))
    assert common.without(docs, keyed.filter("doc_id < 5").select("rid")).filter("doc_id < 5").count() == 0
    assert common.without(docs, keyed.filter("doc_id < 5").select("rid")).count() == docs.filter("doc_id >= 5 OR doc_id IS NULL").count()
    assert docs.select(F.lit(1)).count() == len(corpus())


def test_jaccard_join_of_long_texts(spark):
    """Sets beyond the bitmaps: copies on both sides of the boundary, and strangers that share a rare passage."""
    rng = random.Random(31)
    passage = " ".join(f"rare{k}" for k in range(40))
    rows = []
    for group in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(900 + 1500 * group)]
        for n, changes in enumerate((0, len(base) // 50, len(base) // 38, len(base) // 30, len(base) // 20)):
            text = list(base)
            for place in rng.sample(range(len(text)), changes):
                text[place] = f"new{rng.randrange(10**6)}"
            rows.append((100 * group + n, passage + " " + " ".join(text)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    least[a] = min(least[a], least[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (len(sets[i]), least[i]) for i in sets}
    assert len(set(least.values())) > 4
