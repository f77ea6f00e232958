"""Ties and dealing in the classifier, long items, reading tasks of archives, hot groups of the rules, word counts of passages."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lockgate.llm import common, decontaminate, jaccard_join, mixing, quality_classifier, quality_rules, sharding, substring_dedup, warc

DOCS = "doc_id bigint, text string, lang string, source string"


def plain_votes(cosines, labels, k, usual):
    """Sorted by similarity, then by the place of the labelled row."""
    found = []
    for row in cosines:
        near = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        weight = [max(row[i], 0.0) for i in near]
        found.append(sum(w * labels[i] for w, i in zip(weight, near)) / sum(weight) if sum(weight) > 0 else usual)
    return found


def space(vectors, labels):
    words = {f"w{i}".encode(): i for i in range(vectors.shape[1])}
    return quality_classifier.Space(words, np.eye(vectors.shape[1], dtype=np.float32), vectors.astype(np.float32), np.array(labels, float), 0.5)


def test_neighbours_match_brute_force_with_ties(monkeypatch):
    rng = np.random.default_rng(1)
    for trial in range(30):
        vectors = rng.integers(-2, 3, (rng.integers(1, 120), 4)).astype(float)  # few directions, so many ties
        vectors = quality_classifier._unit(vectors)
        labels = rng.integers(0, 2, len(vectors))
        made = space(vectors, labels)
        queries = quality_classifier._unit(rng.integers(-2, 3, (40, 4)).astype(np.float32))
        monkeypatch.setattr(quality_classifier.Space, "project", lambda self, texts: queries[[int(t) for t in texts]])
        got = made.scores([str(i).encode() for i in range(40)])
        cosines = np.round(queries.astype(float) @ made.vectors.T.astype(float), 9)
        want = plain_votes(cosines.tolist(), labels.tolist(), min(quality_classifier.NEIGHBOURS, len(vectors)), 0.5)
        assert np.allclose(got, want, atol=1e-12), trial


def test_equal_neighbours_go_to_the_earlier_row():
    vectors = np.tile([[1.0, 0.0]], (2000, 1))
    assert space(vectors, [1] * 25 + [0] * 1975).scores([b"w0"])[0] == 1.0
    assert space(vectors, [0] * 25 + [1] * 1975).scores([b"w0"])[0] == 0.0


def test_scores_do_not_depend_on_the_dealing(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    one = {tuple(r) for r in quality_classifier.score(docs.coalesce(1), labels).collect()}
    assert one == {tuple(r) for r in quality_classifier.score(docs.repartition(9), labels).collect()}


def test_a_very_long_item_takes_seconds(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(100_000)]
    docs = spark.createDataFrame([(1, " ".join(words[500:560]), "en", "s"), (2, " ".join(words[50_000:50_009]), "en", "s"), (3, "x " * 50_000, "en", "s")], DOCS)
    items = spark.createDataFrame([("long", " ".join(words)), ("loop", "x " * 40)], "item_id string, text string")
    start = time.monotonic()
    found = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.decontaminate(docs, items).collect()}
    assert found == {1: (60, 1), 2: (0, 0), 3: (50_000, 1)}
    assert time.monotonic() - start < 90


def test_windows_of_items_match_a_plain_search(spark):
    rng = random.Random(6)
    letters = "abc"
    texts = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, ""]
    items = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(25)] + [None]
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS).withColumns({c: F.lit(1) for c in ("th", "item", "place", "words")})
    tests = spark.createDataFrame([(f"i{i}", t) for i, t in enumerate(items)], "item_id string, text string").withColumns({c: F.lit(1) for c in ("start", "width")})
    got = {r.doc_id: (r.n_words, r.n_hit, set(r.item_ids)) for r in decontaminate.decontaminate(rows, tests).collect()}
    for i, text in enumerate(texts):
        words, hit, ids = (text or "").split(), set(), set()
        for k, item in enumerate(items):
            want = (item or "").split()
            size = min(10, len(want))
            windows = {tuple(want[s : s + size]) for s in range(len(want) - size + 1)} if size else set()
            for at in range(len(words) - size + 1):
                if tuple(words[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    ids.add(f"i{k}")
        assert got[i] == (len(words), len(hit), ids), i


def test_archives_are_read_by_many_tasks(spark, monkeypatch):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "concat(id, repeat('x', 20000)) AS html").repartition(4)
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 20)
    monkeypatch.setattr(warc, "FRAME", 1 << 18, raising=False)
    clashing = pages.withColumns({c: F.lit("c") for c in ("digest", "kept", "refers_to", "bundle", "length")})
    found = warc.archive(clashing)
    assert found.count() == 400 and found.filter("payload_bytes >= 20001").count() == 400
    folder = common.scratch.new_folder(spark, "warc")
    assert warc.read(warc.write(pages, folder), folder).rdd.getNumPartitions() >= 8


def test_rules_do_not_depend_on_parts_of_a_group(spark, monkeypatch):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents").withColumn("source", F.lit("hot"))
    kept = {(r.doc_id, r.kept) for r in quality_rules.judge(docs).collect()}
    monkeypatch.setattr(quality_rules, "SALTS", 1)
    assert kept == {(r.doc_id, r.kept) for r in quality_rules.judge(docs.repartition(5)).collect()}


def test_passages_count_words_alike_around_line_breaks(spark):
    text = " ".join(f"w{i}" for i in range(49))
    short = spark.createDataFrame([(1, f"\n{text}\n", "en", "s"), (2, f"\n{text}\n", "en", "s")], DOCS)
    assert substring_dedup.dedup_report(short).count() == 0
    full = spark.createDataFrame([(i, f"\t{text} end\n", "en", "s") for i in (1, 2)], DOCS)
    assert {(r.doc_id, r.n_words) for r in substring_dedup.dedup_report(full).collect()} == {(1, 50), (2, 50)}


def test_order_of_shingles_matches_plain_counts(spark):
    rng = np.random.default_rng(2)
    tables = rng.integers(0, 9, (3, jaccard_join.COUNTERS)).astype(np.uint32)
    tables[:, 5] = 200
    rows = [(c, t.reshape(-1, common.CHUNK)[c].astype(np.uint8).tobytes()) for t in tables for c in range(jaccard_join.COUNTERS // common.CHUNK)]
    rank, salts, mean = jaccard_join.order(spark.createDataFrame([(c, bytearray(b)) for c, b in rows], "chunk int, counts binary"))
    counts = tables.sum(0).astype(np.int64)
    usual = max(1.0, float(np.median(counts)))
    excess = np.maximum(0, counts - 2 * int(usual))
    assert np.array_equal(rank, np.floor(4 * np.log2(np.maximum(counts / usual, 1))).astype(np.uint8))
    assert np.array_equal(salts, 1 + excess // jaccard_join.SALT_ROWS)
    assert mean == pytest.approx(max(1.0, float((excess.astype(float) ** 2).sum() / counts.sum()) ** 0.5))


@pytest.mark.parametrize("shares", [(0.98, 0.02), (0.5, 0.5), (0.2, 0.8)])
def test_rates_match_a_dense_solver(spark, shares):
    """The distributed descent ends where a dense bounded least-squares solver of the same totals ends."""
    rng = np.random.default_rng(7)
    p = rng.dirichlet((0.4, 0.4), 400)
    n = rng.integers(1, 300, 400).astype(float)
    rows = spark.createDataFrame([(int(a), float(x), float(y)) for a, (x, y) in zip(n, p)], "n_tokens long, p_a double, p_b double").repartition(5)
    natural = n @ p / n.sum()
    share = np.array(shares)
    top = int(np.argmax(share))
    wanted = share / share[top] * natural[top]
    got = mixing._rates(p, mixing.fit(rows, ["a", "b"], wanted, 1.0, rounds=200), 1.0)
    a = (p * n[:, None]).T / n.sum()
    inverse = np.linalg.inv((p * n[:, None]).T @ p / n.sum() + mixing.RIDGE * np.eye(2))

    def size(rate):
        error = a @ rate - wanted
        return float(np.sqrt(error @ inverse @ error))

    dense = np.ones(400)
    for _ in range(20_000):
        dense = np.clip(dense - 0.5 * p @ (inverse @ (a @ dense - wanted)), 0, 1)
    assert size(got) <= size(dense) + 1e-2
    assert ((got >= 0) & (got <= 1)).all()


def test_reached_shares_are_reported(spark):
    rows = [(10, 1.0, 0.0, 1.0, 1), (30, 0.5, 0.5, 0.5, 0)]
    rated = spark.createDataFrame(rows, "n_tokens long, p_a double, p_b double, rate double, n_copies int")
    found = {r.domain: (r.target, round(r.expected_share, 6), r.drawn_share) for r in mixing.reached(rated, ["a", "b"], {"a": 0.7, "b": 0.3}).collect()}
    assert found == {"a": (0.7, 0.7, 1.0), "b": (0.3, 0.3, 0.0)}
    assert {r.expected_share for r in mixing.reached(rated.limit(0), ["a"], {"a": 1.0}).collect()} == {None}


def test_shards_match_an_exhaustive_split(spark):
    """Every record in one shard, in key order, gapless, and no shard further from the mean than its largest range."""
    rng = random.Random(9)
    texts = ["same " * 40] * 300 + ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 400))) for _ in range(700)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS).repartition(4)
    rows = sharding.assign(docs, 6).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    total, by = 0, {}
    for r in rows:
        size = len((texts[r.doc_id] or "").encode()) + 8
        assert r.size == size
        total += size
        by.setdefault(r.shard, []).append((r.slot, size))
    for held in by.values():
        assert sorted(s for s, _ in held) == list(range(len(held)))
        assert abs(sum(b for _, b in held) - total / 6) <= 0.25 * total / 6
    assert set(by) == set(range(6))


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c", None, "s", 5), (3, "word " * 30_000, "en", None, None)]
    odd += [(4 + i, "the same text of some words " * 12, "en", "s", 1) for i in range(3)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    clash = {c: F.lit(1) for c in ("rid", "th", "kept", "bucket", "shard", "label", "size")}
    for rows in (odd, []):
        frame = spark.createDataFrame(rows, schema).withColumns(clash)
        for name, stage in corpus_pipeline.STAGES:
            left = common.stored(stage(spark, frame, sf), "odd")
            assert left.count() <= len(rows), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert left.columns == frame.columns, name


def test_windows_around_a_place_match_brute_force():
    """All starts that hold both places, by sets; texts without and with repeated tokens, inserted and deleted ones."""
    rng, size = np.random.default_rng(11), substring_dedup.TOKENS
    hits = 0
    for trial in range(120):
        x = rng.integers(0, 2**31 if trial % 2 else 60, rng.integers(size - 5, 150)).astype(np.uint32)
        y = x.copy()
        for _ in range(rng.integers(0, 16)):
            at = rng.integers(0, len(y))
            y = [np.delete(y, at), np.insert(y, at, 2**31 + trial), np.append(y[at:], y[:at])][rng.integers(0, 10) // 4]
        y = y.astype(np.uint32)
        px, py = int(rng.integers(0, len(x))), int(rng.integers(0, len(y)))
        if trial % 3:
            py = min(px, len(y) - 1)
        want = {}
        for i in range(px - size + 1, px + 1):
            j = i - px + py
            if 0 <= i <= len(x) - size and 0 <= j <= len(y) - size:
                one, other = set(x[i : i + size].tolist()), set(y[j : j + size].tolist())
                if len(one & other) >= substring_dedup.SIMILAR * len(one | other):
                    want[i] = len(one & other) / len(one | other)
        got = substring_dedup.around(x, y, px, py)
        assert {i for a, n, _ in got for i in range(a, a + n - size + 1)} == set(want)
        assert all(best == max(want[i] for i in range(a, a + n - size + 1)) for a, n, best in got)
        hits += bool(want)
    assert hits > 20


def test_windows_without_ties_are_the_same(spark):
    values = np.random.default_rng(4).permutation(500).astype(np.uint64)
    assert substring_dedup.compact_windows(values, ties=False) == substring_dedup.compact_windows(values)


def test_edited_copies_of_short_passages_are_found(spark):
    """300 passages of 50 to 62 words, each in two texts, one with an edit or two: at least 0.9 of the pairs are found."""
    rng, rows, want = np.random.default_rng(8), [], set()
    for k in range(300):
        words = [f"p{k}x{i}" for i in range(rng.integers(50, 63))]
        edited = list(words)
        for at in rng.choice(len(words), rng.integers(1, 3), replace=False):
            edited[at] = "new"
        near = [len({tuple(t[a + i : a + i + 5]) for i in range(substring_dedup.TOKENS)} & {tuple(u[a + i : a + i + 5]) for i in range(substring_dedup.TOKENS)}) for t, u in [(words, edited)] for a in range(len(words) - 49)]
        for side, text in enumerate((words, edited)):
            rows.append((2 * k + side, " ".join([f"a{k}s{side}n{i}" for i in range(30)] + text + [f"b{k}s{side}n{i}" for i in range(30)])))
        if max(near) >= substring_dedup.AGREE:
            want.add(2 * k)
    got = substring_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id for r in got if r.component_id == r.doc_id}
    assert len(want) > 100 and len(found & want) >= 0.9 * len(want) and all(r.component_id // 2 == r.doc_id // 2 for r in got)


def test_ranges_of_many_texts_match_their_trees():
    rng, size = np.random.default_rng(21), substring_dedup.TOKENS
    tokens = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (size, size + 1, 300, size, 2000)]
    for f in range(substring_dedup.HASHES):
        got = set(zip(*(x.tolist() for x in substring_dedup._ranges(tokens, f))))
        want = set()
        for k, text in enumerate(tokens):
            values = common.mix(text ^ substring_dedup.SEEDS[f])
            for low, c, high in substring_dedup.compact_windows(values):
                want.add((k, max(low, c - size + 1), min(c, high - size + 1), c, int(values[c])))
        assert got == want


def test_similar_windows_share_a_rare_token():
    """Whatever the order of tokens: places that a passage covers have one of their rarest tokens in common."""
    rng, size, hits = np.random.default_rng(12), substring_dedup.TOKENS, 0
    for trial in range(300):
        x = rng.integers(0, 2**31 if trial % 2 else 90, rng.integers(size, 150)).astype(np.uint32)
        y = x.copy()
        for _ in range(rng.integers(0, 12)):
            at = rng.integers(0, len(y))
            y = [np.delete(y, at), np.insert(y, at, 2**31 + trial), np.append(y[at:], y[:at])][rng.integers(0, 10) // 4]
        y = y.astype(np.uint32)
        px = int(rng.integers(0, len(x)))
        py = min(max(0, px + int(rng.integers(-1, 2))), len(y) - 1)
        if not substring_dedup.passages(x, y, [(px, py)])[1]:
            continue
        hits += 1
        rare = rng.integers(0, 3, 1 << 10).astype(np.uint8)
        (a, more_a, mixed_a), (b, more_b, mixed_b) = (substring_dedup.rarest(substring_dedup._rank(t, rare), p) for t, p in ((x, px), (y, py)))
        assert set(a) & set(b) if not mixed_a and not mixed_b else set(a + more_a) & set(b + more_b)
    assert hits > 60


def test_holders_of_a_short_line_are_not_all_compared(spark, monkeypatch):
    """A line shorter than a passage in 30 texts; two of them are near copies and are found."""
    line = [f"line{i}" for i in range(38)]
    texts = [[f"a{k}x{i}" for i in range(60)] + line + [f"b{k}x{i}" for i in range(60)] for k in range(30)]
    texts[29] = [*texts[28][:30], "new", *texts[28][31:]]
    compared, checked = [], substring_dedup._checked
    monkeypatch.setattr(substring_dedup, "_checked", lambda met, tokens: (compared.append(met.select("a", "b").distinct().count()), checked(met, tokens))[1])
    docs = spark.createDataFrame([(k + 1, " ".join(t)) for k, t in enumerate(texts)], "th long, text string")
    keys = spark.createDataFrame([(7, k + 1, 75) for k in range(30)], "h long, th long, c int")
    found = substring_dedup._linked(keys, docs).filter("n IS NOT NULL").select("a", "b").distinct().collect()
    assert [tuple(r) for r in found] == [(29, 30)]
    assert sum(compared) < 60  # all pairs are 435
