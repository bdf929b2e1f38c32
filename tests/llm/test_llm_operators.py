"""Operators against brute force on a given table, and on small odd inputs."""

import math
import os
import random
import sys
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from textoverlap.llm import decontam, langid, lm, mixing, quality, queries, sharding, simhash, substring, url_rules, warc  # noqa: E402
from textoverlap.llm.graph import components  # noqa: E402

SF = "/root/testdata/sf0.001"
# names that operators use inside or return
CLASHING = ["row", "size", "key", "shard", "slot", "fp", "component_id", "root", "votes", "kept", "quality", "id", "th", "taken", "copies",
            "n_words", "range", "tie", "coords", "item_id", "host", "path", "rule", "verdict", "payload", "digest", "first", "target"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def texts(df, key="doc_id", text="text"):
    return [(r[key], r[text]) for r in df.select(key, text).collect()]


def odd(spark, empty=False):
    """Nulls in every column, empty and long texts, ties, repeated rows, names that clash."""
    rnd = random.Random(5)
    say = lambda n: " ".join(rnd.choice(["the", "of", "lorem", "ipsum", "Und", "el", "x1", "día"]) for _ in range(n))
    copy, long = say(60), say(30_000)
    rows = [(1, copy, "en", "a"), (1, copy, "en", "a"), (2, copy, "en", None), (3, None, None, None), (None, copy, "de", "b"), (None, say(80), None, "b"),
            (None, None, None, None), (4, "", "en", "a"), (5, " \n\t", "en", ""), (6, long, "es", "a"), (7, long + " end", "es", "b"), (8, "one", "en", "a"),
            (9, "x" * 5000, "en", "a"), (10, "123 456 !!", "en", "a"), (11, copy, "en", "a"), (12, "the\n" * 100, "en", "a"), (13, "漢字 " * 70, "zh", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([] if empty else [(*r, len(r[1] or "")) for r in rows], schema)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)


def test_substring_dedup(spark, docs):
    got = sorted(tuple(r) for r in substring.remove_repeats(docs.repartition(3), texts=False).drop("kept_text").collect())
    assert got == brute.removed(texts(docs))


def test_substring_dedup_of_dense_repeats(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.choice([0, 5, 19, 20, 40, 60])))) for i in range(60)]
    base = [rnd.choice("abcdef") for _ in range(200)]
    for i in range(60):
        a = rnd.randrange(100)
        rows.append((100 + i, " ".join(base[a:a + rnd.randrange(10, 90)])))
    rows += [(200 + i, " ".join(["x"] * rnd.randrange(15, 60))) for i in range(10)] + [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = substring.remove_repeats(df).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute.removed(rows)
    assert all(len(r.kept_text.split()) == r.n_words - r.n_removed for r in out)


def test_substring_dedup_deals_out_hot_anchors(spark, monkeypatch):
    """A passage and its near copies in most documents, with blocks of a few rows: the same words go."""
    monkeypatch.setattr(substring, "HOT_ROWS", 3)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        x = base[rnd.randrange(5):55 + rnd.randrange(5)]
        x[rnd.randrange(len(x))] = rnd.choice(["w1", "new"])
        rows.append((i // 2 if i > 70 else i, " ".join([f"n{rnd.randrange(9)}"] * rnd.randrange(4) + x)))
    rows = list(dict(rows).items())
    got = sorted(tuple(r) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), texts=False).drop("kept_text").collect())
    assert got == brute.removed(rows)


@pytest.mark.parametrize("shift", [4, 6])
def test_anchors_of_long_and_short_texts_agree(monkeypatch, shift):
    """Texts of more than 2 ** _SHIFT words rank their places in another way: the windows' anchors stay the same."""
    r = np.random.default_rng(shift)
    hashes = r.integers(0, 1 << 63, 300).astype(np.uint64) << np.uint64(1)
    hashes[100:140] = hashes[20:60]
    woff = np.array([0, 90, 90, 300])
    want = substring._anchors(hashes, woff, 20, 5)
    monkeypatch.setattr(substring, "_SHIFT", shift)
    got = substring._anchors(hashes, woff, 20, 5)
    assert all((a == b).all() for a, b in zip(got, want))


def test_simhash(spark, docs):
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    fps = {d: brute.fingerprint(t) for d, t in texts(docs)}
    assert {k: v[0] for k, v in got.items()} == fps
    want = brute.components(fps)
    assert {k: v[1] for k, v in got.items()} == want
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(set(want.values()))


@pytest.mark.parametrize("bucket_rows", [2, 64])
def test_links_in_full_buckets(spark, bucket_rows):
    """Hundreds of fingerprints a few bits apart, joined in pairs or through neighbours."""
    rnd = random.Random(2)
    fps = {sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 4))) ^ c for _ in range(300) for c in (0, 0xFFFF0000FFFF)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 2, bucket_rows)
    root = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(edges).collect()}
    groups = {}
    for f, c in brute.components({f: f for f in fps}).items():
        groups.setdefault(c, set()).add(f)
    for members in groups.values():
        assert len({root.get(m, m) for m in members}) == 1
    assert len({root.get(f, f) for f in fps}) == len(groups)


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): (r.window_start, r.similarity, r.n_windows)
           for r in decontam.matches(docs, bench, [F.col("doc_id")], "doc_id long").collect()}
    assert got == brute.leaks(texts(docs), texts(bench, "item_id"))
    assert got
    kept = {r.doc_id for r in decontam.decontaminate(docs, bench).collect()}
    assert kept == {d for d, _ in texts(docs)} - {d for d, _ in got}


@pytest.mark.parametrize("part_bytes", [1 << 20, 1000])
def test_decontamination_of_edited_items(spark, part_bytes):
    rnd = random.Random(3)
    items = [(i, " ".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.choice([2, 4, 5, 8, 30, 50])))) for i in range(30)] + [(40, None), (41, "")]
    docs = [(500, None), (501, "  ")]
    for i in range(120):
        x = (rnd.choice(items)[1] or "").split()
        for _ in range(rnd.randrange(3) if x else 0):
            x[rnd.randrange(len(x))] = "Z"
        noise = lambda: [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(9))]
        docs.append((i, " ".join(noise() + x[rnd.randrange(3):] + noise())))
    got = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                           [F.col("doc_id")], "doc_id long", part_bytes=part_bytes)
    assert {(r.doc_id, r.item_id): (r.window_start, r.similarity, r.n_windows) for r in got.collect()} == brute.leaks(docs, items)


def test_language_model(spark):
    got = {r.doc_id: r for r in queries.op4_lm_scores(spark, SF).collect()}
    rows = [(d, brute.split(t, lower=True) + [None]) for d, t in texts(spark.read.parquet(f"{SF}/documents.parquet"))]
    model = brute.KneserNey([[x or b"\0end" for x in w] for d, w in rows if brute.crc(d) % 7 != 2])
    for d, w in rows:
        w = [x or b"\0end" for x in w]
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in model.uni for x in w), sum(model.uni.values()))
        assert r.held_out == (brute.crc(d) % 7 == 2)
        assert r.score == pytest.approx(model.score(w), rel=1e-9) and r.base_score == pytest.approx(model.base(w), rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b" a", b" ", b"ba"]
    p = np.random.default_rng(0).random((len(pieces), 2))

    def all_ways(w, k):
        return 1.0 if not w else sum(p[j, k] * all_ways(w[len(x):], k) for j, x in enumerate(pieces) if w.startswith(x))

    words = [b"ab", b"abab", b"b", b"aabbab" * 2]
    end = np.cumsum([len(w) for w in words])
    head = np.array([1, 0, 1, 1])
    block = langid.Words(np.frombuffer(b"".join(words), dtype=np.uint8), end - [len(w) for w in words], end, head, langid.Pieces(pieces))
    want = [[np.log(all_ways(b" " * h + w, k)) for k in (0, 1)] for w, h in zip(words, head.tolist())]
    assert np.allclose(block.forward(p), want)


def test_language_model_with_hot_words_and_lost_files(spark, monkeypatch):
    """Frequent first words are dealt out by both words: the same scores. A file that has gone and too many words are errors."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["the"] * 6 + ["a", "b", "cat", "dog", f"w{i}"]) for _ in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = [F.col("doc_id")]
    results = []
    for share in (2, 10_000):
        monkeypatch.setattr(lm, "HOT_SHARE", share)
        model = lm.fit(df, piece_bytes=200)
        hot = len(model.pairs.hot)
        results.append((hot, {r.doc_id: r.score for r in lm.score(df, model, key, "doc_id long").collect()}))
    assert results[0][0] < results[1][0] and results[0][1] == pytest.approx(results[1][1], rel=1e-12)
    kept = brute.KneserNey([brute.split(t, lower=True) + [b"\0end"] for _, t in rows])
    for d, t in rows:
        assert results[0][1][d] == pytest.approx(kept.score(brute.split(t, lower=True) + [b"\0end"]), rel=1e-9)
    for name in ("p", "u", "w"):
        lost = next(f for f in sorted(os.listdir(model.folder)) if f.startswith(name))
        os.rename(f"{model.folder}/{lost}", f"{model.folder}/away")
        lm._mapped.cache_clear()
        with pytest.raises(FileNotFoundError):
            for _, t in rows:
                h = [x for *_, x, off in lm._tokens(iter([pa.RecordBatch.from_arrays([pa.array([t])], names=["t"])]))][0]
                model.log10(h, np.array([0, len(h)]))
        os.rename(f"{model.folder}/away", f"{model.folder}/{lost}")
    monkeypatch.setattr(lm, "MAX_WORDS", 5)
    with pytest.raises(ValueError):
        lm.fit(df)


def plain_forward(word, head, pieces, p):
    """Log probability of a word in one pass over its bytes, with exact fractions."""
    w = (b" " if head else b"") + word
    a = [Fraction(1)] + [Fraction(0)] * len(w)
    number = {x: i for i, x in enumerate(pieces)}
    for end in range(1, len(w) + 1):
        for x in {w[i:end] for i in range(max(0, end - max(map(len, pieces))), end)} & number.keys():
            a[end] += a[end - len(x)] * Fraction(float(p[number[x]]))
    return a, number, w


def log_of(x):
    return math.log(x.numerator) - math.log(x.denominator)


@pytest.fixture(scope="module")
def long_words():
    """Long runs: of one character, of two scripts, of noise; pieces that chain over many bytes; every byte is a piece."""
    rnd = random.Random(12)
    pieces = sorted({bytes([b]) for b in range(256)} | {"漢字".encode(), "漢".encode(), b" a", b" abc", b"ab", b"aaa", b"aaaa", b"x" * 20, b"cdcd", b"dc"})
    words = ["漢字" * 40, "ab" * 100, "a" * 200, "x" * 130, "漢a字b" * 30, "".join(rnd.choice("abcd漢") for _ in range(400)), "abc", "é"]
    return pieces, [w.encode() for w in words]


def test_parts_of_long_words_keep_every_segmentation(long_words):
    """A word of hundreds of bytes has the probability of all its segmentations, however it is cut into parts."""
    pieces, words = long_words
    table = langid.Pieces(pieces)
    p = np.random.default_rng(1).random((len(pieces), 1)) * 1e-4
    raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    lo, hi, head, many = langid._parts(raw, starts, ends, table)
    assert b" ".join(b"".join(raw[a:b].tobytes() for a, b in zip(lo[i - m:i], hi[i - m:i])) for i, m in zip(np.cumsum(many), many)) == raw.tobytes()
    assert many[0] > 1 and many[5] > 3 and head.sum() == len(words)
    score = np.zeros(len(lo))
    for at, block in langid._blocks(raw, lo, hi, head, table):
        score[at] = block.forward(p)[:, 0]
    got = np.add.reduceat(score, np.cumsum(many) - many)
    for w, g in zip(words, got.tolist()):
        assert g == pytest.approx(log_of(plain_forward(w, 1, pieces, p[:, 0])[0][-1]), rel=1e-9)


def test_expected_counts_of_long_words(long_words):
    """Expected counts against exact fractions, where plain doubles would underflow."""
    pieces, words = long_words
    p = np.random.default_rng(2).random(len(pieces)) * 1e-5
    ends = np.cumsum([len(w) for w in words])
    weight = np.arange(1.0, len(words) + 1)
    block = langid.Words(np.frombuffer(b"".join(words), dtype=np.uint8), ends - [len(w) for w in words], ends, np.ones(len(words), dtype=np.int64), langid.Pieces(pieces))
    want = np.zeros(len(pieces))
    for w, k in zip(words, weight):
        a, number, w = plain_forward(w, 1, pieces, p)
        longest = max(map(len, pieces))
        b = [Fraction(0)] * len(w) + [Fraction(1)]
        for i in range(len(w) - 1, -1, -1):
            for x in {w[i:j] for j in range(i + 1, min(len(w), i + longest) + 1)} & number.keys():
                b[i] += Fraction(float(p[number[x]])) * b[i + len(x)]
        for i in range(len(w)):
            for x in {w[i:j] for j in range(i + 1, min(len(w), i + longest) + 1)} & number.keys():
                want[number[x]] += k * float(a[i] * Fraction(float(p[number[x]])) * b[i + len(x)] / a[-1])
    assert np.allclose(block.expected(p, weight), want, rtol=1e-8)


def test_fit_round_and_prediction_against_plain_version(spark, tmp_path):
    """One round of the fit and the posterior, with a small vocabulary, by summing over all segmentations."""
    import base64
    pieces = sorted({bytes([b]) for b in range(256)} | {b"ab", b" a", b"ba", b" b"})
    path = tmp_path / "small.tiktoken"
    path.write_text("\n".join(f"{base64.b64encode(x).decode()} {i}" for i, x in enumerate(pieces) if len(x) > 1))
    rows = [("abba ab", "x"), ("ba ab ab", "x"), ("bb aab", "y"), ("b", "y"), (None, "y"), ("abab", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.fit(docs, vocabulary=str(path), rounds=1, fit_texts=None, smoothing=0.1)
    start = np.full(len(pieces), 1 / len(pieces))
    for k, lang in enumerate("xy"):
        want = np.full(len(pieces), 0.1)
        for text, own in rows:
            for w in (text or "").encode().split() if own == lang else []:
                block = langid.Words(np.frombuffer(w, dtype=np.uint8), np.array([0]), np.array([len(w)]), np.array([1]), langid.Pieces(pieces))
                want += block.expected(start, np.ones(1))
        assert np.allclose(model.p[:, k], want / want.sum())
    got = langid.predict(docs, model, [F.col("text")], "text string").collect()
    for r in got:
        if r.text:
            ll = [sum(log_of(plain_forward(w, 1, pieces, model.p[:, k])[0][-1]) for w in r.text.encode().split()) for k in (0, 1)]
            assert r.lang_pred == "xy"[int(ll[1] > ll[0])] and r.score == pytest.approx(1 / (1 + math.exp(min(ll) - max(ll))))


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_quality_statistics(spark, docs):
    rows = quality.quality(docs).collect()
    want = dict(texts(docs))
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.statistics(want[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in rows if r.kept}
    assert {r.doc_id for r in quality.keep_quality(docs).collect()} == kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(bool(a) == b for a, b in judged) >= 0.95 * len(judged)


def test_sharding(spark, docs):
    rows = sharding.shard(docs, 8).drop("row").collect()
    assert {r.doc_id: (r["size"], r.crc) for r in rows} == {d: (len((t or "").encode()) + 16, __import__("zlib").crc32((t or "").encode())) for d, t in texts(docs)}
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(8))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    size = [sum(r["size"] for r in part) for part in by.values()]
    assert max(size) - min(size) <= 3 * max(r["size"] for r in rows)
    again = sharding.shard(docs.repartition(5), 8).drop("row").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_shards_equal_a_plain_tree(spark, docs):
    """The same cuts as a K-d tree that sorts every node's rows in memory."""
    ready = sharding._prepared(docs, ("source", "lang")).select("doc_id", "size", "coords", "tie").collect()
    want = {}

    def cut(rows, shards, first):
        if shards == 1 or not rows:
            want.update({r.doc_id: first for r in rows})
            return
        dim = max(range(3), key=lambda i: (max(r.coords[i] for r in rows) - min(r.coords[i] for r in rows), -i))
        place = lambda r: (r.coords[dim] << sharding._TIE) + r.tie
        goal = sum(r["size"] for r in rows) * (shards // 2) / shards
        upto, at = 0, None
        for r in sorted(rows, key=place):
            if upto + r["size"] >= goal - 0.5:
                at = place(r) if abs(upto + r["size"] - goal) <= abs(upto - goal) else place(r) - 1
                break
            upto += r["size"]
        cut([r for r in rows if place(r) <= at], shards // 2, first)
        cut([r for r in rows if place(r) > at], shards - shards // 2, first + shards // 2)

    cut(ready, 7, 0)
    assert {r.doc_id: r.shard for r in sharding.shard(docs, 7, tolerance=0.0).collect()} == want


def test_mixing_of_null_and_repeated_ids_is_repeatable(spark):
    rows = [(None if i % 2 else 5, f"w{i} " * 3, "ab"[i % 3 == 0]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [sorted((r.row.text, r.copies) for r in mixing.mix(df.repartition(n)).collect()) for n in (1, 7)]
    assert taken[0] == taken[1] and {c for _, c in taken[0]} != {taken[0][0][1]}


def test_mixing_targets(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 5), (None, 100), ("e", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sources).collect()}
    size, weight = {"a": 10, "b": 1000, "c": 1000, "d": 5, "e": 0, None: 100}, {"a": 5, "b": 2, "c": 1, "d": 5, "e": 2, None: 1}
    free, left = set(size), float(sum(size.values()))
    want = {}
    while True:
        full = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * size[s]}
        if not full:
            break
        want |= {s: 3.0 * size[s] for s in full}
        free, left = free - full, left - sum(3 * size[s] for s in full)
    want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    assert got == pytest.approx(want)


def test_mixing(spark, docs):
    rows = mixing.mix(docs).select("row.source", "doc_id", "size", "source_size", "target", "copies", "taken").collect()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1
        assert all(r.taken == r["size"] * r.copies and r.copies <= 3 for r in own)
    again = mixing.mix(docs.repartition(6)).drop("row").collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    assert mixing.mixed_rows(docs).count() == sum(r.copies for r in rows)


def test_url_rules(spark):
    rnd = random.Random(4)
    hosts = ["net", "example.net", "a.example.net", "xnet", "b.org", "org", "c.example.com", "EXAMPLE.com", "", "a..net", "net.example"]
    paths = ["", "/", "/en/", "/en/x", "/de/", "/e", "/fr/a/b", "/fr"]
    urls = [(i, rnd.choice(["http", "https", ""]) + "://" + rnd.choice(hosts) + rnd.choice(paths) + rnd.choice(["", "?q=/en/", "#top"])) for i in range(300)]
    urls += [(900, None), (901, "no scheme"), (902, "")]
    rules = [*queries.URL_RULES, ("example.net", "/en/x", "block"), ("a.example.net", "/", "allow"), ("com", "", "block"), ("", "", "block")]
    pages = spark.createDataFrame(urls, "page_id long, url string").repartition(4)
    got = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    for r in got:
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (r.host == h or h and r.host.endswith("." + h) or not h and not r.host) and r.path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        assert (r.rule, r.verdict) == best[1:], r
    assert len(got) == len(urls)


def test_warc_segments(spark):
    rnd = random.Random(6)
    long = "".join(rnd.choice("abcdeñ<>\r\n") for _ in range(5000))
    rows = [(1, "http://a/", long), (2, "http://b/\r\n", long), (3, None, "short"), (4, "http://c/", "short"), (5, "http://d/", None), (6, "http://e/", ""),
            (2, "http://b/", long), (None, "http://f/", long), (7, "http://g/", "WARC/1.1\r\n\r\n" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.round_trip(pages, segment_bytes=300).collect()
    assert all(r.problem is None for r in out)
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in out))
    n = len(long.encode())
    assert got == sorted([(1, "response", 0, n), (2, "revisit", 1, n), (3, "response", 0, 5), (4, "response", 0, 5), (5, "response", 0, 0), (6, "response", 0, 0),
                          (2, "revisit", 1, n), (0, "revisit", 1, n), (7, "response", 0, 600)])


def test_warc_broken_records():
    assert warc.dechunked(warc.chunked(b"x" * 20_000)) == b"x" * 20_000 and warc.dechunked(warc.chunked(b"")) == b""
    parts = [{"number": i, "block": b} for i, b in enumerate((b"HTTP/1.1 200 OK\r\n", b"\r\nab", b"c"), 1)]
    assert warc._assembled(parts[::-1], 22) == b"abc"
    for wrong, total in ((parts[:2], 22), (parts[:2], None), ([parts[0], parts[2]], 18), (parts, 21)):
        with pytest.raises(ValueError):
            warc._assembled(wrong, total)


def test_warc_reads_on_after_broken_records(spark, tmp_path):
    """Plain, gzip and one stream a record; a record that is cut off, one without a length, noise, a wrong digest, a lost segment."""
    import gzip
    ok = lambda i, body, size=10_000: list(warc._records(i, "http://a/", body, __import__("hashlib").sha256(body).hexdigest(), None, size))
    end = b"\r\n\r\n"
    good, cut, long = ok(1, b"one")[0], ok(2, b"two")[0][:-3], ok(3, b"three" * 100, 200)
    unsized = good.replace(b"Content-Length", b"Content-Size").replace(b"Page-ID: 1", b"Page-ID: 4")
    wrong = ok(5, b"five")[0].replace(b"five", b"fivE")
    data = b"noise\n" + good + end + cut + end + unsized + end + wrong + end + b"".join(x + end for x in long) + ok(6, b"")[0] + end
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(ok(7, b"seven")[0] + end))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(gzip.compress(x + end) for x in ok(8, b"eight") + ok(9, b"nine" * 200, 300)[:-1]))
    (tmp_path / "d.warc.gz").write_bytes(b"\x1f\x8bbroken")
    (tmp_path / "e.warc").write_bytes(b"")
    rows = warc.read(spark, f"file://{tmp_path}").collect()
    fine = {r.page_id: bytes(r.payload) for r in rows if r.problem is None}
    assert fine == {1: b"one", 3: b"three" * 100, 6: b"", 7: b"seven", 8: b"eight"}
    reasons = sorted(r.problem.split(": ")[-1] for r in rows if r.problem)
    assert reasons == ["content-length missing", "last segment missing", "no WARC header", "payload digest differs", "record is cut off"]
    assert all(r.payload is None and r.payload_bytes is None for r in rows if r.problem)


@pytest.mark.parametrize("empty", [False, True])
def test_warc_and_url_rules_on_odd_tables(spark, empty, monkeypatch):
    rows = [] if empty else [(1, "http://net/x", "a" * 200), (1, "http://net/x", "a" * 200), (2, None, "a" * 200), (None, None, None), (3, "http://é/\t", ""),
                             (4, "x" * 3000, "b" * 200_000), (5, "http://org/fr/", "b" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)
    for limit in (1 << 17, 0):  # digests broadcast, or payloads shuffled by digest
        monkeypatch.setattr(warc, "BROADCAST_DIGESTS", limit)
        out = warc.round_trip(pages).collect()
        assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in out) == ([] if empty else [
            (0, "response", 0, 0), (1, "response", 0, 200), (1, "response", 0, 200), (2, "revisit", 1, 200), (3, "response", 0, 0),
            (4, "response", 0, 200_000), (5, "revisit", 4, 200_000)])
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judge(pages, rules).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert sorted((r.page_id or 0, r.rule or "") for r in judged) == ([] if empty else [(0, ""), (1, "net/"), (1, "net/"), (2, ""), (3, ""), (4, ""), (5, "org/fr/")])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_inputs(spark, empty):
    """Every operator and stage on nulls, empty and long texts, repeated rows, clashing names and an empty table."""
    df = odd(spark, empty)
    n = df.count()
    ids = [F.col("doc_id")]
    bench = spark.createDataFrame([] if empty else [(1, "the of lorem"), (None, None), (2, "")], "item_id long, text string")
    assert sharding.shard(df, 4).count() == n
    assert decontam.matches(df, bench, ids, "doc_id long").count() >= 0
    model = langid.fit(df)
    preds = langid.predict(df, model, [*ids, F.col("text")], "doc_id long, text string").collect()
    assert len(preds) == n and all((r.lang_pred == "und") == (r.score == 0) for r in preds)
    assert all(r.lang_pred == "und" for r in preds if not r.text or r.text.startswith("123"))
    scores = lm.score(df, lm.fit(df), ids, "doc_id long").collect()
    assert len(scores) == n and all(np.isfinite(r.score) and r.n_tokens >= 1 for r in scores)
    dups = simhash.near_duplicates(df).collect()
    assert len(dups) == n
    assert quality.quality(df).count() == n
    cut = substring.remove_repeats(df).collect()
    assert len(cut) == n
    assert mixing.mix(df).count() == n
    if not empty:
        ones = [r for r in cut if r.doc_id == 1]
        assert len(ones) == 2 and all(r.n_removed == 0 for r in ones)
        assert all(r.n_removed == r.n_words for r in cut if r.doc_id in (2, 11))
        assert {r.component_id for r in dups if r.doc_id in (1, 2, 11)} == {1}
        kept = simhash.drop_near_duplicates(df).collect()
        assert sorted(r.doc_id for r in kept if r.doc_id is not None).count(1) == 1
    current = df
    for name, stage in corpus_pipeline.STAGES:
        if name == "decontamination":
            out = decontam.decontaminate(current, bench)
        else:
            out = stage(spark, current, SF)
        if name != "sharding":
            assert out.columns == df.columns
        out.count()
        current = out if name != "quality" else df  # the odd texts go on to every stage


def test_pipeline(spark):
    """The stages' decisions against brute force, each on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    kept, now = {}, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        kept[name] = dict(texts(now))
    good = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert set(kept["quality"]) == good
    firsts = set(brute.components({d: brute.fingerprint(t) for d, t in kept["quality"].items()}).values())
    assert set(kept["near_duplicates"]) == firsts
    bad = {d for d, _ in brute.leaks(list(kept["near_duplicates"].items()), texts(bench, "item_id"))}
    assert set(kept["decontamination"]) == firsts - bad
    copies = {r.doc_id: r.copies for r in mixing.mix(now).collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: c for d, c in copies.items() if c}
    assert {r.shard for r in out} <= set(range(40))
