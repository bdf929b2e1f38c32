"""Quality classifier, spelling variants and hard negatives against brute force, held-out labels and odd inputs."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from textoverlap.llm import classifier, negatives, queries, spelling  # noqa: E402

SF = "/root/testdata/sf0.01"


def clashing(df):
    """With columns that operators use inside or return."""
    names = ("id", "label", "v", "n", "word", "leaf", "bucket", "key", "range", "of", "chunks", "score", "nodes", "anchor", "best", "d", "w")
    return df.withColumns({c: F.lit("clash") for c in names if c not in df.columns})


# quality classifier

def plain_score(m, text):
    """The network position by position."""
    b = (text or "").encode()
    blocks = [b[i:i + classifier.BLOCK] for i in range(0, max(len(b), 1), classifier.BLOCK)]

    def pooled(k):
        best = np.zeros(classifier.FILTERS)
        for i in range(len(blocks[k])):
            at = k * classifier.BLOCK + i
            seen = b[at:at + classifier.WIDTH].ljust(classifier.WIDTH, b"\0")
            best = np.maximum(best, np.concatenate([m.vectors[x] for x in seen]) @ m.filters + m.shift)
        return best

    pools = [pooled(k) for k in range(len(blocks))]
    chunks = [(np.maximum(pools[k], pools[k + 1]), len(blocks[k] + blocks[k + 1])) for k in range(len(blocks) - 1)] or [(pools[0], len(blocks[0]))]
    units = [np.maximum(np.append(p, n / (2 * classifier.BLOCK)) @ m.hidden + m.hidden_shift, 0) for p, n in chunks]
    return 1 / (1 + np.exp(-(np.max(units, axis=0) @ m.out + m.out_shift[0])))


def test_network_against_plain_loops(monkeypatch):
    monkeypatch.setattr(classifier, "PIECE_BLOCKS", 3)  # texts run over pieces
    m = classifier.Network.random(3)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abc é#|\n") for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 128, 129, 700)] + [None, "x" * 400]
    got = classifier.score_texts(m, pa.array(texts))
    assert got == pytest.approx([plain_score(m, t) for t in texts], rel=1e-4)
    assert len(classifier.score_texts(m, pa.array([], pa.string()))) == 0


def test_gradients_against_differences():
    rng = np.random.default_rng(4)
    m = classifier.Network.random(5)
    for p in m.parameters():
        p += rng.normal(0, 0.05, p.shape).astype(p.dtype)
    double = classifier.Network(*(p.astype(np.float64) for p in m.parameters()))
    data = rng.integers(97, 104, (9, 2 * classifier.BLOCK + classifier.WIDTH - 1)).astype(np.uint8)
    inside = np.ones((9, 2 * classifier.BLOCK), dtype=bool)
    inside[3, 50:] = False
    of, labels = np.array([0, 0, 0, 1, 1, 2, 2, 2, 2]), np.array([1, 0, 1], dtype=np.float32)

    def loss():
        pooled = double.responses(data, inside).max(axis=1)
        u = np.maximum(np.column_stack([pooled, inside.mean(axis=1)]) @ double.hidden + double.hidden_shift, 0)
        p = double.probability(np.maximum.reduceat(u, [0, 3, 5], axis=0))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for p, g in zip(double.parameters(), classifier._gradients(double, data, inside, of, labels)):
        flat = np.argsort(-np.abs(g).ravel())[:3]
        for k in flat.tolist():
            at = np.unravel_index(k, p.shape)
            old, step = p[at], 1e-6
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-2, abs=1e-6)


def test_held_out_quality(spark):
    got = queries.op11_quality_scores(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id", "left").collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_classifier_on_odd_rows(spark):
    rows = [(1, "good words here"), (1, "good words here"), (2, None), (None, "x"), (3, ""), (4, "é" * 9000), (5, "###")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = clashing(docs)
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (2, None), (None, 1), (3, 7), (99, 0)], "doc_id long, quality int")
    keep = [F.col("doc_id"), F.col("text")]
    model = classifier.fit(docs, labels, steps=5)
    got = classifier.score(docs, model, keep, "doc_id long, text string").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = {round(r.score, 9) for r in got if not r.text}
    assert len(empty) == 1
    none = classifier.fit(docs, labels.where("quality IS NULL"), steps=5)
    assert {r.score for r in classifier.score(docs, none, keep, "doc_id long, text string").collect()} == {0.5}
    assert classifier.score(docs.limit(0), model, keep, "doc_id long, text string").count() == 0


# spelling variants

def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] is not None else None))
    return sorted(out)


@pytest.mark.parametrize("range_words", [7, 1000])
def test_variants_of_dense_words(spark, range_words):
    """Words over few letters, with runs, empty and one-letter words, in one range and in many."""
    rnd = random.Random(range_words)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 7))): rnd.choice([1, 2, 5, 6, 30, 31, 200, 2000]) for _ in range(250)}
    words |= {"abcdefgh" * 40: 3, "abcdefgh" * 40 + "h": 20, "𝒳aaa": 1, "aaa𝒳": 9, "aaaa": 1000}
    df = clashing(spark.createDataFrame(list(words.items()), "word string, n long")).repartition(4)
    got = sorted(tuple(r) for r in spelling.variants(df, range_words=range_words).collect())
    assert got == brute_variants(words)


def test_nodes_are_shared_prefixes():
    """Equal prefixes have equal nodes across ranges, different ones different nodes."""
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 9))) for _ in range(120)})
    for size in (1, 4, 50, 200):
        parts = [words[i:i + size] for i in range(0, len(words), size)]
        borders = spelling._borders([(p[0], p[-1], k, len(p)) for k, p in enumerate(parts)])
        seen = {}
        for k, p in enumerate(parts):
            nodes, offsets = spelling.number_nodes(p, k + 1, borders)
            for j, w in enumerate(p):
                for i, x in enumerate(nodes[offsets[j]:offsets[j + 1]].tolist()):
                    assert seen.setdefault(w[:i], x) == x
        assert len(set(seen.values())) == len(seen)


def test_variants_of_odd_rows(spark):
    df = spark.createDataFrame([(None, 5), ("abcdef", None), ("abcdef", 2), ("abcdef", 3), ("abcdeg", 100)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(df).orderBy("word").collect()] == [("abcdef", "abcdeg", "abcdeg", 5, 1, 100), ("abcdeg", None, "abcdeg", 100, 1, None)]
    assert spelling.variants(df.limit(0)).count() == 0


def test_corpus_words(spark):
    """Runs, lower-casing, the lost code point and counts, on null ids and texts and a very long run."""
    import re
    rnd = random.Random(8)
    texts = [(i, " ".join(rnd.choice(["Straßen", "straßen", "ÉTUDES", "études", "bananas", "short", "ab1cdefgh", "x" * 300]) for _ in range(30))) for i in range(400)]
    texts += [(None, "bananas " * 9), (500, None), (501, "")]
    want = {}
    for d, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                want[w] = want.get(w, 0) + 1
    docs = clashing(spark.createDataFrame(texts, "doc_id long, text string")).repartition(3)
    got = spelling.corpus_words(docs, "[A-Za-z\\u00C0-\\u00FF]", 6, 5, queries._misspelt)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if n >= 5}
    assert len(want) > len({w for w, n in want.items() if n >= 5})  # some occurrence lost a code point


# hard negatives

def brute_negatives(rows, anchor, positives=5, negatives_=5):
    out = []
    for a, la, va in rows:
        if not anchor(a):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a))
        for s, p, lab in [x for x in scored if x[2] == la][:positives]:
            ps = -s
            hard = [(i, -t) for t, i, lab in scored if lab != la and 80 * ps <= 100 * -t <= 100 * ps][:negatives_]
            out += [(a, p, k, i, ps, t) for k, (i, t) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 8, "bucket_rows": 16, "sample_rows": 60}, {"leaf_rows": 2, "bucket_rows": 5, "sample_rows": 9}])
def test_hard_negatives(spark, sizes, monkeypatch):
    """Clusters, ties, equal vectors in a hot leaf, zero vectors; one leaf and many, cut leaves, several query chunks."""
    if sizes:
        monkeypatch.setattr(negatives, "CHUNK_QUERIES", 7)
        monkeypatch.setattr(negatives, "STEP", 5)
    rnd = random.Random(11)
    centres = [[rnd.randrange(-200, 200) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(260):
        c = rnd.choice(centres)
        rows.append((i * 3 - 60, rnd.randrange(4), [x + rnd.randrange(-40, 40) for x in c]))
    rows += [(2000 + i, i % 3, [9, 9, 9, 9, 9, 9]) for i in range(60)] + [(3000 + i, 1, [0] * 6) for i in range(4)]
    df = clashing(spark.createDataFrame(rows, "id long, label int, v array<bigint>")).repartition(4)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % 10 == 0, **sizes).collect())
    assert got == brute_negatives(rows, lambda i: i % 10 == 0)
    assert got


def test_siblings_are_eliminated():
    """Far clusters: a narrow annulus opens few leaves, and never misses a row."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, (64, 8))
    x = (centres[rng.integers(0, 64, 6000)] + rng.integers(-12, 12, (6000, 8))).astype(np.float64)
    tree = negatives.fit(x[:800], float((x * x).sum(axis=1).max()), len(x), leaf_rows=100)
    low, high = tree.low, tree.high

    def seen(level, node, child, d):
        for j in np.unique(child):
            low[level][node, :, j] = np.minimum(low[level][node, :, j], d[child == j].min(axis=0))
            high[level][node, :, j] = np.maximum(high[level][node, :, j], d[child == j].max(axis=0))

    leaf = tree.place(x, seen)
    score = (x[:200] @ x.T).astype(np.int64)
    most = np.sort(score, axis=1)[:, -2]
    least = (most * 0.98).astype(np.int64)
    alive = tree.alive(x[:200], least, most)
    for i in range(200):
        inside = np.flatnonzero((score[i] >= least[i]) & (score[i] <= most[i]))
        assert alive[i, leaf[inside]].all()
    assert alive.sum() < 0.5 * 200 * len(np.unique(leaf))


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0], 1), (2, [0.9, 0.2], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2),
            (None, [1.0, 1.0], 2), (7, [1.0, 1.0], None), (8, [], 2), (9, [-1.0, -1.0], 1)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    one = negatives.quantised(df)
    assert sorted(r.id for r in one.collect()) == [0, 0, 1, 2, 8, 9]
    got = sorted(tuple(r) for r in negatives.hard_negatives(one, F.col("id") % 10 == 0).collect())
    # of anchor 0 (256, 128): positive 1 (256, 0) scores 65536; row 2 (230, 51) scores 65408
    assert got == [(0, 1, 1, 2, 65536, 65408)]
    assert negatives.hard_negatives(one.limit(0), F.col("id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(one, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        negatives.index(spark.createDataFrame([(1, 1, [1 << 29])], "id long, label int, v array<bigint>"))
