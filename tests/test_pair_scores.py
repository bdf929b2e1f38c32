"""Scores of given pairs, the threshold join and the embedding's bands against plain versions."""

import itertools
import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_operators import brute_edit, distinct_df, docs, fixture_sentences, lev
from textoverlap.config import Params
from textoverlap.functions import dense
from textoverlap.operators import edit_join, hamming_bands, pair_scores, scoring
from textoverlap.plans import jobs

P = 2147483647


def split(text):
    """Sentences of a text without blanks at the front, as bytes."""
    out = [x.lstrip(" \n\r\t") for x in "".join("." if c in "!?" else c for c in text or "").split(".")]
    ends = sum(c in ".!?" for c in text or "")
    return ["".join(c.lower() if c.isascii() else c for c in x).encode() for x in out if x][:ends]


def plain_dense(sentences, k=3):
    """The original's vectors with seeded permutations: vocabulary in order, lossy sets, first member under each."""
    shingles = [[s[i:i + k] for i in range(len(s) - k + 1)] for s in sentences]
    vocab = {}
    for x in itertools.chain(*shingles):
        vocab.setdefault(x, len(vocab) + 1)
    out = []
    for own in shingles:
        kept = {}
        for x in own:
            kept.setdefault(sum(c * (i + 1) for i, c in enumerate(x)), x)
        ids = [vocab[x] for x in kept.values()]
        row = []
        for j in range(1, len(sentences) + 1):
            a = 1 + ((j * j % P) * 48271 + j * 16807 + 20240601) % (P - 1)
            b = ((j * j % P) * 69621 + j * 40692 + 1062042) % P
            row.append(min(ids, key=lambda v: (a * v + b) % P) if ids else 0)
        out.append(row)
    return out


def plain_cosine(a, b):
    dot, na, nb = (sum(x * y for x, y in zip(u, v)) for u, v in ((a, b), (a, a), (b, b)))
    return dot / (math.sqrt(na) * math.sqrt(nb)) if na and nb else 0.0


def plain_scores(t1, t2, k=3):
    s1, s2 = split(t1), split(t2)
    v = plain_dense(s1 + s2, k)
    d = sum(plain_cosine(a, b) >= 0.7 for a in v[:len(s1)] for b in v[len(s1):])
    e = sum(1.0 - lev(a, b) / max(len(a), len(b)) >= 0.7 for a in s1 for b in s2)
    total = len(s1) * len(s2)
    return (len(s1), len(s2), d / total if total else 0.0, e / total if total else 0.0)


def texts(n=9, seed=3):
    rnd = random.Random(seed)
    base = fixture_sentences(60, seed)
    return [". ".join(rnd.choice(base) for _ in range(rnd.randrange(1, 14))) + "." for _ in range(n)]


@pytest.mark.parametrize("block", [3, 128])
def test_score_pairs_equals_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(pair_scores, "BLOCK", block)  # pairs are cut into many blocks, or stay whole
    t = texts() + ["no delimiter", None, "ab. cd.", "abcab. abcab! cacab?"]
    d = docs(spark, t)
    pairs = [(a, b) for a, b in itertools.combinations(range(len(t)), 2)] + [(0, 99), (98, 1), (0, 1)]
    rows = pair_scores.score_pairs(d, d, spark.createDataFrame(pairs, "doc1 long, doc2 long").repartition(3)).collect()
    got = {(r.doc1, r.doc2): (r.n1, r.n2, r.dense_similarity, r.edit_similarity) for r in rows}
    assert len(rows) == len(got)
    assert got == {(a, b): plain_scores(t[a], t[b]) for a, b in set(pairs) if a < len(t) and b < len(t)}
    assert all(r.overall_similarity == (r.dense_similarity + r.edit_similarity) / 2 and r.flagged == (r.overall_similarity >= 0.5) for r in rows)


def test_shingles_of_five_bytes(spark):
    """Sets, the exact and the banded Jaccard join and the pair scores with k = 5 against plain versions."""
    t = texts(7, 21)
    d = docs(spark, t)
    p = Params(k=5, block_rows=16)
    rows = pair_scores.score_pairs(d, d, spark.createDataFrame([(0, 1), (2, 3), (4, 6)], "doc1 long, doc2 long"), k=5).collect()
    assert {(r.doc1, r.doc2): (r.n1, r.n2, r.dense_similarity, r.edit_similarity) for r in rows} == {
        (a, b): plain_scores(t[a], t[b], 5) for a, b in ((0, 1), (2, 3), (4, 6))}
    c = jobs.Corpus.of(d.unionByName(docs(spark, fixture_sentences(90, 4)).selectExpr("doc_id + 100 AS doc_id", "concat(text, '.') AS text")), 5)
    own = {r.sid: r.text.encode() for r in c.distinct.collect()}
    shingles = {s: {b[i:i + 5] for i in range(len(b) - 4)} for s, b in own.items()}
    assert {r.sid: set(r["set"]) for r in c.sets.collect()} == {s: {int.from_bytes(x, "big") for x in v} for s, v in shingles.items() if v}
    want = {frozenset((a, b)) for a, b in itertools.combinations(own, 2)
            if shingles[a] and shingles[b] and len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= 0.7}
    got = {m: {frozenset((r.sid_a, r.sid_b)) for r in jobs.jaccard_pairs(c, p, m).collect()} for m in ("exact", "banded")}
    assert got["exact"] == want and got["banded"] <= want and len(got["banded"]) >= 0.9 * len(want) > 5


def test_dense_vectors_in_steps(monkeypatch):
    """Many permutations at once or a few: the same vectors; a row without members is zero."""
    sentences = [b"a stitch in time", b"ab", b"saves nine", b"a stitch in tim"]
    _, members, offsets = pair_scores.shingle_places(sentences, 3)
    want = dense.dense_vectors(members + 1, offsets, 4)
    assert want.tolist() == plain_dense(sentences)
    monkeypatch.setattr(dense, "STEP", 1)
    assert dense.dense_vectors(members + 1, offsets, 4).tolist() == want.tolist()


def test_compare_two_text_ids_and_missing(spark):
    d = spark.createDataFrame([("a", "Same sentence here."), ("b", "same sentence here."), ("c", "")], "doc_id string, text string")
    r = jobs.compare_two(d, "a", "b").first()
    assert (r.lsh_similarity, r.edit_similarity, r.flagged) == (1.0, 1.0, True)
    assert jobs.compare_two(d, "a", "c").first().n2 == 0
    assert jobs.compare_two(d, "a", "zz").count() == 0


def test_flagged_pairs_equal_filtered_scores(spark):
    """The threshold join gives the flagged rows of the whole table: copies, repeated lines, hot lines, one-line documents."""
    rnd = random.Random(5)
    base = fixture_sentences(12, 5)
    t = [". ".join(rnd.choice(base[:4]) for _ in range(rnd.choice([1, 1, 2, 3]))) + "." for _ in range(40)]
    t += ["the hot line. " * rnd.choice([1, 1, 3]) + (rnd.choice(base) + ".") * rnd.choice([0, 0, 2]) for _ in range(25)]
    d = docs(spark, t)
    whole = {(r.doc1, r.doc2): tuple(r) for r in jobs.compare_corpus(d).where("flagged").collect()}
    got = {(r.doc1, r.doc2): tuple(r) for r in jobs.flagged_pairs(d).collect()}
    assert got == whole and len(got) > 50


def test_reaching_pairs_miss_no_pair(spark):
    d = docs(spark, texts(30, 8))
    c = jobs.Corpus.of(d)
    pairs, same = jobs.edit_pairs(c), c.distinct.select("sid")
    weights = scoring.all_weights(pairs, same, c.post, 4)
    every = scoring.ratio_scores(scoring.pair_counts_self(pairs, same, c.post, 4), c.counts, c.counts, "edit").collect()
    for least in (0.1, 0.25, 0.5):
        reach = {tuple(r) for r in scoring.reaching_pairs(weights, c.post, c.counts, least, 4).collect()}
        assert {(r.doc1, r.doc2) for r in every if r.edit_similarity >= least} <= reach
    found = {(r.doc1, r.doc2): r.similar_pairs for r in scoring.counts_of(spark.createDataFrame([(r.doc1, r.doc2) for r in every], "doc1 long, doc2 long"), weights, c.post).collect()}
    assert found == {(r.doc1, r.doc2): r.edit_pairs for r in every}


# the embedding

def plain_walk(data, walk, steps):
    out, at = [], 0
    for j in range(steps):
        c = data[at] if at < len(data) else 0
        out.append(c)
        at += int(hamming_bands.mix(walk, j, c) >> 7) & 1
    return out


def test_walks_and_keys():
    texts = [b"kitten sitting", b"k", b"the quick brown fox jumps over it", bytes(range(1, 60))]
    start = np.cumsum([0] + [len(x) for x in texts[:-1]])
    got = hamming_bands.walk(np.frombuffer(b"".join(texts), np.uint8), start, np.array([len(x) for x in texts]), 50)
    for i, x in enumerate(texts):
        for w in (0, 7, 15):
            assert got[:, i, w].tolist() == plain_walk(x, w, 50)
    bucket = np.array([7, 0, 9, 11])
    keys = {}
    for rows, key, own in hamming_bands.band_keys(pa.array(texts, pa.binary()), bucket, 0.7):
        for r, k, o in zip(rows.tolist(), key.tolist(), own.tolist()):
            keys.setdefault(r, set()).add((k, o))
    assert all(len(v) == 2 * hamming_bands.WALKS * hamming_bands.BANDS for v in keys.values())
    pos = hamming_bands.positions(9, 0.7)
    seen = [plain_walk(texts[2], 3, 2049)[p] for p in pos[3, 2].tolist()]
    want = ((9 * 16 + 3) * 4 + 2) << 32 | int.from_bytes(bytes(seen), "big")
    assert (want, True) in keys[2]


def test_hamming_pairs_are_right_and_symmetric_in_blocks(spark):
    d = distinct_df(spark, fixture_sentences(200, 13))
    text = {r.sid: r.text for r in d.collect()}
    exact = brute_edit(list(text.values()))
    found = []
    for rows, batch in ((8, 10_000), (2048, 10_000), (2048, 3)):  # most keys in blocks; in runs; runs that go on over Arrow batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        found.append({frozenset((text[r.sid_a], text[r.sid_b])) for r in hamming_bands.similar_edit_pairs_hamming(d, 0.7, rows).collect()})
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] == found[2] and found[0] <= exact and len(found[0]) >= 0.9 * len(exact)


def test_two_corpora_banded_within_exact(spark):
    """Two corpora with common sentences: what the bands find is right, and they find nearly all."""
    left, right = docs(spark, texts(14, 31)), docs(spark, texts(11, 31)).withColumn("doc_id", F.col("doc_id") + 500)
    scores = {m: {(r.doc1, r.doc2): r for r in jobs.compare_corpora(left, right, method=m).collect()} for m in ("exact", "banded")}
    assert set(scores["banded"]) <= set(scores["exact"])
    for k, r in scores["banded"].items():
        e = scores["exact"][k]
        assert (r.n1, r.n2) == (e.n1, e.n2) and r.edit_similarity <= e.edit_similarity and r.lsh_similarity <= e.lsh_similarity
    whole, found = (sum(r.edit_similarity + r.lsh_similarity for r in scores[m].values()) for m in ("exact", "banded"))
    assert len(scores["exact"]) > 50 and found >= 0.9 * whole
    a, b = jobs.Corpus.of(left), jobs.Corpus.of(right)
    exact = {(r.sid_a, r.sid_b) for r in edit_join.similar_edit_pairs_rs(a.distinct, b.distinct).collect()}
    near = {(r.sid_a, r.sid_b) for r in hamming_bands.similar_edit_pairs_hamming_rs(a.distinct, b.distinct).collect()}
    assert near <= exact and {(x, y) for x, y in exact if x == y} <= near and len(near) >= 0.9 * len(exact)


SF001 = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF001), reason="needs the test tables")
def test_exact_edit_join_against_every_pair(spark):
    """All pairs of the distinct sf0.001 sentences whose lengths allow it, without the engine's buckets and byte counts."""
    import duckdb
    d = jobs.Corpus.of(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")).distinct
    con = duckdb.connect()
    con.register("s", d.select("sid", "text").toArrow())
    want = con.execute("""
        WITH x AS MATERIALIZED (SELECT sid, text, strlen(text) AS n FROM s)
        SELECT a.sid, b.sid FROM x a JOIN x b ON a.sid < b.sid AND a.n >= 0.7 * b.n AND b.n >= 0.7 * a.n
        WHERE 1.0 - levenshtein(a.text, b.text) / greatest(a.n, b.n)::DOUBLE >= 0.7""").fetchall()
    got = {(r.sid_a, r.sid_b) for r in edit_join.similar_edit_pairs(d).collect()}
    assert got == set(want) and len(want) == 274


SF01 = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF01), reason="needs the test tables")
def test_recall_of_the_embedding(spark):
    """At least nine of ten edit-similar pairs of the sf0.01 sentences. The exact pairs are those of a sample of sentences
    against all others, found by brute force within the length bound."""
    from textoverlap.functions.distance import edit_distances

    d = jobs.Corpus.of(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")).distinct
    rows = d.select("sid", F.encode("text", "UTF-8").alias("b")).collect()
    sids, data = [r.sid for r in rows], [bytes(r.b) for r in rows]
    size = np.array([len(x) for x in data])
    counts = np.stack([np.bincount(np.frombuffer(x, np.uint8), minlength=256) for x in data]).astype(np.int16)
    asked = [i for i in range(len(rows)) if sids[i][0] == "7"]  # a sixteenth
    exact = set()
    column = pa.array(data, pa.binary())
    for i in asked:
        most = 0.3 * np.maximum(size, size[i])
        near = np.flatnonzero(np.abs(size - size[i]) <= most)
        near = near[near != i]
        # half the difference of byte counts bounds the distance from below
        near = near[np.abs(counts[near] - counts[i]).sum(axis=1) <= 2 * most[near] + 1]
        dist = edit_distances(pa.array([data[i]] * len(near), pa.binary()), column.take(pa.array(near)))
        exact |= {frozenset((sids[i], sids[j])) for j in near[1.0 - dist / np.maximum(size[near], size[i]) >= 0.7].tolist()}
    got = {frozenset((r.sid_a, r.sid_b)) for r in hamming_bands.similar_edit_pairs_hamming(d).collect()}
    assert len(exact) > 150 and len(exact & got) >= 0.9 * len(exact)

