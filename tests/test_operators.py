"""Goldens derived by hand from the original detector's rules, and
brute-force checks of the partitioned joins on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from textoverlap.config import Params
from textoverlap.functions.text import ascii_lower
from textoverlap.operators import banded_join, edit_join, jaccard_join
from textoverlap.operators.blocking import blocked_cross_pairs, blocked_self_pairs
from textoverlap.operators.report import report_text
from textoverlap.operators.sentences import distinct_sentences, sentence_counts, sentences
from textoverlap.operators.shingles import set_arrays, shingle_stats, shingles
from textoverlap.plans import jobs


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def split(spark, text):
    rows = sentences(docs(spark, [text])).orderBy("pos").collect()
    return [r.text for r in rows]


@pytest.mark.parametrize("text,expected", [
    ("Hello World. Foo bar!\nNo end", ["hello world", "foo bar"]),
    ("a.. b", ["a", "b"]),
    ("no delimiter", []),
    (" . ", []),
    ("x . y.", ["x ", "y"]),
    ("v3.14 ok.", ["v3", "14 ok"]),
    ("...Lead? \t\nTabs!", ["lead", "tabs"]),
])
def test_sentence_split(spark, text, expected):
    assert split(spark, text) == expected


def test_sentence_counts_include_empty(spark):
    d = docs(spark, ["One. Two.", "none", None])
    got = {r.doc_id: (r.n_sentences, r.n_delimiters) for r in sentence_counts(d).collect()}
    assert got == {0: (2, 2), 1: (0, 0), 2: (0, 0)}


def test_ascii_lower_keeps_non_ascii(spark):
    r = spark.createDataFrame([("ÉA",)], "t string").select(ascii_lower(F.col("t")).alias("x")).first()
    assert r.x == "Éa"


def test_shingles_bytes(spark):
    d = spark.createDataFrame([(1, "abcd"), (2, "ab"), (3, "é")], "doc_id long, text string")
    got = {}
    for r in shingles(d, ["doc_id"], 3).orderBy("doc_id", "spos").collect():
        got.setdefault(r.doc_id, []).append(r.shingle)
    assert got == {1: ["616263", "626364"]}


def test_weights_and_weighted_set(spark):
    d = spark.createDataFrame([(1, "abc"), (2, "cac"), (3, "abcac")], "doc_id long, text string")
    w = {r.doc_id: r.weight for r in shingles(d, ["doc_id"], 3).where("spos = 1").collect()}
    assert w[1] == 590 and w[2] == 590
    st = {r.doc_id: (r.n_shingles, r.n_set_exact, r.n_set_weighted) for r in shingle_stats(d, ["doc_id"]).collect()}
    assert st[3] == (3, 3, 2)


def brute_edit(texts, t=0.7):
    out = set()
    for a, b in itertools.combinations(sorted(set(texts)), 2):
        ba, bb = a.encode(), b.encode()
        d = lev(ba, bb)
        if 1.0 - d / max(len(ba), len(bb)) >= t:
            out.add(frozenset((a, b)))
    return out


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        cur = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (a[i - 1] != b[j - 1]))
        prev = cur
    return prev[-1]


def fixture_sentences(n=160, seed=7):
    rng = random.Random(seed)
    base = ["the quick brown fox jumps", "lorem ipsum dolor sit amet", "café crème brûlée",
            "a stitch in time saves nine", "kitten", "sitting", "ab"]
    out = []
    for _ in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            op = rng.randrange(3)
            pos = rng.randrange(len(s) + 1)
            if op == 0:
                s.insert(pos, rng.choice("abcdefgh é"))
            elif op == 1 and pos < len(s):
                del s[pos]
            elif pos < len(s):
                s[pos] = rng.choice("xyz")
        out.append("".join(s) or "x")
    return out


def distinct_df(spark, texts):
    return distinct_sentences(sentences(docs(spark, [t + "." for t in texts])))


def test_edit_join_equals_brute_force(spark):
    texts = fixture_sentences()
    d = distinct_df(spark, texts)
    pairs = edit_join.similar_edit_pairs(d, 0.7, block_rows=16)   # tiny blocks: many block pairs
    sid_text = {r.sid: r.text for r in d.collect()}
    got = {frozenset((sid_text[r.sid_a], sid_text[r.sid_b])) for r in pairs.collect()}
    assert got == brute_edit(list(sid_text.values()))
    assert all(r.sid_a < r.sid_b for r in pairs.collect())


def test_kitten_sitting_not_similar_but_ten_minus_three_is(spark):
    d = distinct_df(spark, ["kitten", "sitting", "abcdefghij", "abcdefgxyz"])
    sid_text = {r.sid: r.text for r in d.collect()}
    got = {frozenset((sid_text[r.sid_a], sid_text[r.sid_b])): r.distance
           for r in edit_join.similar_edit_pairs(d, 0.7).collect()}
    assert got == {frozenset(("abcdefghij", "abcdefgxyz")): 3}


def shingle_set(s, k=3):
    b = s.encode()
    return {b[i:i + k] for i in range(len(b) - k + 1)}


def test_jaccard_join_equals_brute_force(spark):
    texts = fixture_sentences(200, 11)
    d = distinct_df(spark, texts)
    sets = set_arrays(d, ["sid", "n_bytes"])
    sid_text = {r.sid: r.text for r in d.collect()}
    got = {frozenset((sid_text[r.sid_a], sid_text[r.sid_b]))
           for r in jaccard_join.similar_jaccard_pairs(sets, 0.7, block_rows=8).collect()}
    want = set()
    for a, b in itertools.combinations(sorted(sid_text.values()), 2):
        x, y = shingle_set(a), shingle_set(b)
        if x and y and len(x & y) / len(x | y) >= 0.7:
            want.add(frozenset((a, b)))
    assert got == want
    banded = {frozenset((sid_text[r.sid_a], sid_text[r.sid_b]))
              for r in banded_join.similar_jaccard_pairs_banded(sets, 0.7, 100, 1, 20, 5).collect()}
    assert banded <= want          # verified: never a wrong pair


def test_blocked_pairs_cover_every_pair_once(spark):
    rows = [(0 if i < 50 else i % 3, i) for i in range(80)]   # key 0 is hot
    df = spark.createDataFrame(rows, "k int, id long")
    got = sorted((r.l_id, r.r_id) for r in blocked_self_pairs(df, "k", "id", 7).collect())
    want = sorted((a, b) for (ka, a), (kb, b) in itertools.combinations(rows, 2) if ka == kb)
    want = sorted((min(a, b), max(a, b)) for a, b in want)
    assert got == want
    right = spark.createDataFrame([(0, 1000 + i) for i in range(20)], "k int, id long")
    cross = blocked_cross_pairs(df, right, "k", "id", 6).count()
    assert cross == sum(1 for k, _ in rows if k == 0) * 20


def score_pair(spark, t1, t2):
    return jobs.compare_two(docs(spark, [t1, t2]), 0, 1).first()


def test_identical_one_sentence_documents(spark):
    r = score_pair(spark, "Same sentence here.", "same sentence here.")
    assert (r.edit_similarity, r.lsh_similarity, r.overall_similarity, r.flagged) == (1.0, 1.0, 1.0, True)


def test_identical_three_dissimilar_sentences(spark):
    t = "Alpha beta gamma. Completely different words! Zzz qqq xxx?"
    r = score_pair(spark, t, t)
    assert r.edit_similarity == pytest.approx(1 / 3) and r.n1 == 3 and r.n2 == 3


def test_document_without_sentences(spark):
    r = score_pair(spark, "no delimiter at all", "Some text. More text.")
    assert (r.edit_similarity, r.lsh_similarity, r.overall_similarity, r.flagged) == (0.0, 0.0, 0.0, False)


def test_corpus_scores_equal_brute_force(spark):
    texts = ["The cat sat. A dog ran! Birds fly?", "the cat sat. Fish swim.", "A dog ran. Nothing here.",
             "Unrelated words only.", "the cat sat! the cat sat."]
    scores = {(r.doc1, r.doc2): r for r in jobs.compare_corpus(docs(spark, texts)).collect()}
    sents = [[s.text for s in sentences(docs(spark, [t])).orderBy("pos").collect()] for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        sim = sum(1 for a in sents[i] for b in sents[j]
                  if 1.0 - lev(a.encode(), b.encode()) / max(len(a.encode()), len(b.encode())) >= 0.7)
        want = sim / (len(sents[i]) * len(sents[j]))
        got = scores[(i, j)].edit_similarity if (i, j) in scores else 0.0
        assert got == pytest.approx(want), (i, j)


def test_report_block(spark):
    df = spark.createDataFrame([("a.txt", "b.txt", 0.03125, 0.5, 0.265625, False)],
                               "doc1 string, doc2 string, lsh_similarity double, edit_similarity double, "
                               "overall_similarity double, flagged boolean")
    text = report_text(df).first().report.split("\n")
    assert text[3] == "Document 1: a.txt"
    assert text[6] == "LSH Similarity: 0.0312"        # half-even on the exact value, as printf
    assert text[8] == "Overall Similarity: 0.2656"
    assert text[10].startswith("NO PLAGIARISM DETECTED")


def test_params_defaults():
    p = Params()
    assert (p.sim_threshold, p.flag_threshold, p.k) == (0.7, 0.5, 3)


def test_batch_edit_distance_equals_table():
    import random

    import pyarrow as pa
    from textoverlap.functions.distance import edit_distances

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(7)
    left, right = [], []
    for _ in range(300):
        letters = rng.choice([b"ab", b"abcdefgh", bytes(range(256))])
        a = bytes(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 200])))
        b = bytearray(a)
        for _ in range(rng.randint(0, 25)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = bytes(rng.choice(letters) for _ in range(rng.randint(0, 1)))
        left.append(a)
        right.append(bytes(b))
    got = edit_distances(pa.array(left, pa.binary()), pa.array(right, pa.binary()))
    assert got.tolist() == [table(a, b) for a, b in zip(left, right)]
    assert edit_distances(pa.array([], pa.binary()), pa.array([], pa.binary())).tolist() == []
