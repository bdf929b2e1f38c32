"""Joins by large blocks: copies of a row do not grow with the rows of its bucket; every pair is met once."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textoverlap.operators import edit_join, grid, jaccard_join
from textoverlap.operators.sentences import sentence_id


def _names():
    def run(left, right, one):  # not a function of this module, which workers do not have
        a, b = left.column("sid").to_pylist(), right.column("sid").to_pylist()
        found = list(itertools.combinations(a, 2) if one else itertools.product(a, b))
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.string()), "b": pa.array([y for _, y in found], pa.string())})

    return run


def test_grid_meets_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(grid, "GRID", 1)
    bucket = {str(i): i % 3 + i % 5 // 4 for i in range(60)}
    df = spark.createDataFrame(list(bucket.items()), "sid string, bucket int")
    got = [tuple(sorted(r)) for r in grid.self_grid(df, F.lit(1), 7, _names(), "a string, b string").collect()]
    want = [tuple(sorted(p)) for p in itertools.combinations(bucket, 2) if abs(bucket[p[0]] - bucket[p[1]]) <= 1]
    assert sorted(got) == sorted(want)
    other = spark.createDataFrame([("r" + k, v * 2) for k, v in bucket.items()], "sid string, bucket int")
    got = sorted(map(tuple, grid.cross_grid(df, other, F.lit(1), 7, _names(), "a string, b string").collect()))
    assert got == sorted((a, "r" + b) for a in bucket for b in bucket if abs(bucket[a] - 2 * bucket[b]) <= 1)


def test_rows_of_a_large_bucket_are_copied_a_few_times(spark):
    """600 sentences of one length, blocks of 16 rows: joins of small blocks copy a row about 38 times on either side."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcde fgh") for _ in range(40)) for _ in range(600)]
    d = spark.createDataFrame([(t,) for t in texts], "text string").select(sentence_id().alias("sid"), "text", F.octet_length("text").alias("n_bytes"))

    def count(left, right, one):
        yield pa.RecordBatch.from_pydict({"n": [left.num_rows + (0 if one else right.num_rows)]})

    f = edit_join.edit_features(d, 0.7)
    assert grid.self_grid(f, F.lit(1), 16, count, "n long").agg(F.sum("n")).first()[0] <= 5 * 600


@pytest.mark.parametrize("size", [3, 40, 60, 150, 400])
def test_parity_bits_bound_the_difference(size):
    rng = np.random.default_rng(size)
    sets = [np.unique(rng.integers(0, 1 << 24, size)) for _ in range(40)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    bits = jaccard_join.parity_bits(np.concatenate(sets), offsets)
    for words in jaccard_join._folded(bits).values():
        for i, j in itertools.combinations(range(40), 2):
            differing = sum(int(np.bitwise_count(w[i] ^ w[j])) for w in words)
            assert differing <= len(np.setxor1d(sets[i], sets[j]))


def test_jaccard_pairs_of_sets_of_all_sizes(spark):
    rng = random.Random(5)
    sets = []
    for n in (1, 2, 3, 10, 47, 48, 49, 96, 130, 200, 500):
        base = rng.sample(range(1 << 50), n)
        sets += [sorted({*base[:n - cut], *rng.sample(range(1 << 50), cut // 2)}) for cut in (0, 1, n // 10, n // 6, n // 4, n // 3) if cut < n]
    df = spark.createDataFrame([(f"{i:03d}", s) for i, s in enumerate(sets)], "sid string, set array<bigint>")
    want = {}
    for (i, a), (j, b) in itertools.combinations(enumerate(map(set, sets)), 2):
        if len(a & b) / len(a | b) >= 0.7:
            want[f"{i:03d}", f"{j:03d}"] = (len(a), len(b), len(a & b), len(a & b) / len(a | b))
    got = {(r.sid_a, r.sid_b): (r.size_a, r.size_b, r.intersection, r.jaccard) for r in jaccard_join.similar_jaccard_pairs(df, 0.7, 1).collect()}
    assert len(want) > 30 and got == want
    cross = {(r.sid_a, r.sid_b): r.jaccard for r in jaccard_join.similar_jaccard_pairs_rs(df, df, 0.7, 1).collect()}
    assert cross == {**{k: v[3] for k, v in want.items()}, **{k[::-1]: v[3] for k, v in want.items()}, **{(f"{i:03d}",) * 2: 1.0 for i in range(len(sets))}}


def _sentences(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, pos int, text string")


def test_sentence_vocabulary_counts_where_shingles_are_made(spark):
    """Equals the vocabulary of shingle rows, with null and repeated keys; a batch gives one row a distinct shingle."""
    from textoverlap.operators.shingles import shingles
    from textoverlap.operators.vocabulary import key_numbers, sentence_vocabulary, vocabulary
    rng = random.Random(9)
    rows = [(rng.choice([None, -2, 3, 4, 11]), rng.randrange(1, 4), "".join(rng.choice("abé ") for _ in range(rng.randrange(0, 40)))) for _ in range(300)]
    keys = ["doc_id", "pos"]
    plain, made = (sorted(map(tuple, v.select("code", "first_doc_id", "first_pos", "first_spos", "n_occurrences").collect()), key=str)
                   for v in (vocabulary(shingles(_sentences(spark, rows), keys), keys), sentence_vocabulary(_sentences(spark, rows), keys)))
    assert plain == made and len(made) > 50
    one = _sentences(spark, [(1, i, "abab " * 50) for i in range(1, 200)]).coalesce(1)
    plan = sentence_vocabulary(one, keys)
    assert plan.agg(F.sum("n_occurrences")).first()[0] == 199 * 248
    assert key_numbers([pa.array([5, None, 5, 2]), pa.array(["b", "a", "a", None])]).tolist() == [3, 0, 2, 1]


def test_encoded_members_and_signatures(spark, monkeypatch):
    """Chunks of a few bytes; null keys, keys that come twice and sentences without a shingle."""
    from textoverlap.operators import encoding
    from textoverlap.operators.shingles import member_rows
    from textoverlap.operators.signatures import minhash
    from textoverlap.operators.vocabulary import sentence_vocabulary
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 500)
    rng = random.Random(10)
    rows = [(rng.choice([None, *range(20)]), rng.randrange(1, 6), "".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 60)))) for _ in range(200)]
    s, keys = _sentences(spark, rows), ["doc_id", "pos"]
    v = sentence_vocabulary(s, keys)
    want = member_rows(s, keys, 3, "weighted").join(v.select("code", "vid"), "code").select(*keys, "vid")
    got = encoding.encoded_members(s, v, keys, 3, 1 << 18)
    ordered = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert ordered(got) == ordered(want)
    sig = encoding.sentence_signatures(s, v, keys, 3, 1 << 18, 16, 7).select(*keys, F.posexplode("signature").alias("j", "vid"))
    assert ordered(sig.withColumn("j", F.col("j") + 1)) == ordered(minhash(want, keys, 16, 7))


def test_first_by_packed_and_wide():
    from textoverlap.functions import sets
    rng = np.random.default_rng(1)
    owner = np.sort(rng.integers(0, 30, 500))
    for top in (5, 1 << 24, 1 << 56):
        value = rng.choice(rng.integers(0, top, 40), 500)
        first = {}
        for i, key in enumerate(zip(owner.tolist(), value.tolist())):
            first.setdefault(key, i)
        assert sets.first_by(owner, value).tolist() == [first[k] for k in sorted(first)]
    assert sets.first_by(owner[:0], owner[:0]).tolist() == []


def test_batches_are_gathered_before_distances():
    batches = [pa.RecordBatch.from_pydict({"x": [i, i + 1]}) for i in range(0, 10, 2)]
    got = list(edit_join._gathered(iter(batches)))
    assert len(got) == 1 and got[0].column(0).to_pylist() == list(range(10))
    assert list(edit_join._gathered(iter([]))) == []


def test_few_long_pairs_take_integers_and_many_take_words(monkeypatch):
    """Equal distances either way; a few long pairs do not pay numpy's steps."""
    from textoverlap.functions import distance
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcd \xc3\xa9") for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 300]))) for _ in range(60)]
    left, right = pa.array(texts[:30], pa.binary()), pa.array(texts[30:], pa.binary())
    few = distance.edit_distances(left, right)
    monkeypatch.setattr(distance, "FEW", 0)
    assert (few == distance.edit_distances(left, right)).all()
    monkeypatch.setattr(distance, "FEW", 24)
    monkeypatch.setattr(distance, "_columns", None)
    assert (distance.edit_distances(left, right) == few).all()
