"""Splitting many texts at once, the common-subsequence bound, and joins with a side that goes to every task."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textoverlap.functions import distance
from textoverlap.functions.text import sentence_runs
from textoverlap.operators import edit_join, grid, jaccard_join
from textoverlap.operators.sentences import distinct_sentences, sentence_counts, sentences
from textoverlap.operators.shingles import set_arrays
from textoverlap.plans import jobs


def split(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in text)
    n = len(re.findall(rb"[.!?]", text))
    return [x for x in (re.sub(rb"^[ \n\r\t]+", b"", f) for f in re.split(rb"[.!?]+", low)) if x][:n], n


def side(texts):
    return np.frombuffer(b"".join(texts) + b"\0", np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
        row = new
    return row[-1]


def test_many_texts_split_at_once():
    r = random.Random(1)
    for _ in range(400):
        texts = ["".join(r.choice("aB é.!? \n\t") for _ in range(r.randrange(30))).encode() for _ in range(r.randrange(1, 8))]
        data, off = side([b"x", *texts])  # a slice of a longer buffer
        n, delimiters, found, at = sentence_runs(data, off[1:])
        want = [split(t) for t in texts]
        assert [bytes(found[a:b]) for a, b in zip(at, at[1:])] == [s for x, _ in want for s in x]
        assert n.tolist() == [len(x) for x, _ in want] and delimiters.tolist() == [d for _, d in want]


def test_sentences_are_split_without_regular_expressions(spark):
    rows = [(1, "One. \t Two é!? three"), (2, None), (None, "A.B."), (4, ""), (5, "no end"), (1, "One.")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.pos, r.text, r.n_bytes, r.n_chars) for r in sentences(d).collect()))
    assert got == [(0, 1, "a", 1, 1), (0, 2, "b", 1, 1), (1, 1, "one", 3, 3), (1, 1, "one", 3, 3), (1, 2, "two é", 6, 5), (1, 3, "three", 5, 5)]
    assert sorted((r.doc_id or 0, r.n_sentences, r.n_delimiters) for r in sentence_counts(d).collect()) == [
        (0, 2, 2), (1, 1, 1), (1, 3, 3), (2, 0, 0), (4, 0, 0), (5, 0, 0)]
    for plan in (sentences(d), distinct_sentences(sentences(d))):  # both were slow: regular expressions a fragment, a sort of all texts
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "regexp_replace" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("t", [0.3, 0.7, 0.9])
def test_reach_is_the_common_subsequence(monkeypatch, t):
    monkeypatch.setattr(distance, "FEW", 0.01)
    r = random.Random(3)
    for most in (12, 70, 140, 300):
        letters = r.choice([b"ab", b"abcdefghij"])
        left = [bytes(r.choice(letters) for _ in range(r.randrange(most))) for _ in range(6)]
        right = [bytes(r.choice(letters) for _ in range(r.randrange(most))) for _ in range(5)] + [x[:len(x) // 2] + b"zz" + x[len(x) // 2:] for x in left[:3]]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
        got = distance.within_reach(side(left), side(right), i, j, t).tolist()
        longest = [max(len(left[a]), len(right[b])) for a, b in zip(i, j)]
        assert got == [k for k in range(len(i)) if common(left[i[k]], right[j[k]]) >= t * longest[k] - 1e-6]


def test_few_of_the_unrelated_pairs_get_a_distance(monkeypatch):
    """Of pairs that pass the bounds of lengths and histograms, the exact distance was computed for all."""
    r = random.Random(5)
    words = ["anon", "the", "ing", "ere", "tion", "ed", "hat", "ly", "wh", "is"]
    texts = ["".join(r.choice(words) + " " for _ in range(14)).encode() for _ in range(200)]
    texts += [t[:20] + b"x" + t[20:] for t in texts[:5]]
    table = pa.table({"sid": [str(k) for k in range(len(texts))], "b": pa.array(texts, pa.binary()), "n": pa.array([len(t) for t in texts], pa.int32())})
    asked = []
    plain = edit_join.edit_distances
    monkeypatch.setattr(edit_join, "edit_distances", lambda a, b: asked.append(len(a)) or plain(a, b))
    got = {frozenset((a, b)) for batch in edit_join._compare(0.7)(table, table, True) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
    assert {frozenset((str(k), str(200 + k))) for k in range(5)} <= got
    assert sum(asked) < len(texts) ** 2 / 100


def test_a_small_side_meets_rows_where_they_are(spark, monkeypatch):
    texts = [f"{a} {b} {c}" for a in ("red stone", "blue river", "green cloud") for b in ("falls down", "is slow") for c in ("today", "at night", "again and again")]
    d = spark.createDataFrame([(i, t + ". " + texts[i * 5 % len(texts)] + "x. ab.") for i, t in enumerate(texts)], "doc_id long, text string")
    other = d.where("doc_id % 3 = 0")
    left, right = (jobs.Corpus.of(x).distinct for x in (d, other))
    runs = []
    for small in (4 << 20, -1):
        monkeypatch.setattr(grid, "SMALL", small)
        edit, jaccard = edit_join.similar_edit_pairs_rs(left, right), jaccard_join.similar_jaccard_pairs_rs(left, right)
        assert ("Exchange" in edit._jdf.queryExecution().executedPlan().toString()) == (small < 0)
        scores = jobs.compare_corpora(d, other)
        runs.append([sorted(map(tuple, x.collect())) for x in (edit, jaccard, scores)])
    assert runs[0] == runs[1] and all(map(len, runs[0]))
    sets = (set_arrays(x, ["sid"]) for x in (left, right))
    assert runs[0][1] == sorted(map(tuple, jaccard_join.similar_jaccard_pairs_rs(*sets).collect()))


def test_band_candidates_get_few_distances(monkeypatch):
    """Candidates of a band that pass the bounds of lengths and histograms had their distance computed, all of them."""
    r = random.Random(6)
    words = ["anon", "the", "ing", "ere", "tion", "ed", "hat", "ly", "wh", "is"]
    texts = ["".join(r.choice(words) + " " for _ in range(14)).encode() for _ in range(150)]
    texts += [t[:20] + b"x" + t[20:] for t in texts[:5]]
    asked = []
    plain = edit_join.edit_distances
    monkeypatch.setattr(edit_join, "edit_distances", lambda a, b: asked.append(len(a)) or plain(a, b))
    i, j = np.triu_indices(len(texts), 1)
    got = {(a, b) for x, y, _ in edit_join.edit_test(0.7)(pa.array(texts, pa.binary()))(i, j) for a, b in zip(x.tolist(), y.tolist())}
    similar = plain(pa.array([texts[a] for a in i], pa.binary()), pa.array([texts[b] for b in j], pa.binary()))
    longest = np.maximum(*(np.array([len(texts[x]) for x in side]) for side in (i, j)))
    assert got == {(a, b) for a, b, d, m in zip(i.tolist(), j.tolist(), similar.tolist(), longest.tolist()) if 1.0 - d / m >= 0.7}
    assert {(k, 150 + k) for k in range(5)} <= got and sum(asked) < len(i) / 50
