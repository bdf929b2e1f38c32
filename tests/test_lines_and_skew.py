"""Cosine listing of grouped lines, the salted join, row-local sets and the report sinks against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from test_operators import docs, fixture_sentences, shingle_set
from test_pair_scores import plain_cosine, plain_dense
from textoverlap.operators import banded_join, line_cosine
from textoverlap.operators.blocking import salted_join
from textoverlap.operators.report import cosine_lines
from textoverlap.operators.shingles import set_arrays, shingle_stats, shingles
from textoverlap.operators.signatures import permutation_coefficients


def plain_listing(lines, t):
    groups = {}
    for g, n, text in lines:
        if g is not None and n is not None and text is not None:
            x = "".join(c.lower() if c.isascii() else c for c in text)
            groups.setdefault(g, {})[n] = (x[1:] if x.startswith(" ") else x).encode()
    out = {}
    for g, own in groups.items():
        order = sorted(own)
        v = plain_dense([own[n] for n in order])
        for i, a in enumerate(order):
            for j in range(i + 1, len(order)):
                c = plain_cosine(v[i], v[j])
                if c >= t:
                    out[(g, a, order[j])] = c
    return out


@pytest.mark.parametrize("block,rows", [(2, 3), (128, 2048)])
def test_line_cosine_equals_plain_version(spark, monkeypatch, block, rows):
    """One hot group, groups of one line, short and empty lines, nulls; blocks of two lines and whole groups."""
    monkeypatch.setattr(line_cosine, "BLOCK", block)
    rnd = random.Random(4)
    base = fixture_sentences(40, 4)
    lines = [(7, i, rnd.choice(base)) for i in range(25)] + [(g, i * 2, " " + rnd.choice(base)) for g in range(4) for i in range(rnd.randrange(1, 5))]
    lines += [(9, 0, "ab"), (9, 1, ""), (9, 2, "ABCAB"), (9, 3, "abcab"), (None, 1, "abcdef"), (9, None, "abcdef"), (9, 4, None)]
    df = spark.createDataFrame(lines, "grp long, line long, text string").withColumn("n", F.lit("clash")).repartition(3)
    got = {(r.grp, r.line_a, r.line_b): r.cosine for r in line_cosine.similar_lines_cosine(df, 0.8, block_rows=rows).collect()}
    assert got == pytest.approx(plain_listing(lines, 0.8), rel=1e-12) and len(got) > 50
    assert line_cosine.similar_lines_cosine(df.limit(0)).count() == 0


def test_cosine_line_text(spark):
    r = cosine_lines(spark.createDataFrame([(1, 2, 0.12345650000000001)], "line_a long, line_b long, cosine double")).first()
    assert r.line == "Cosine Similarity between Sentence 1 and 2 is %f." % 0.12345650000000001


def test_salted_join_deals_a_hot_key_out(spark):
    """A third of all rows have one key: the same rows as a plain join, and no task with more than a few blocks of it."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("code"), F.col("id").alias("doc_id"))
    table = spark.range(-1, 500).select(F.col("id").alias("code"), (F.col("id") * 7).alias("vid"))
    joined = salted_join(rows, table, ["code"], "doc_id", 100)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, rows.join(table, "code").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain, salted = largest(rows.join(table, "code").where("vid IS NOT NULL")), largest(salted_join(rows, table, ["code"], "doc_id", 100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain > 3000 and salted < 1500


def test_sets_are_made_without_a_shuffle(spark):
    texts = fixture_sentences(60, 2) + ["", "ab", "é", "x" * 5000]
    d = docs(spark, texts).withColumnRenamed("doc_id", "sid")
    got = {r.sid: r["set"] for r in set_arrays(d, ["sid"]).collect()}
    assert got == {i: sorted(int.from_bytes(x, "big") for x in shingle_set(t)) for i, t in enumerate(texts) if shingle_set(t)}
    stats = {r.sid: (r.n_shingles, r.n_set_exact, r.n_set_weighted) for r in shingle_stats(d, ["sid"]).collect()}
    for i, t in enumerate(texts):
        b = t.encode()
        own = [b[k:k + 3] for k in range(len(b) - 2)]
        assert stats[i] == (len(own), len(set(own)), len({sum(c * (n + 1) for n, c in enumerate(x)) for x in own}))
    by_rows = {r.sid: r.n for r in shingles(d, ["sid"]).groupBy("sid").agg(F.count_distinct("weight").alias("n")).collect()}
    assert by_rows == {k: v[2] for k, v in stats.items() if v[0]}
    for df in (set_arrays(d, ["sid"]), shingle_stats(d, ["sid"])):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_band_keys_are_equal_where_bands_are(spark, monkeypatch):
    monkeypatch.setattr(banded_join, "ROWS", 7)
    monkeypatch.setattr(banded_join, "RANKS", 1000)
    d = docs(spark, fixture_sentences(80, 6)).withColumn("n_bytes", F.octet_length("text"))
    sets = set_arrays(d.withColumn("sid", F.col("doc_id").cast("string")), ["sid", "n_bytes"])
    perms = permutation_coefficients(20, 3)
    want = {}
    for r in sets.collect():
        sig = [min((a * c + b) % 2147483647 for c in r["set"]) for _, a, b in perms]
        for band in range(4):
            want.setdefault((band, tuple(sig[band * 5:band * 5 + 5])), set()).add(r.sid)
    got = {}
    for r in banded_join.band_keys(sets, 20, 3, 4, 5).collect():
        got.setdefault(r.key, set()).add(r.sid)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
