"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found with a dictionary of
trie-node pairs.

The words stand in two tries: by their prefixes and, reversed, by their suffixes. Every node has a number. A word of
length L holds a node of each prefix and of each suffix, so a place i in it is a pair of integers: (prefix before i, suffix
from i), or, with the code point at i skipped, (prefix before i, suffix after i). Two words are near exactly if

* their skipped pairs agree at one place (one code point replaced), or
* a skipped pair of the longer is a whole pair of the shorter (one inserted). Of a run of equal code points only the first
  is skipped for this, so each near pair meets in exactly one integer pair.

A pair of nodes fixes the text around the skipped place, so its group holds at most one word a code point of the alphabet and one
whole word: groups are small whatever the words, and each member's near words are counted and ranked in the group,
without a row for every pair.

Numbering: words are range-partitioned in code-point order and written, so ranges stay as they are when a task runs again. In
a range a word's nodes are those of its predecessor up to their common prefix, and new ones after it. The prefixes
that run over a border between ranges are known from the ranges' first and last words (one row a range goes to the driver) and
are numbered there.

Defined cases: null words and null counts take no part; a repeated word counts once with the sum of its counts; ties in a
form go to the smallest word in code-point order; an empty table gives an empty result; empty words have no near word
but words of one code point; further columns are ignored. Very long words give rows in proportion to their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize

RANGE_WORDS = 50_000
RATIO = 5
WHOLE, FIRST, LATER = 0, 1, 2  # a whole pair; a skipped pair, at the first of a run of equal code points or not
_LOCAL = 40  # bits of a node's number within its range


def corpus_words(docs: DataFrame, run: str, least_length: int, least_count: int, changed) -> DataFrame:
    """``word, n``: runs of the code points ``run`` (a regular expression's class), A-Z lower-cased, put through ``changed``,
    of at least ``least_length`` code points and ``least_count`` occurrences in all texts.

    ``changed(doc_id, word)`` is a column that is never longer than the word, so shorter runs are not built at all.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"({run}{{{least_length},}})"), F.lit(1))
    one = docs.select(F.col("doc_id").alias("d"), F.explode(runs).alias("w"))
    one = one.select("d", F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("w"))
    words = one.select(changed(F.col("d"), F.col("w")).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def _ranged(words: DataFrame, by: Column, range_words: int, name: str):
    """``words`` in written ranges of ``key`` = ``by``, and per range its number, first key, last key and row count, in order."""
    n = max(1, -(-words.count() // range_words))
    out = words.withColumn("key", by).repartitionByRange(n, "key").withColumn("range", F.spark_partition_id())
    out = materialize(out, name)
    bounds = out.groupBy("range").agg(F.min("key").alias("a"), F.max("key").alias("z"), F.count(F.lit(1)).alias("n"))
    return out, sorted((r["a"], r["z"], r["range"], r["n"]) for r in bounds.collect())  # one row a range


def _borders(bounds) -> dict[str, int]:
    """Numbers of the prefixes that words of two or more ranges share."""
    out = {"": 0}
    for (_, z, _, _), (a, _, _, _) in zip(bounds, bounds[1:]):
        for i in range(1, common_prefix(z, a) + 1):
            out.setdefault(a[:i], len(out))
    return out


def number_nodes(keys: list[str], number: int, borders: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """``(nodes, offsets)``: key k, in sorted order, has the nodes of its prefixes of 0, 1, .. code points at
    ``nodes[offsets[k]:offsets[k + 1]]``. ``number``: of the range, from 1."""
    near = max((len(x) for k in (keys[:1] + keys[-1:]) for x in [_shared(k, borders)]), default=0)
    out, sizes, path, last, fresh = [], [], [0], "", (number << _LOCAL)
    for key in keys:
        same = common_prefix(last, key)
        del path[same + 1:]
        for i in range(same + 1, len(key) + 1):
            own = borders.get(key[:i]) if i <= near else None
            if own is None:
                own, fresh = fresh, fresh + 1
            path.append(own)
        out += path
        sizes.append(len(path))
        last = key
    return np.array(out, dtype=np.int64), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)


def _shared(key: str, borders: dict[str, int]) -> str:
    """The longest prefix of ``key`` that crosses a border."""
    n = 0
    while n < len(key) and key[:n + 1] in borders:
        n += 1
    return key[:n]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(pa.list_(pa.int64()))


def node_pairs(words: DataFrame, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """``id, word, n`` with ``id`` counting the words in code-point order, and ``prefix, suffix, kind, id, n``: every place of
    every word as a pair of nodes."""
    words, bounds = _ranged(words.select("word", "n"), F.col("word"), range_words, "forward_ranges")
    borders, starts, at = _borders(bounds), {}, 0
    for k, (_, _, own, n) in enumerate(bounds):
        starts[own], at = (k + 1, at), at + n

    def forward(part: pa.Table) -> pa.Table:
        part = part.sort_by("key")
        number, first = starts[part.column("range")[0].as_py()]
        keys = part.column("key").to_pylist()
        nodes, offsets = number_nodes(keys, number, borders)
        ids = pa.array(np.arange(first, first + len(keys), dtype=np.int64))
        return pa.table({"word": part.column("word"), "n": part.column("n"), "id": ids, "nodes": _lists(nodes, offsets)})

    schema = "word string, n long, id long, nodes array<bigint>"
    ahead = materialize(words.groupBy("range").applyInArrow(forward, schema), "forward_nodes")
    back, bounds_b = _ranged(ahead, F.reverse("word"), range_words, "backward_ranges")
    borders_b = _borders(bounds_b)
    numbers = {own: k + 1 for k, (_, _, own, _) in enumerate(bounds_b)}

    def backward(part: pa.Table) -> pa.Table:
        part = part.sort_by("key").combine_chunks()
        keys = part.column("key").to_pylist()
        nodes, offsets = number_nodes(keys, numbers[part.column("range")[0].as_py()], borders_b)
        size = np.diff(offsets)
        prefix = part.column("nodes").combine_chunks().flatten().to_numpy()
        word = np.repeat(np.arange(len(keys)), size)
        place = np.arange(len(nodes)) - np.repeat(offsets[:-1], size)
        suffix = nodes[np.repeat(offsets[1:] - 1, size) - place]  # of the text from each place on
        ids, counts = part.column("id").to_numpy(), part.column("n").to_numpy()
        inner = np.flatnonzero(place < np.repeat(size - 1, size))
        points = np.frombuffer("".join(k[::-1] for k in keys).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        run = np.ones(len(points), dtype=bool)
        run[1:] = points[1:] != points[:-1]
        run |= place[inner] == 0
        kind = np.concatenate([np.full(len(nodes), WHOLE), np.where(run, FIRST, LATER)]).astype(np.int8)
        own = np.concatenate([word, word[inner]])
        return pa.table({"prefix": np.concatenate([prefix, prefix[inner]]), "suffix": np.concatenate([suffix, suffix[inner + 1]]),
                         "kind": kind, "id": ids[own], "n": counts[own]})

    pairs = back.groupBy("range").applyInArrow(backward, "prefix long, suffix long, kind byte, id long, n long")
    return ahead.select("id", "word", "n"), pairs


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best``: number of near words and (n, -id) of the one with the largest n, the smallest id among equals."""
    groups = (pairs.groupBy("prefix", "suffix").agg(F.collect_list(F.struct("kind", "id", "n")).alias("m"))  # at most one a code point, and one
              .where(F.size("m") > 1))
    skipped = lambda x: x["kind"] != WHOLE

    def near(x, y):
        one = (skipped(x) & skipped(y)) | ((x["kind"] == WHOLE) & (y["kind"] == FIRST)) | ((x["kind"] == FIRST) & (y["kind"] == WHOLE))
        return one & (x["id"] != y["id"])

    def seen(x):
        others = F.filter("m", lambda y: near(x, y))
        return F.struct(x["id"].alias("id"), F.size(others).alias("c"),
                        F.array_max(F.transform(others, lambda y: F.struct(y["n"].alias("n"), (-y["id"]).alias("before")))).alias("best"))

    one = groups.select(F.explode(F.transform("m", seen)).alias("s")).where("s.c > 0")
    return one.groupBy("s.id").agg(F.sum("s.c").alias("n_near"), F.max("s.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``id, root`` from ``id, to`` without cycles: each round doubles the way, so their number is the logarithm of the
    longest chain (a form has several times its word's count, so chains are short)."""
    now = links
    while True:
        onward = now.select(F.col("id").alias("to"), F.col("to").alias("next"))
        moved = materialize(now.join(onward, "to", "left"), "links")
        if moved.where("next IS NOT NULL").isEmpty():
            return now.select("id", F.col("to").alias("root"))
        now = moved.select("id", F.coalesce("next", "to").alias("to"))


def variants(words: DataFrame, ratio: int = RATIO, range_words: int = RANGE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``word, n``: the form is the near word of largest count if that is at least
    ``ratio`` (over 1) times the word's own; the root is the end of the chain of forms."""
    clean = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    numbered, pairs = node_pairs(materialize(clean, "words"), range_words)
    own = numbered.join(near_words(pairs), "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.n").alias("n"), (-F.col("best.before")).alias("id"))).alias("form"))
    own = materialize(own, "forms")
    ends = roots(own.where("form IS NOT NULL").select("id", F.col("form.id").alias("to")))
    names = numbered.select(F.col("id").alias("of"), F.col("word").alias("name"))
    linked = (own.where("form IS NOT NULL").join(ends, "id")
              .join(names.withColumnsRenamed({"of": "fid", "name": "form_word"}), F.col("form.id") == F.col("fid"))
              .join(names.withColumnsRenamed({"of": "rid", "name": "root_word"}), F.col("root") == F.col("rid"))
              .select("id", "form_word", "root_word"))
    return (own.join(linked, "id", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.col("form.n").alias("form_n")))
