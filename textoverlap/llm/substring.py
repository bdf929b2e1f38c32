"""Repeated passages across and within documents: seed and extend.

A passage repeats if ``length`` consecutive words (default 20) start earlier too: in a document with a smaller
doc_id, or earlier in the same one. Every word of a later occurrence is removed.

Seed: winnowing picks, for every window of ``length`` words, the rightmost smallest hash among its runs of
``seed`` words as the window's anchor. The choice depends on the window's words alone, so two equal windows have
the same anchor at the same place, and one anchor serves a run of neighbouring windows.

Extend: an anchor is extended both ways to its context, all words of all windows it serves. Occurrences whose
anchor is unique in the corpus are dropped. Occurrences with equal contexts form a class: all but its first
repeat over the whole context, and only the first goes on. Where an anchor has several contexts (the ends of a
maximal repeat), the first occurrences are extended word by word: their windows are compared one by one. The
union of the windows found is the set of maximal repeats of at least ``length`` words.

No step pairs occurrences: a passage shared by a third of all documents is one class whose first occurrence is
an aggregate, and the joins of occurrences with their anchor and class deal out keys of over ``HOT_ROWS`` rows. Hashes of anchor and context, or anchor and window, together have 128 bits.

Defined cases: null and blank texts have no words and nothing is removed; texts under ``length`` words are kept;
rows that repeat a doc_id with the same text are one document and judged alike; with different texts (or null
ids, which come last) they are ordered by a hash of the text; extra columns are ignored; empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize
from textoverlap.llm.tokens import chunks, prefix, spans_hash, word_hashes, words
from textoverlap.operators.blocking import salted_join

LENGTH = 20
SEED = 5
HOT_ROWS = 1 << 14  # occurrences of an anchor or a class from which they are dealt out over several tasks
_SHIFT = 24  # low bits of an anchor's rank give its place, so that the rightmost of equal hashes wins


def _anchors(hashes: np.ndarray, woff: np.ndarray, length: int, seed: int):
    """For the words of several documents: (prefix sums, windows' first words, their anchors' places, anchor hashes)."""
    pre = prefix(hashes)
    n = len(hashes)
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return pre, none, none, np.zeros(0, dtype=np.uint64)
    at = np.arange(n - seed + 1)
    seeds = spans_hash(pre, at, at + seed)
    width = length - seed + 1
    if n >= 1 << _SHIFT:  # one text of over 16 million words: ranks with full places
        view = np.lib.stride_tricks.sliding_window_view(seeds >> np.uint64(_SHIFT), width)
        place = np.concatenate([width - 1 - np.argmin(view[i:i + (1 << 20), ::-1], axis=1)
                                for i in range(0, len(view), 1 << 20)]) + np.arange(len(view))
    else:
        low = np.uint64((1 << _SHIFT) - 1)
        rank = (seeds & ~low) | (low - at.astype(np.uint64))
        best, have = rank, 1
        while have < width:  # minimum over ``width`` neighbours by doubling
            step = min(have, width - have)
            best = np.minimum(best[:len(best) - step], best[step:])
            have += step
        place = (low - (best & low)).astype(np.int64)
    count = np.diff(woff)
    ok = np.zeros(n + 1, dtype=np.int64)
    long = count >= length
    np.add.at(ok, woff[:-1][long], 1)
    np.add.at(ok, woff[1:][long] - length + 1, -1)
    first = np.flatnonzero(np.cumsum(ok)[:n - length + 1] > 0)
    return pre, first, place[first], seeds


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), type=pa.int64())


_SEEDS = "a long, c long, id long, th long, lo int, n int"


def _seeds(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """One row per anchor occurrence: anchor and context hash, document, first window, number of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, _, buf, off in chunks(batch.column(2)):
                starts, ends, woff = words(buf, off)
                pre, first, place, seeds = _anchors(word_hashes(buf, starts, ends), woff, length, seed)
                if not len(first):
                    continue
                new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                begin, last = first[new], first[np.concatenate((new[1:], [len(first)])) - 1]
                doc = np.searchsorted(woff, begin, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [_signed(seeds[place[new]]), _signed(spans_hash(pre, begin, last + length)),
                     pa.array(ids[lo + doc]), pa.array(ths[lo + doc]),
                     pa.array((begin - woff[doc]).astype(np.int32)), pa.array((last - begin + 1).astype(np.int32))],
                    names=["a", "c", "id", "th", "lo", "n"])

    return docs.select("id", "th", "text").mapInArrow(run, _SEEDS)


def _apply(raw: str | None, runs: list | None, length: int) -> tuple[int, int, bytes]:
    """(number of words, number removed, the words that stay) of a text and its runs of repeated windows."""
    w = raw.encode().split() if raw else []
    if not runs:
        return len(w), 0, b" ".join(w)
    mark = np.zeros(len(w) + 1, dtype=np.int64)
    lo = np.array([r["lo"] for r in runs])
    np.add.at(mark, lo, 1)
    np.add.at(mark, lo + np.array([r["n"] for r in runs]) - 1 + length, -1)
    kept = [x for x, covered in zip(w, np.cumsum(mark)[:-1].tolist()) if not covered]
    return len(w), len(w) - len(kept), b" ".join(kept)


def _window_hashes(raw: str, ends: list, length: int, seed: int) -> list[dict]:
    """Anchor and window hash of every window of the contexts in ``ends``."""
    _, _, buf, off = next(chunks(pa.array([raw])))
    starts, stops, woff = words(buf, off)
    pre, first, place, seeds = _anchors(word_hashes(buf, starts, stops), woff, length, seed)
    pick = np.concatenate([np.arange(r["lo"], r["lo"] + r["n"]) for r in ends])  # in one document window i is the ith
    a, w = seeds[place[pick]].view(np.int64), spans_hash(pre, pick, pick + length).view(np.int64)
    return [{"a": x, "w": y, "lo": z} for x, y, z in zip(a.tolist(), w.tolist(), pick.tolist())]


_STEP = ("doc_id long, id long, th long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
         "text string, runs array<struct<lo:int,n:int>>, windows array<struct<a:long,w:long,lo:int>>")


def _step(joined: DataFrame, length: int, seed: int, texts: bool) -> DataFrame:
    """Results of documents whose runs are known; text, runs and windows of those that hold ends of repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(part, 256).to_pylist():
                    out = {k: r[k] for k in ("doc_id", "id", "th")}
                    if r["ends"]:
                        out |= {"text": r["text"], "runs": r["runs"],
                                "windows": _window_hashes(r["text"], r["ends"], length, seed)}
                    else:
                        n, gone, line = _apply(r["text"], r["runs"], length)
                        out |= {"n_words": n, "n_removed": gone, "kept_sha256": hashlib.sha256(line).hexdigest(),
                                "kept_text": line.decode() if texts else None}
                    rows.append(out)
                schema = schema or _arrow(_STEP)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return joined.select("doc_id", "id", "th", "text", "runs", "ends").mapInArrow(run, _STEP)


def _arrow(ddl: str) -> pa.Schema:
    spans = {"array<struct<lo:int,n:int>>": pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())])),
             "array<struct<a:long,w:long,lo:int>>": pa.list_(pa.struct([("a", pa.int64()), ("w", pa.int64()), ("lo", pa.int32())])),
             "long": pa.int64(), "string": pa.string()}
    return pa.schema([(f.split(" ", 1)[0], spans[f.split(" ", 1)[1]]) for f in ddl.split(", ")])


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _finish(joined: DataFrame, length: int, texts: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_RESULT)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n, gone, line = _apply(r["text"], (r["runs"] or []) + (r["more"] or []), length)
                rows.append({"doc_id": r["doc_id"], "n_words": n, "n_removed": gone, "kept_text": line.decode() if texts else None,
                             "kept_sha256": hashlib.sha256(line).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return joined.select("doc_id", "text", "runs", "more").mapInArrow(run, _RESULT)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, texts: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` per row of ``docs``.

    ``kept_text``: the words that stay, joined by one space (null unless ``texts``); ``kept_sha256``: SHA-256
    of it in UTF-8.
    """
    if not 0 < seed <= length:
        raise ValueError("seed must be between 1 and length")
    same = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    # ids that stand for several texts need the text's hash beside them; else it is 0, which costs nothing
    ids = same.groupBy("id").agg(F.min(th).alias("x"), F.max(th).alias("y"))
    several = ids.agg(F.max((F.col("x") != F.col("y")) | F.col("id").isNull()).alias("s")).first()["s"] or False
    keyed = same.select(F.col("id").alias("doc_id"), F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"),
                        (th if several else F.lit(0).cast("long")).alias("th"), "text")
    found = _seeds(keyed, length, seed)
    often = materialize(found.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    found = materialize(salted_join(found, often.select("a"), ["a"], "id", HOT_ROWS, often), "repeated_anchors")
    first = F.struct("id", "th", "lo")
    classes = found.groupBy("a", "c").agg(F.min(first).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("k"))
    classes = materialize(classes, "contexts")
    several_times = classes.where("k > 1").select("a", "c", "first", "k")
    later = (salted_join(found, several_times.drop("k"), ["a", "c"], "id", HOT_ROWS, several_times.withColumnRenamed("k", "n"))
             .where(first != F.col("first")).select("id", "th", "lo", "n"))
    varied = classes.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("a")
    ends = classes.join(varied, "a").select("first.id", "first.th", "first.lo", "n")
    span = F.struct("lo", "n")
    spans = (later.withColumn("end", F.lit(False)).union(ends.withColumn("end", F.lit(True)))
             .groupBy("id", "th").agg(F.collect_set(F.when(~F.col("end"), span)).alias("runs"),  # at most a document's words
                                      F.collect_set(F.when(F.col("end"), span)).alias("ends")))
    step = materialize(_step(keyed.join(spans, ["id", "th"], "left"), length, seed, texts), "substring_step")
    window = step.select("id", "th", F.explode("windows").alias("w")).select("id", "th", "w.a", "w.w", "w.lo")
    start = window.groupBy("a", "w").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
    more = (window.join(start.select("a", "w", "first"), ["a", "w"]).where(first != F.col("first"))
            .groupBy("id", "th").agg(F.collect_set(F.struct("lo", F.lit(1).alias("n"))).alias("more")))
    rest = step.where(F.col("windows").isNotNull()).select("doc_id", "id", "th", "text", "runs")
    done = step.where(F.col("windows").isNull()).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    return done.union(_finish(rest.join(more, ["id", "th"], "left"), length, texts))
