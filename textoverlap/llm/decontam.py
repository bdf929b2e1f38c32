"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity.

For a benchmark item of m words, every window of m words of a document (the whole document where that is shorter) is
a candidate place of the item. Windows and items have a 64-bit SimHash of their shingles (five words, A-Z lowered;
a text with fewer words is one shingle). The fingerprint is cut into eight blocks; two that differ in at most
``radius`` bits have a block in which they differ in at most ``radius // 8``, so an index from block values to all
items with a value that close finds every fingerprint within the radius. Candidates within the radius are verified
by the exact weighted similarity: sum of the smaller over sum of the larger shingle counts, at least 0.8.

Only windows that share a shingle with an item of their size are fingerprinted: without one the similarity is 0, so
nothing is lost, and most texts cost one look-up a word. The default radius of 23 bits is 4 standard deviations above
the distance expected at similarity 0.8.

The benchmark is the stated query set. It is cut by a hash into parts of at most ``part_bytes`` of text, each sent to
the workers for a pass of its own, so memory does not follow its size.

Defined cases: null and blank texts (of documents or items) hold nothing and match nothing; repeated rows are
judged alike; equal items are each reported; empty tables give empty results; further columns stay or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.tokens import chunks, prefix, spans_hash, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
PART_BYTES = 8 << 20
BLOCKS = 8  # of eight bits
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(h).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _fingerprints(shingles: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """SimHash bytes (n x 8) of the shingle spans [lo, hi); a bit is set if it is set in over half of them."""
    sums = np.zeros((len(shingles) + 1, 64), dtype=np.int32)
    np.cumsum(_bits(shingles), axis=0, out=sums[1:])
    return np.packbits((sums[hi] - sums[lo]) * 2 > (hi - lo)[:, None], axis=1)


def _similarity(a: dict, b: dict) -> float:
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def _counts(shingles: np.ndarray) -> dict:
    s, n = np.unique(shingles, return_counts=True)
    return dict(zip(s.tolist(), n.tolist()))


class Items:
    """Index of benchmark items: shingles by size, block tables by size."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, radius: int):
        self.shingle, self.radius, self.by_size = shingle, radius, {}
        grouped: dict[int, list] = {}
        for item_id, text in items:
            for _, _, buf, off in chunks(pa.array([text or ""], pa.string()), lower=True):
                starts, ends, _ = words(buf, off)
                m = len(starts)
                if m:
                    pre = prefix(word_hashes(buf, starts, ends))
                    at = np.arange(max(1, m - shingle + 1))
                    s = spans_hash(pre, at, np.minimum(at + shingle, m))
                    grouped.setdefault(m, []).append((item_id, s, _counts(s)))
        near = _POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)] <= radius // BLOCKS
        for m, found in grouped.items():
            fp = np.concatenate([_fingerprints(s, np.array([0]), np.array([len(s)])) for _, s, _ in found])
            # tables[b][v]: the items whose block b is within radius // BLOCKS bits of v
            self.by_size[m] = (fp, [near[:, fp[:, b]] for b in range(BLOCKS)], found)
        parts = [(np.unique(np.concatenate([s for _, s, _ in found])), m) for m, (_, _, found) in sorted(self.by_size.items())]
        every = np.concatenate([s for s, _ in parts]) if parts else np.zeros(0, dtype=np.uint64)
        size = np.concatenate([np.full(len(s), m) for s, m in parts]) if parts else np.zeros(0, dtype=np.int64)
        order = np.argsort(every, kind="stable")
        self.shingles, self.sizes = every[order], size[order]
        self.lengths = sorted({min(shingle, m) for m in self.by_size} | {shingle})

    def candidates(self, m: int, fp: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of all window fingerprints and items of m words within the radius."""
        own, tables, _ = self.by_size[m]
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            hit = reduce(np.logical_or, (t[part[:, b]] for b, t in enumerate(tables)))
            w, i = np.nonzero(hit)
            d = _POPCOUNT[part[w] ^ own[i]].sum(axis=1)
            for k in np.flatnonzero(d <= self.radius):
                yield at + int(w[k]), int(i[k]), int(d[k])

    def search(self, pre: np.ndarray, lo: int, hi: int, similarity: float, at: np.ndarray, size: np.ndarray) -> Iterator[tuple]:
        """(item_id, window start, words, distance, similarity, windows) of the best window per item in the document
        [lo, hi); ``at``, ``size``: places of shingles shared with items of that size."""
        n = hi - lo
        for m in np.unique(size).tolist():
            width = min(m, n)
            length = min(self.shingle, width)
            many = width - length + 1  # shingles in a window
            place = np.unique(at[size == m])
            start = np.unique(np.clip(place[:, None] - np.arange(many), 0, n - width))
            base = int(start[0])
            k = np.arange(base, int(start[-1]) + many)
            s = spans_hash(pre, lo + k, lo + k + length)
            fp = _fingerprints(s, start - base, start - base + many)
            best: dict[int, tuple] = {}
            found = self.by_size[m][2]
            counted: dict[int, dict] = {}
            for w, i, d in self.candidates(m, fp):
                x = int(start[w])
                if x not in counted:
                    counted[x] = _counts(s[x - base:x - base + many])
                sim = _similarity(counted[x], found[i][2])
                if sim >= similarity:
                    old = best.get(i)
                    windows = 1 + (old[4] if old else 0)
                    new = (x, width, d, sim, windows)
                    best[i] = new if old is None or sim > old[3] else (*old[:4], windows)
            for i, row in best.items():
                yield (found[i][0], *row)


def matches(docs: DataFrame, benchmark: DataFrame, keys: list[Column], schema: str, similarity: float = SIMILARITY,
            shingle: int = SHINGLE, radius: int = RADIUS, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document row and item with a window of at least ``similarity``: ``keys`` (with the given schema),
    ``item_id``, the best window (first of equals) as ``window_start`` and ``window_words``, its Hamming
    ``distance`` and ``similarity``, and ``n_windows``, the number of windows that verified."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    size = bench.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64).alias("b")).first()["b"] or 0
    parts = max(1, -(-size // (part_bytes // 2)))
    ddl = schema + ", item_id long, window_start int, window_words int, distance int, similarity double, n_windows int"
    names = [f.strip().split(" ")[0] for f in ddl.split(",")]
    n_keys = len(keys)
    found = []
    for p in range(parts):
        own = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) if parts > 1 else bench
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.collect()])  # about part_bytes / 2

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value, shingle, radius)
            for batch in batches:
                for lo, hi, buf, off in chunks(batch.column(n_keys), lower=True):
                    if not len(items.shingles):
                        break
                    starts, ends, woff = words(buf, off)
                    pre = prefix(word_hashes(buf, starts, ends))
                    doc = np.repeat(np.arange(hi - lo), np.diff(woff))
                    # shingles at every word that has enough after it, and the whole of short texts; items of fewer
                    # words than a shingle have shingles of their own size
                    every = [(np.arange(len(starts)), size) for size in items.lengths]
                    every = [(at[at + size <= woff[doc[at] + 1]], size) for at, size in every]
                    short = np.flatnonzero(np.diff(woff) < shingle)
                    short = short[np.diff(woff)[short] > 0]
                    at = np.concatenate([*(at for at, _ in every), woff[short]])
                    s = spans_hash(pre, at, np.concatenate([*(at + size for at, size in every), woff[short + 1]]))
                    left = np.searchsorted(items.shingles, s, side="left")
                    shared = np.flatnonzero(items.shingles[np.minimum(left, len(items.shingles) - 1)] == s)
                    if not len(shared):
                        continue
                    right = np.searchsorted(items.shingles, s[shared], side="right")
                    many = right - left[shared]
                    place = np.repeat(at[shared], many)
                    size = items.sizes[np.repeat(left[shared] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    rows, who = [], []
                    owner = doc[place]
                    for d in np.unique(owner).tolist():
                        on = owner == d
                        for row in items.search(pre, int(woff[d]), int(woff[d + 1]), similarity, place[on] - woff[d], size[on]):
                            rows.append(row)
                            who.append(lo + d)
                    if rows:
                        take = pa.array(who)
                        cols = list(zip(*rows))
                        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
                        values = [pa.array(cols[j], k) for j, k in zip((0, 1, 2, 3, 4, 5), kinds)]
                        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(n_keys)), *values], names=names)

        found.append(docs.select(*keys, F.col("text").alias("__text")).mapInArrow(run, ddl))
    return reduce(DataFrame.union, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found; all columns stay as they are.

    Rows are known by doc_id and a hash of the text (null doc_ids by the text alone).
    """
    no_id = F.lit(-(1 << 63))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"),
                        F.coalesce(docs["doc_id"].cast("long"), no_id).alias("id"),
                        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("th"))
    bad = matches(keyed, benchmark, [F.col("id"), F.col("th")], "id long, th long", **how).select("id", "th")
    return keyed.drop("text").join(bad, ["id", "th"], "left_anti").select("row.*")
