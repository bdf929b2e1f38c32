"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays in the shared
folder, memory-mapped by the workers that score.

Tokens of a text: its words with A-Z lowered, then one end. Training texts are read twice: word hashes are counted,
dealt out by hash range and written as sorted pieces (a word's id is its rank), then pairs of ids are counted, dealt
out by their first word (very frequent first words by both) and written as sorted pieces. Counts are combined in
each task before they are shuffled, so a frequent word or pair costs one row a task. The number of pieces follows the
input's bytes, and so a task's memory does not. A piece is written to a temporary name and renamed, so a task that
runs again replaces it by the same content.

    P(w | v) = (c(v w) - D(c(v w))) / c(v) + g(v) P(w)        P(w) = (n(* w) - D'(n(* w))) / n(* *) + g' / (V + 1)

with the three discounts of modified Kneser-Ney from the counts of counts, n(* w) the number of distinct words before
w, g(v) = (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v), and g = 1 for a first word that was never seen.

Defined cases: null is an empty text (the end alone); repeated rows count and are scored one by one; without
training texts every token has the probability 1 / (V + 1) = 1; very long texts are read in whole; an empty table gives an
empty result; further columns are ignored. A vocabulary of 2^32 - 1 words or more is refused (ids share a long in pairs), and a
file of the model that has gone is an error, not a count of 0.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize, shared_folder
from textoverlap.llm.tokens import chunks, mix, word_hashes, words

PIECE_BYTES = 16 << 20   # text per piece of the model
HELD = 1 << 20           # distinct keys that a task holds before it sends them on
HOT_SHARE = 256          # a first word with over 1 / HOT_SHARE of all tokens, or more than a piece's share of them, is dealt out by both words
MAX_WORDS = (1 << 32) - 1
_END = np.uint64(0x243F6A8885A308D3)  # hash that stands for the end


def _combine(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts[order], at)


def _counted(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys with counts, combined over a task as far as ``HELD`` allows."""
    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    wait, n = [], 0
    for part in parts:
        k, c = np.unique(part, return_counts=True)
        wait.append((k, c))
        n += len(k)
        if n >= HELD:
            keys, counts = _combine(np.concatenate([keys, *(k for k, _ in wait)]), np.concatenate([counts, *(c for _, c in wait)]))
            wait, n = [], 0
            if len(keys) >= HELD:
                yield keys, counts
                keys, counts = keys[:0], counts[:0]
    keys, counts = _combine(np.concatenate([keys, *(k for k, _ in wait)]), np.concatenate([counts, *(c for _, c in wait)]))
    if len(keys):
        yield keys, counts


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: (batch, first row, last row + 1, token hashes, token offsets per text); each text ends in _END."""
    for batch in batches:
        for lo, hi, buf, off in chunks(batch.column(batch.num_columns - 1), lower=True):
            starts, ends, woff = words(buf, off)
            h = word_hashes(buf, starts, ends)
            toff = woff + np.arange(len(woff))
            out = np.full(len(h) + len(woff) - 1, _END, dtype=np.uint64)
            inner = np.ones(len(out), dtype=bool)
            inner[toff[1:] - 1] = False
            out[inner] = h
            yield batch, lo, hi, out, toff


def _save(path: str, values: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, values)
    os.replace(part, path)


@lru_cache(maxsize=4096)
def _mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


def _rows(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)],
                                      names=["bucket", "key", "n"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All of a task's (bucket, sorted distinct keys, counts)."""
    got = [tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)) for batch in batches]
    if not got:
        return
    bucket, key, n = (np.concatenate(x) for x in zip(*got))
    del got
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield int(bucket[part[0]]), *_combine(key[part].view(np.uint64), n[part])


class Vocabulary:
    """Sorted word hashes and their counts in pieces by hash range; a word's id is its rank, -1 if unknown."""

    def __init__(self, folder: str, offsets: list[int]):
        self.folder, self.offsets = folder, offsets

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(len(self.offsets) - 1)) >> np.uint64(32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of sorted distinct hashes."""
        ids, counts = np.full(len(h), -1, dtype=np.int64), np.zeros(len(h), dtype=np.int64)
        at = np.searchsorted(self.bucket(h), np.arange(len(self.offsets)))
        for b, (i, j) in enumerate(zip(at, at[1:])):
            if i < j and self.offsets[b] < self.offsets[b + 1]:
                have = _mapped(f"{self.folder}/w{b}.npy")
                pos = np.minimum(np.searchsorted(have, h[i:j]), len(have) - 1)
                hit = have[pos] == h[i:j]
                ids[i:j][hit] = self.offsets[b] + pos[hit]
                counts[i:j][hit] = _mapped(f"{self.folder}/c{b}.npy")[pos[hit]]
        return ids, counts


def _vocabulary(train: DataFrame, folder: str, pieces: int) -> tuple[Vocabulary, int, list[int]]:
    split = Vocabulary(folder, [0] * (pieces + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _counted(h for _, _, _, h, _ in _tokens(batches)):
            yield _rows(split.bucket(keys), keys, n)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, keys, n in _by_bucket(batches):
            _save(f"{folder}/w{b}.npy", keys)
            _save(f"{folder}/c{b}.npy", n)
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([len(keys)]), pa.array([int(n.sum())])], names=["bucket", "size", "tokens"])

    done = (train.mapInArrow(count, "bucket int, key long, n long").repartitionById(pieces, F.col("bucket"))
            .mapInArrow(write, "bucket long, size long, tokens long"))
    found = {r["bucket"]: r for r in materialize(done, "lm_vocabulary").collect()}  # one row a piece
    offsets = np.concatenate(([0], np.cumsum([found[b]["size"] if b in found else 0 for b in range(pieces)]))).astype(np.int64).tolist()
    if offsets[-1] >= MAX_WORDS:
        raise ValueError(f"{offsets[-1]} distinct words: ids of pairs have room for {MAX_WORDS}")
    total, share = sum(r["tokens"] for r in found.values()), max(HOT_SHARE, pieces)
    written = [b for b in range(pieces) if b in found]

    def hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                place = np.flatnonzero(np.load(f"{folder}/c{written[i]}.npy", mmap_mode="r") * share > total)
                yield pa.RecordBatch.from_arrays([pa.array(offsets[written[i]] + place)], names=["id"])

    # fewer than ``share`` words have more than 1 / share of all tokens
    often = train.sparkSession.range(len(written)).mapInArrow(hot, "id long").collect() if written else []
    return Vocabulary(folder, offsets), total, sorted(r["id"] for r in often)


class Pairs:
    """Sorted keys ``first id << 32 | second id`` and their counts, in pieces by a hash of the first word."""

    def __init__(self, folder: str, pieces: int, hot: list[int]):
        self.folder, self.pieces, self.hot = folder, pieces, np.array(hot, dtype=np.uint64)
        self.written = np.zeros(pieces, dtype=bool)  # pieces that hold a pair at all

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        first = keys >> np.uint64(32)
        by = mix(np.where(np.isin(first, self.hot), keys, first + np.uint64(1 << 63)))
        return (by % np.uint64(self.pieces)).astype(np.int64)

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct keys, 0 where absent."""
        out = np.zeros(len(keys), dtype=np.int64)
        bucket = self.bucket(keys)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(part) and self.written[bucket[part[0]]]:
                have = _mapped(f"{self.folder}/p{bucket[part[0]]}.npy")  # an error if it has gone
                pos = np.minimum(np.searchsorted(have, keys[part]), len(have) - 1)
                hit = have[pos] == keys[part]
                out[part[hit]] = _mapped(f"{self.folder}/n{bucket[part[0]]}.npy")[pos[hit]]
        return out


def _ids(h: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    word, at = np.unique(h, return_inverse=True)
    ids, counts = vocabulary.find(word)
    return ids[at], counts[at]


def _before(ids: np.ndarray, toff: np.ndarray, begin: int) -> np.ndarray:
    first = np.concatenate(([begin], ids[:-1])) if len(ids) else ids
    first[toff[:-1]] = begin
    return first


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times (0.5, 1, 1.5 where those
    leave them undefined, as in tiny corpora)."""
    n1, n2, n3, n4 = n
    if not all(n):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.0), k) for k, x in enumerate(d, 1))


def _pairs(train: DataFrame, folder: str, pieces: int, vocabulary: Vocabulary, hot: list[int]) -> tuple[Pairs, DataFrame]:
    """The pairs, and a table of (kind, id, a, b, c): kind 0 a first word's numbers of followers seen once, twice, more
    often; kind 1 a second word's distinct first words (in ``a``); kind 2 the number of pairs seen ``id`` times; kind 3 the
    pieces that are written."""
    size = vocabulary.offsets[-1]
    pairs = Pairs(folder, pieces, [*hot, size])  # the beginning, id ``size``, precedes every text

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, _, _, h, toff in _tokens(batches):
            ids, _ = _ids(h, vocabulary)
            yield (_before(ids, toff, size).astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in _counted(keys(batches)):
            yield _rows(pairs.bucket(key), key, n)

    def stats(kind: int, ids: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, dtype=np.int8)), *(
            pa.array(x.astype(np.int64)) for x in (ids, a, b, c))], names=["kind", "id", "a", "b", "c"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds = []
        for b, key, n in _by_bucket(batches):
            _save(f"{folder}/p{b}.npy", key)
            _save(f"{folder}/n{b}.npy", n.astype(np.min_scalar_type(int(n.max()))))
            first = key >> np.uint64(32)
            at = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            yield stats(0, first[at].view(np.int64), *(np.add.reduceat(x.astype(np.int64), at) for x in (n == 1, n == 2, n > 2)))
            seconds.append((key & np.uint64(0xFFFFFFFF)).astype(np.uint64))
            often = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
            yield stats(2, np.arange(1, 5), often, often * 0, often * 0)
            yield stats(3, *(np.array([x]) for x in (b, 1, 0, 0)))
        if seconds:
            word, n = np.unique(np.concatenate(seconds), return_counts=True)
            yield stats(1, word.view(np.int64), n, n * 0, n * 0)

    done = (train.mapInArrow(count, "bucket int, key long, n long").repartitionById(pieces, F.col("bucket"))
            .mapInArrow(write, "kind byte, id long, a long, b long, c long"))
    table = materialize(done, "lm_pairs").groupBy("kind", "id").agg(*[F.sum(x).alias(x) for x in "abc"])
    table = materialize(table, "lm_stats")
    pairs.written[[r["id"] for r in table.where("kind = 3").select("id").collect()]] = True  # one row a piece
    return pairs, table


class Model:
    """What a worker needs to score; the arrays themselves stay in ``folder``."""

    def __init__(self, folder, vocabulary, pairs, tokens, texts, slice_ids, discounts, low, spread):
        self.folder, self.vocabulary, self.pairs, self.tokens, self.texts = folder, vocabulary, pairs, tokens, texts
        self.slice_ids, self.discounts, self.low, self.spread = slice_ids, discounts, low, spread

    def _dense(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values by id; ids not below 0."""
        out = np.zeros(len(ids))
        piece = ids // self.slice_ids
        for p in np.unique(piece):
            on = piece == p
            out[on] = _mapped(f"{self.folder}/{name}{p}.npy")[ids[on] - p * self.slice_ids]  # every word has a slice
        return out

    def log10(self, h: np.ndarray, toff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, log10 probability) of every token."""
        ids, counts = _ids(h, self.vocabulary)
        size = self.vocabulary.offsets[-1]
        word, at = np.unique(ids, return_inverse=True)
        one = np.full(len(word), self.spread)
        one[word >= 0] += self._dense("u", word[word >= 0])
        p = one[at]
        first = _before(ids, toff, size)
        seen = np.flatnonzero(first >= 0)
        if self.tokens and len(seen):
            own, back = np.unique(first[seen], return_inverse=True)
            p[seen] *= self._dense("g", own)[back]
            total = np.concatenate((counts[:0], [self.texts], counts))[:-1]
            total[toff[:-1]] = self.texts
            both = seen[ids[seen] >= 0]
            key, back = np.unique((first[both].astype(np.uint64) << np.uint64(32)) | ids[both].astype(np.uint64), return_inverse=True)
            n = self.pairs.count(key)
            less = np.array([0.0, *self.discounts])[np.minimum(n, 3)]
            p[both] += (n - less)[back] / total[both]
        return counts, np.log10(p)


def fit(train: DataFrame, text: str = "text", piece_bytes: int = PIECE_BYTES) -> Model:
    """Model of the texts of ``train``."""
    spark = train.sparkSession
    folder = shared_folder(spark, "lm")
    train = train.select(F.col(text).alias("text"))
    size = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("b")).first()
    pieces = max(16, -(-(size["b"] or 0) // piece_bytes))
    vocabulary, tokens, hot = _vocabulary(train, folder, pieces)
    pairs, stats = _pairs(train, folder, pieces, vocabulary, hot)
    seen = {r["id"]: r["a"] for r in stats.where("kind = 2").collect()}  # four rows
    discounts = _discounts([seen.get(i, 0) for i in range(1, 5)])
    once = stats.where("kind = 1").agg(F.sum("a").alias("all"), *[F.count_if(F.col("a") == i).alias(f"n{i}") for i in range(1, 5)],
                                       F.count_if(F.col("a") > 2).alias("more")).first()
    low, n, words_ = _discounts([once[f"n{i}"] for i in range(1, 5)]), once["all"] or 0, vocabulary.offsets[-1]
    left = sum(d * k for d, k in zip(low, (once["n1"], once["n2"], once["more"]))) if n else 0
    spread = (left / n if n else 1.0) / (words_ + 1)
    slice_ids = max(1, -(-(words_ + 1) // pieces))
    texts = size["n"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]) for b in batches]
        rows = np.concatenate(rows, axis=1) if rows else np.zeros((6, 0), dtype=np.int64)
        for p in np.unique(rows[0]).tolist():
            _, kind, ids, a, b, c = rows[:, rows[0] == p]
            v, w = kind == 0, kind == 1
            dense = np.zeros(slice_ids)
            dense[ids[w] - p * slice_ids] = (a[w] - np.array([0.0, *low])[np.minimum(a[w], 3)]) / n
            _save(f"{folder}/u{p}.npy", dense)
            total = np.zeros(slice_ids)
            at = np.arange(p * slice_ids, min((p + 1) * slice_ids, words_ + 1))
            total[:len(at)] = _counts(vocabulary, at, texts)
            dense = np.ones(slice_ids)  # a word that no word follows passes its whole weight on
            place = ids[v] - p * slice_ids
            dense[place] = (discounts[0] * a[v] + discounts[1] * b[v] + discounts[2] * c[v]) / total[place]
            _save(f"{folder}/g{p}.npy", dense)
            yield pa.RecordBatch.from_arrays([pa.array([p])], names=["slice"])

    by_id = stats.where("kind < 2").select((F.floor(F.col("id") / slice_ids)).cast("long").alias("p"), F.col("kind").cast("long"),
                                           "id", "a", "b", "c")
    materialize(by_id.repartitionById(pieces, F.col("p").cast("int")).mapInArrow(write, "slice long"), "lm_slices")
    return Model(folder, vocabulary, pairs, tokens, texts, slice_ids, discounts, low, spread)


def _counts(vocabulary: Vocabulary, ids: np.ndarray, texts: int) -> np.ndarray:
    """Counts of consecutive ids; the id after the last word is the beginning, which precedes every text."""
    offsets = np.array(vocabulary.offsets)
    out = np.full(len(ids), texts, dtype=np.int64)
    bucket = np.searchsorted(offsets, ids, side="right") - 1
    for b in np.unique(bucket[ids < offsets[-1]]).tolist():
        on = (bucket == b) & (ids < offsets[-1])
        out[on] = _mapped(f"{vocabulary.folder}/c{b}.npy")[ids[on] - offsets[b]]
    return out


def score(docs: DataFrame, model: Model, keys: list[Column], schema: str, text: str = "text") -> DataFrame:
    """``keys`` (with the given schema) and per text ``n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    ``base_score`` is the add-one unigram baseline, ``perplexity`` is 10 ** (-score / n_tokens).
    """
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = model.tokens + 1 * (model.vocabulary.offsets[-1] + 1)
        for batch, lo, hi, h, toff in _tokens(batches):
            counts, p = model.log10(h, toff)
            base = np.log10((counts + 1) / types)
            n = np.diff(toff)
            total = np.add.reduceat(p, toff[:-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(lo, hi - lo) for i in range(n_keys)), pa.array(n),
                 pa.array(np.add.reduceat((counts > 0).astype(np.int64), toff[:-1])), pa.array(np.full(len(n), model.tokens)),
                 pa.array(np.add.reduceat(base, toff[:-1])), pa.array(total), pa.array(10.0 ** np.minimum(-total / n, 300))],
                names=names)

    ddl = schema + ", n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    names = [f.strip().split(" ")[0] for f in ddl.split(",")]
    return docs.select(*keys, F.col(text).alias("__text")).mapInArrow(run, ddl)
