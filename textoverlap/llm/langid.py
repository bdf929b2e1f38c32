"""Language identification by unigram pieces, summed over all segmentations.

Per language l a probability p_l(piece) for the pieces of a fixed public byte-level vocabulary. A word (with the
space before it, A-Z lowered) has the probability of all its segmentations together, by a forward pass over its
bytes; a text has the product over its words, and the language with the largest posterior is predicted.

Training is expectation-maximisation on a word table counted in Spark: the forward-backward pass gives each piece's
expected count. Texts are weighed equally whatever their source; neither lang, source nor doc_id is read to predict.
Model: languages x pieces numbers, a few MB whatever the corpus. The fit may be held to ``fit_texts`` texts a
language, taken by a hash of the text (a documented bound; prediction covers every whole text).

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was
learned; a run of any length without white space is one word (over ``PART_BYTES`` bytes it is read in parts, cut only where no piece
of the vocabulary lies across, so the product over the parts is the sum over all segmentations of the whole); very long texts
are read in whole; repeated rows get equal results; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize
from textoverlap.llm.tokens import base_powers, chunks, column_hash, prefix, spans_hash, text_buffer, words

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MAX_LANGUAGES = 256
PART_BYTES = 64
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_TABLE_BITS = 20
_BLOCK = 16384  # words that are gone through together
_CELLS = 1 << 20  # words times bytes of the longest that are gone through together
_STEP = 12  # bytes after which numbers are scaled back to about 1
KNOWN_WORDS = 1 << 19  # words whose probabilities a worker remembers


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a tiktoken rank file; every single byte is one of them."""
    with open(path, "rb") as f:
        pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    return sorted(pieces | {bytes([b]) for b in range(256)})


class Pieces:
    """Numbers of the pieces by the hash of their bytes; -1 is the number of no piece."""

    def __init__(self, pieces: list[bytes]):
        size = np.array([len(p) for p in pieces])
        self.longest = int(size.max())
        end = np.cumsum(size)
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        h = spans_hash(prefix(raw.astype(np.uint64) + np.uint64(1)), end - size, end)
        self.number = np.argsort(h)
        self.hash = h[self.number]
        # by the top bits: where the hashes that begin with them start (most spans are no piece: one look tells)
        top = self.hash >> np.uint64(64 - _TABLE_BITS)
        self.at = np.searchsorted(top, np.arange(1 << _TABLE_BITS, dtype=np.uint64)).astype(np.int32)
        self.some = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.some[top] = True
        self.most = int(np.bincount(top.astype(np.int64)).max())

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices into ``h``, numbers) of the hashes that are pieces."""
        top = h >> np.uint64(64 - _TABLE_BITS)
        on = np.flatnonzero(self.some[top])
        own, pos = h[on], self.at[top[on]]
        hit = self.hash[pos] == own
        for i in range(1, self.most):
            pos = np.where(hit, pos, np.minimum(pos + 1, len(self.hash) - 1))
            hit = self.hash[pos] == own
        return on[hit], self.number[pos[hit]]


class Words:
    """A block of words, longest first, and for each end and length the words in which a piece ends there."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, head: np.ndarray, pieces: Pieces):
        """``head``: 1 where a space stands in front (a word's first part), else 0."""
        size = ends - starts + head
        self.order = np.argsort(-size, kind="stable")
        self.size, head = size[self.order], head[self.order]
        self.n, self.width = len(size), int(size.max())
        place = starts[self.order][:, None] + np.arange(self.width) - head[:, None]
        data = raw[np.clip(place, 0, len(raw) - 1)].astype(np.uint64)
        data[head > 0, 0] = 0x20
        pre = np.zeros((self.n, self.width + 1), dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * base_powers(self.width), axis=1, out=pre[:, 1:])
        pre = np.ascontiguousarray(pre.T)
        self.alive = [int(np.searchsorted(-self.size, -i, side="right")) for i in range(self.width + 1)]
        self.longest = pieces.longest
        self.steps = []  # (end, length, words, pieces) by end
        for end in range(1, self.width + 1):
            m = self.alive[end]
            for length in range(1, min(end, pieces.longest) + 1):
                lo = end - length
                on, number = pieces.find(column_hash(pre[end, :m] - pre[lo, :m], lo, length))
                if len(on):
                    self.steps.append((end, length, on, number))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Log probability of every word (in input order) under each column of ``p``."""
        alpha = np.zeros((self.width + 1, self.n, p.shape[1]))
        alpha[0] = 1.0
        scale, done = np.zeros(self.n), 0
        for end, length, on, number in self.steps:
            if end - done > _STEP:  # keep the places that later ones are made from near 1
                done = end - 1
                m = self.alive[done]
                top = np.maximum(alpha[done, :m].max(axis=1), 1e-300)
                alpha[max(0, done - self.longest):done + 1, :m] /= top[:, None]
                scale[:m] += np.log(top)
            alpha[end, on] += alpha[end - length, on] * p[number]
        out = np.empty((self.n, p.shape[1]))
        out[self.order] = np.log(np.maximum(alpha[self.size, np.arange(self.n)], 1e-300)) + scale[:, None]
        return out

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces under one language's ``p``; ``weight`` of each word in input order.

        Both passes scale the places that are still used back to 1; ``up`` and ``down`` hold the logarithms."""
        every = np.arange(self.n)
        alpha, up = np.zeros((self.width + 1, self.n)), np.zeros((self.width + 1, self.n))
        alpha[0], done = 1.0, 0
        for end, length, on, number in self.steps:
            if end - done > _STEP:
                done = end - 1
                m, used = self.alive[done], slice(max(0, done - self.longest), done + 1)
                top = np.where(alpha[done, :m] > 0, alpha[done, :m], 1.0)
                alpha[used, :m] /= top
                up[used, :m] += np.log(top)
                up[end:, :m] = up[done, :m]
            alpha[end, on] += alpha[end - length, on] * p[number]
        beta, down = np.zeros((self.width + 1, self.n)), np.zeros((self.width + 1, self.n))
        beta[self.size, every], done = 1.0, self.width
        for end, length, on, number in reversed(self.steps):
            if done - end > _STEP:  # what is read from now on: the place ``end``, and those before it that are partly summed
                done = end
                m, used = self.alive[done], slice(max(0, done - self.longest), done + 1)
                top = np.where(beta[done, :m] > 0, beta[done, :m], 1.0)
                beta[used, :m] /= top
                down[:done + 1, :m] += np.log(top)
            beta[end - length, on] += beta[end, on] * p[number]
        share, whole = weight[self.order], np.log(np.maximum(alpha[self.size, every], 1e-300)) + up[self.size, every]
        out = np.zeros(len(p))
        for end, length, on, number in self.steps:
            at = end - length
            much = np.exp(np.minimum(up[at, on] + down[end, on] - whole[on], 700))
            out += np.bincount(number, alpha[at, on] * p[number] * beta[end, on] * much * share[on], len(p))
        return out


def _free(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Places in ``buf``, inside the given words, that no piece lies across, the space in front of a word included."""
    size = ends - starts
    first = np.cumsum(size) - size
    n = int(size.sum())
    data = buf[np.arange(n) + np.repeat(starts - first, size)]
    end = np.repeat(first + size, size)
    pre, cover = prefix(data.astype(np.uint64) + np.uint64(1)), np.zeros(n + 1, dtype=np.int32)
    head = np.minimum(first[:, None] + np.arange(pieces.longest - 1), n - 1)
    ahead = np.column_stack([np.full(len(size), 0x20, dtype=np.uint64), data[head].astype(np.uint64)]) + np.uint64(1)
    ahead = np.cumsum(ahead * base_powers(pieces.longest), axis=1, dtype=np.uint64)
    for length in range(2, pieces.longest + 1):
        for lo in range(0, n, _CELLS):
            at = np.arange(lo, min(lo + _CELLS, n))
            at = at[at + length <= end[at]]
            on, _ = pieces.find(spans_hash(pre, at, at + length))
            np.add.at(cover, at[on] + 1, 1)
            np.add.at(cover, at[on] + length, -1)
        fits = np.flatnonzero(size >= length - 1)
        on, _ = pieces.find(column_hash(ahead[fits, length - 1], 0, length))
        np.add.at(cover, first[fits[on]] + 1, 1)
        np.add.at(cover, first[fits[on]] + length - 1, -1)
    open_ = np.cumsum(cover)[:n] == 0
    open_[first] = False
    return (np.flatnonzero(open_) + np.repeat(starts - first, size)[open_]).astype(np.int64)


def _parts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of over ``PART_BYTES`` cut into parts of at least that many bytes at places that no piece lies across:
    (starts, ends, head, number of parts per word)."""
    long = np.flatnonzero(ends - starts > PART_BYTES)
    one = np.ones(len(starts), dtype=np.int64)
    if not len(long):
        return starts, ends, one, one
    free = _free(buf, starts[long], ends[long], pieces)
    cuts = []
    for a, z in zip(starts[long].tolist(), ends[long].tolist()):
        k = np.searchsorted(free, a + PART_BYTES)
        while k < len(free) and free[k] < z:
            cuts.append(int(free[k]))
            k = np.searchsorted(free, free[k] + PART_BYTES)
    lo = np.sort(np.concatenate([starts, np.array(cuts, dtype=np.int64)]))
    word = np.searchsorted(starts, lo, side="right") - 1
    hi = np.append(lo[1:], len(buf))
    return lo, np.minimum(hi, ends[word]), (lo == starts[word]).astype(np.int64), np.bincount(word, minlength=len(starts))


def _blocks(raw, starts, ends, head, pieces: Pieces) -> Iterator[tuple[np.ndarray, Words]]:
    """Words in blocks of like length: (indices, block)."""
    size = ends - starts + head
    order = np.argsort(size, kind="stable")
    i = 0
    while i < len(order):
        j = min(i + _BLOCK, len(order))
        while j > i + 1 and (j - i) * int(size[order[j - 1]]) > _CELLS:
            j = i + (j - i + 1) // 2
        at = order[i:j]
        yield at, Words(raw, starts[at], ends[at], head[at], pieces)
        i = j


@lru_cache(maxsize=2)
def _table(path: str) -> tuple[list[bytes], Pieces]:
    pieces = read_vocabulary(path)
    return pieces, Pieces(pieces)


class Model:
    """Languages, log-free piece probabilities (pieces x languages) and the vocabulary's path."""

    def __init__(self, languages: list[str], p: np.ndarray, vocabulary: str):
        self.languages, self.p, self.vocabulary = languages, p, vocabulary
        self.known, self.known_score = np.zeros(0, dtype=np.uint64), np.zeros((0, len(languages)))

    def _score(self, h: np.ndarray, buf, starts, ends, head, pieces: Pieces) -> np.ndarray:
        """Log probabilities of distinct words with sorted hashes; words of earlier runs are remembered."""
        score = np.zeros((len(h), len(self.languages)))
        new = np.ones(len(h), dtype=bool)
        if len(self.known):
            pos = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            new = self.known[pos] != h
            score[~new] = self.known_score[pos[~new]]
        on = np.flatnonzero(new)
        for at, block in _blocks(buf, starts[on], ends[on], head[on], pieces):
            score[on[at]] = block.forward(self.p)
        if len(self.known) + len(on) > KNOWN_WORDS:
            self.known, self.known_score = h, score
        else:
            order = np.argsort(np.concatenate((self.known, h[on])), kind="stable")
            self.known = np.concatenate((self.known, h[on]))[order]
            self.known_score = np.concatenate((self.known_score, score[on]))[order]
        return score

    def log_likelihood(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, last row + 1, texts x languages) for runs of texts."""
        pieces = _table(_here(self.vocabulary))[1]
        for lo, hi, buf, off in chunks(column, lower=True):
            starts, ends, woff = words(buf, off)
            a, b, head, many = _parts(buf, starts, ends, pieces)
            poff = np.concatenate(([0], np.cumsum(many)))[woff]
            h = spans_hash(prefix(buf.astype(np.uint64) + np.uint64(1)), a, b) ^ head.astype(np.uint64)
            own, first, back = np.unique(h, return_index=True, return_inverse=True)
            score = self._score(own, buf, a[first], b[first], head[first], pieces)
            total = np.zeros((len(a) + 1, len(self.languages)))
            np.cumsum(score[back], axis=0, out=total[1:])
            yield lo, hi, total[poff[1:]] - total[poff[:-1]]


def _here(path: str) -> str:
    """The vocabulary on this machine: the file itself, or the copy that Spark sent along."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def _word_table(train: DataFrame, languages: list[str], vocabulary: str) -> DataFrame:
    """``(lang, word, head, n)``: distinct words (parts) per language, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _table(_here(vocabulary))[1]
        number = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            for lo, hi, buf, off in chunks(batch.column(1), lower=True):
                starts, ends, woff = words(buf, off)
                if not len(starts):
                    continue
                a, b, head, many = _parts(buf, starts, ends, pieces)
                who = np.repeat(np.repeat(lang[lo:hi], np.diff(woff)), many)
                h = spans_hash(prefix(buf.astype(np.uint64) + np.uint64(1)), a, b)
                h = h ^ (who.astype(np.uint64) * np.uint64(2) + head.astype(np.uint64))
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                raw = buf.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who[first].astype(np.int32)), pa.array([raw[x:y] for x, y in zip(a[first].tolist(), b[first].tolist())], pa.binary()),
                     pa.array(head[first].astype(np.int32)), pa.array(n)], names=["lang", "word", "head", "n"])

    table = train.select("lang", "text").mapInArrow(run, "lang int, word binary, head int, n long")
    return table.groupBy("lang", "word", "head").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, vocabulary: str = VOCABULARY, rounds: int = 3, fit_texts: int | None = 2000,
        smoothing: float = 0.05) -> Model:
    """Learn from ``text`` and ``lang`` of ``train`` (rows with a null in either are left out).

    ``fit_texts``: about as many texts a language, by a hash of the text, are learned from; None: all.
    """
    spark = train.sparkSession
    train = train.select("lang", "text").where("lang is not null and text is not null")
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sizes = {r["lang"]: r["n"] for r in sizes}
    languages = sorted(sizes)
    try:
        pieces, _ = _table(vocabulary)
    except OSError as e:
        raise ValueError(f"no vocabulary at {vocabulary}") from e
    spark.sparkContext.addFile(vocabulary)  # executors may not have it
    p = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    if not languages:
        return Model(languages, p, vocabulary)
    if fit_texts:
        share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, fit_texts / n))])
        train = train.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) < share[F.col("lang")] * float(1 << 20))
    table = materialize(_word_table(train, languages, vocabulary), "lang_words")
    for _ in range(rounds):
        p = _maximise(table, p, vocabulary, smoothing)
    return Model(languages, p, vocabulary)


def _maximise(table: DataFrame, p: np.ndarray, vocabulary: str, smoothing: float) -> np.ndarray:
    """One round of expectation-maximisation over the word table."""
    sent = table.sparkSession.sparkContext.broadcast(p)  # pieces x languages: bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _table(_here(vocabulary))[1]
        now = sent.value
        total = np.zeros_like(now)
        for batch in batches:
            who, n = batch.column(0).to_numpy(), batch.column(3).to_numpy().astype(float)
            head = batch.column(2).to_numpy().astype(np.int64)
            raw, off = text_buffer(batch.column(1))
            for lang in np.unique(who).tolist():
                own = np.flatnonzero(who == lang)
                for at, block in _blocks(raw, off[own], off[own + 1], head[own], pieces):
                    total[:, lang] += block.expected(np.ascontiguousarray(now[:, lang]), n[own][at])
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)),
                                          pa.array(total[piece, lang])], names=["lang", "piece", "n"])

    found = table.mapInArrow(run, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    rows = found.toPandas()  # at most languages x pieces
    new = np.full_like(p, smoothing)
    new[rows["piece"], rows["lang"]] += rows["n"]
    sent.unpersist()
    return new / new.sum(axis=0)


def predict(docs: DataFrame, model: Model, keys: list[Column], schema: str, text: str = "text") -> DataFrame:
    """``keys`` (with the given schema), ``lang_pred`` and ``score``, the posterior of the predicted language."""
    n_keys = len(keys)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages: bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            column = batch.column(n_keys)
            for lo, hi, found in model.log_likelihood(column):
                names_, scores = [], []
                for i, ll in enumerate(found, lo):
                    raw = column[i].as_py()
                    if raw is None or not model.languages or not _LETTER.search(raw):
                        names_.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(ll))
                    names_.append(model.languages[best])
                    scores.append(float(1.0 / np.exp(ll - ll[best]).sum()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(n_keys)),
                                                  pa.array(names_, pa.string()), pa.array(scores, pa.float64())], names=names)

    ddl = schema + ", lang_pred string, score double"
    names = [f.strip().split(" ")[0] for f in ddl.split(",")]
    return docs.select(*keys, F.col(text).alias("__text")).mapInArrow(run, ddl)
