"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into blocks of ``BLOCK`` bytes; two neighbouring blocks are a chunk, so chunks overlap by half and cover the
whole text. Bytes have learned vectors; learned filters over ``WIDTH`` bytes are max-pooled over each chunk; a chunk's
pooled values, with the share of it that text fills, go through a hidden layer; its units are max-pooled over all chunks of the
text and combined into one probability. Every filter position of a text is computed once, in pieces of
``PIECE_BLOCKS`` blocks, so memory does not grow with the length of a text.

Fitting reads a bounded sample: at most ``class_rows`` labelled documents a class (those of smallest hash of the id) and, of
each, at most ``doc_chunks`` chunks spread evenly over the whole text. Only those chunks reach the driver, where the weights are
fitted with Adam on the balanced cross entropy (each class weighs the same), from a fixed seed. Scoring covers every byte of every
document.

Defined cases: null and empty texts are a chunk without bytes and get the score of one; labels other than 0 and 1 and
labels without a document are ignored; of labels that repeat a document's id the least counts; without labels of both classes
the score is 0.5, or nearer to the only class; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.tokens import text_buffer

BLOCK = 64
WIDTH = 5
DEPTH = 6  # of a byte's vector
FILTERS = 40
HIDDEN = 24
CLASS_ROWS = 2000
DOC_CHUNKS = 24
STEPS = 500
BATCH = 48  # documents a step
PIECE_BLOCKS = 1024
RATE = 0.004
DECAY = 1e-4
_SPAN = np.arange(BLOCK + WIDTH - 1)


@dataclass
class Network:
    vectors: np.ndarray  # byte, DEPTH
    filters: np.ndarray  # WIDTH * DEPTH, FILTERS
    shift: np.ndarray
    hidden: np.ndarray  # FILTERS + 1, HIDDEN
    hidden_shift: np.ndarray
    out: np.ndarray
    out_shift: np.ndarray

    @classmethod
    def random(cls, seed: int) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        return cls(draw(256, DEPTH, scale=0.5), draw(WIDTH * DEPTH, FILTERS, scale=(2 / (WIDTH * DEPTH)) ** 0.5), np.zeros(FILTERS, np.float32),
                   draw(FILTERS + 1, HIDDEN, scale=(2 / FILTERS) ** 0.5), np.zeros(HIDDEN, np.float32), draw(HIDDEN, scale=HIDDEN ** -0.5), np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.shift, self.hidden, self.hidden_shift, self.out, self.out_shift]

    def responses(self, data: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """(block, position, filter) of blocks' bytes with those after them; positions past the text's end give 0."""
        x = self.vectors[data]
        at = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)  # block, position, depth, width
        n = data.shape[1] - WIDTH + 1
        flat = at.transpose(0, 1, 3, 2).reshape(len(data) * n, WIDTH * DEPTH)
        z = (flat @ self.filters + self.shift).reshape(len(data), n, FILTERS)
        np.maximum(z, 0, out=z)
        z[~inside[:, :n]] = 0
        return z

    def units(self, pooled: np.ndarray, fill: np.ndarray) -> np.ndarray:
        return np.maximum(np.column_stack([pooled, fill.astype(np.float32)]) @ self.hidden + self.hidden_shift, 0)

    def probability(self, units: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((units @ self.out + self.out_shift).astype(np.float64), -30, 30)))


def _blocks(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes from ``begin`` on, 0 past ``end``, and which of them are inside."""
    at = begin[:, None] + span
    inside = at < end[:, None]
    if not len(buf):
        return np.zeros(at.shape, dtype=np.uint8), inside
    return np.where(inside, buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint8), inside


def score_texts(model: Network, column: pa.Array) -> np.ndarray:
    """Probability of each text of an Arrow column."""
    buf, off = text_buffer(column)
    texts = len(off) - 1
    count = np.maximum(-(-np.diff(off) // BLOCK), 1)
    ends = np.cumsum(count)
    best = np.zeros((texts, HIDDEN), dtype=np.float32)  # units are not negative, and every text has a chunk
    last_pool, last_fill, last_text = np.zeros((1, FILTERS), np.float32), np.zeros(1), np.full(1, -1)
    for a in range(0, int(ends[-1]) if texts else 0, PIECE_BLOCKS):
        block = np.arange(a, min(a + PIECE_BLOCKS, int(ends[-1])))
        text = np.searchsorted(ends, block, side="right")
        begin = off[text] + (block - (ends - count)[text]) * BLOCK
        data, inside = _blocks(buf, begin, off[text + 1], _SPAN)
        pooled = model.responses(data, inside).max(axis=1)
        fill = inside[:, :BLOCK].mean(axis=1)
        pooled, fill, text = np.concatenate([last_pool, pooled]), np.concatenate([last_fill, fill]), np.concatenate([last_text, text])
        pair = np.flatnonzero(text[1:] == text[:-1])
        single = np.flatnonzero(count[text[1:]] == 1) + 1
        both = np.concatenate([np.maximum(pooled[pair], pooled[pair + 1]), pooled[single]])
        share = np.concatenate([fill[pair] + fill[pair + 1], fill[single]]) / 2
        np.maximum.at(best, np.concatenate([text[pair], text[single]]), model.units(both, share))
        last_pool, last_fill, last_text = pooled[-1:], fill[-1:], text[-1:]
    return model.probability(best)


def sample(docs: DataFrame, labels: DataFrame, label: str, class_rows: int, doc_chunks: int) -> DataFrame:
    """``label int, chunks array<binary>``: at most ``class_rows`` documents a class, at most ``doc_chunks`` chunks of each."""
    known = labels.select(F.col("doc_id").alias("of"), F.col(label).cast("int").alias("label")).where("of IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("of").agg(F.min("label").alias("label"))
    by = [F.xxhash64("of"), "of"]
    picked = known.where("label = 0").orderBy(*by).limit(class_rows).unionByName(known.where("label = 1").orderBy(*by).limit(class_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("of")).select("of", "label", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            chunks = []
            for a, z in zip(off[:-1].tolist(), off[1:].tolist()):
                n = max(-(-(z - a) // BLOCK), 1)
                at = np.unique(np.linspace(0, max(n - 2, 0), doc_chunks).astype(np.int64)) * BLOCK + a
                chunks.append([buf[b:min(b + 2 * BLOCK + WIDTH - 1, z)].tobytes() for b in at.tolist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(chunks, pa.list_(pa.binary()))], names=["of", "label", "chunks"])

    kind = rows.schema["of"].dataType.simpleString()
    found = rows.mapInArrow(cut, f"of {kind}, label int, chunks array<binary>")
    return found.orderBy(F.xxhash64("of"), "of", F.hash("chunks")).limit(2 * class_rows)  # ids may repeat


def train(chunks: list[list[bytes]], labels: np.ndarray, seed: int = 7, steps: int = STEPS) -> Network:
    """The weights after ``steps`` steps of Adam over balanced batches."""
    model = Network.random(seed)
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    if not all(map(len, classes)):
        model.out[:] = 0
        model.out_shift[:] = np.log((len(classes[1]) + 1) / (len(classes[0]) + 1))
        return model
    size = np.array([len(c) for c in chunks])
    ends = np.cumsum(size)
    flat = b"".join(x for c in chunks for x in c)
    length = np.array([len(x) for c in chunks for x in c])
    begin = np.cumsum(length) - length
    data, inside = _blocks(np.frombuffer(flat, dtype=np.uint8), begin, begin + length, np.arange(2 * BLOCK + WIDTH - 1))
    inside = inside[:, :2 * BLOCK]
    rng = np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in model.parameters()]
    square = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, steps + 1):
        docs = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        own = np.concatenate([np.arange(ends[d] - size[d], ends[d]) for d in docs])
        of = np.repeat(np.arange(len(docs)), size[docs])
        for p, g, m, s in zip(model.parameters(), _gradients(model, data[own], inside[own], of, labels[docs]), mean, square):
            g = g + DECAY * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: Network, data: np.ndarray, inside: np.ndarray, of: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy of a batch; ``of`` is each chunk's document. Max-pooling passes a gradient to one place only."""
    z = model.responses(data, inside)
    place = z.argmax(axis=1)  # chunk, filter
    pooled = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0]
    into = np.column_stack([pooled, inside.mean(axis=1).astype(np.float32)])
    units = np.maximum(into @ model.hidden + model.hidden_shift, 0)
    docs = len(labels)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    top = np.maximum.reduceat(units, first, axis=0)
    hit = units == top[of]
    rank = np.cumsum(hit, axis=0)
    chosen = hit & (rank == (rank[first] - hit[first])[of] + 1)  # the first chunk of a document that reaches its maximum
    error = ((model.probability(top) - labels) / docs).astype(np.float32)
    d_units = np.where(chosen & (units > 0), (error[:, None] * model.out)[of], 0).astype(np.float32)
    d_pooled = (d_units @ model.hidden.T)[:, :FILTERS] * (pooled > 0)
    chunk, filt = np.nonzero(d_pooled)
    value = d_pooled[chunk, filt]
    seen = data[chunk[:, None], place[chunk, filt][:, None] + np.arange(WIDTH)]  # bytes under the filter
    d_filters = np.zeros_like(model.filters)
    under = (model.vectors[seen].reshape(len(chunk), -1) * value[:, None])
    np.add.at(d_filters.T, filt, under)
    d_vectors = np.zeros_like(model.vectors)
    np.add.at(d_vectors, seen.ravel(), (model.filters.T[filt] * value[:, None]).reshape(-1, DEPTH))
    return [d_vectors, d_filters, d_pooled.sum(axis=0), into.T @ d_units, d_units.sum(axis=0), top.T @ error, error.sum(keepdims=True)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", class_rows: int = CLASS_ROWS, doc_chunks: int = DOC_CHUNKS,
        steps: int = STEPS, seed: int = 7) -> Network:
    """The network fitted to the labelled documents among ``docs`` (``doc_id, text``)."""
    rows = sample(docs, labels, label, class_rows, doc_chunks).select("label", "chunks").collect()  # bounded by the sample
    return train([[bytes(x) for x in r["chunks"]] for r in rows], np.array([r["label"] for r in rows], dtype=np.float32), seed, steps)


def score(docs: DataFrame, model: Network, keep: list[Column], kept_schema: str) -> DataFrame:
    """``keep`` and ``score``, the probability of label 1, of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(score_texts(model, batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "score"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, kept_schema + ", score double")
