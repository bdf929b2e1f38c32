"""Sentence operators: split, count, and collapse to distinct sentences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.functions.sets import runs
from textoverlap.functions.text import sentence_runs


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("text")), f"doc_id {kind}"


def sentences(docs: DataFrame) -> DataFrame:
    """``(doc_id, pos, text, n_bytes, n_chars)``, one row per sentence, pos from 1 (``functions.text.sentence_array``).

    Narrow: the texts of an Arrow batch are split at once inside the scan stage, no shuffle.
    """
    texts, schema = _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in runs(batch.column(1)):
                n, _, found, at = sentence_runs(data, off)
                if not len(at) > 1:
                    continue
                size = np.diff(at)
                tails = np.concatenate([[0], np.cumsum((found & 0xC0) == 0x80)])  # bytes of a character after its first
                pos = np.arange(len(size)) - np.repeat(np.cumsum(n) - n, n) + 1
                text = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(found)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(lo + np.repeat(np.arange(hi - lo), n))), pa.array(pos.astype(np.int32)), text,
                     pa.array(size.astype(np.int32)), pa.array((size - tails[at[1:]] + tails[at[:-1]]).astype(np.int32))],
                    names=["doc_id", "pos", "text", "n_bytes", "n_chars"])

    return texts.mapInArrow(run, schema + ", pos int, text string, n_bytes int, n_chars int")


def sentence_counts(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_sentences, n_delimiters)`` for every document, zero included."""
    texts, schema = _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in runs(batch.column(1)):
                n, delimiters, _, _ = sentence_runs(data, off)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(c.astype(np.int32)) for c in (n, delimiters))],
                                                 names=["doc_id", "n_sentences", "n_delimiters"])

    return texts.mapInArrow(run, schema + ", n_sentences int, n_delimiters int")


def sentence_id(text_col: str = "text"):
    """128-bit content id of a sentence (md5 of its bytes, hex)."""
    return F.md5(F.encode(F.col(text_col), "UTF-8"))


def postings(sents: DataFrame) -> DataFrame:
    """``(sid, doc_id, mult)``: how often each distinct sentence occurs per document.

    Partial aggregation runs map-side, so a sentence repeated in every
    document shuffles one row per (task, document), not one per occurrence.
    """
    return (sents.groupBy(sentence_id().alias("sid"), "doc_id")
            .agg(F.count(F.lit(1)).alias("mult")))


def distinct_sentences(sents: DataFrame) -> DataFrame:
    """``(sid, text, n_bytes)`` over distinct sentence texts.

    All pair joins run on this set: a sentence present in a thousand documents
    is compared once, and document scores are recovered with ``postings``. The text is the key, so rows meet by hash, without a sort.
    """
    return sents.select("text").distinct().select(sentence_id().alias("sid"), "text", F.octet_length("text").alias("n_bytes"))
