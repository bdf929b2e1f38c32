"""Shingle operators: k-byte shingles, weights, per-sentence sets.

Each operator works within a sentence's own row, for the sentences of an Arrow batch at once (``functions.sets``): sets,
ranks and counts need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.functions import sets
from textoverlap.functions.shingle import code_hex


def _with_text(df: DataFrame, keys: list[str]) -> tuple[DataFrame, str]:
    kinds = dict(df.dtypes)
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return df.select(*keys, text.alias("__text")), ", ".join(f"{c} {kinds[c]}" for c in keys)


def shingles(df: DataFrame, keys: list[str], k: int = 3) -> DataFrame:
    """``(*keys, spos, shingle, code, weight)``: every k-byte shingle, duplicates kept.

    ``shingle`` is the hex of the bytes; ``spos`` starts at 1. Time grows with the bytes of a sentence, however long.
    """
    rows, schema = _with_text(df, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in sets.runs(batch.column(len(keys))):
                owner, code, weight = sets.shingle_rows(data, off, k)
                spos = np.arange(len(owner)) - sets.offsets_of(owner, hi - lo)[owner] + 1
                of = pa.array(lo + owner)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(len(keys))), pa.array(spos.astype(np.int32)), pa.array(code), pa.array(weight)],
                                                 names=[*keys, "spos", "code", "weight"])

    found = rows.mapInArrow(run, schema + ", spos int, code long, weight long")
    return found.select(*keys, "spos", code_hex(F.col("code"), k).alias("shingle"), "code", "weight")


def member_rows(df: DataFrame, keys: list[str], k: int = 3, kind: str = "exact") -> DataFrame:
    """``(*keys, rank, spos, code)``: the members of each sentence's set in the order of their first positions.

    ``exact`` de-duplicates on the shingle; ``weighted`` on its weighted byte
    sum, first wins, as the original does (distinct shingles with equal sums
    collapse). Made in the sentence's own row; nothing is shuffled.
    """
    if kind not in ("exact", "weighted"):
        raise ValueError(kind)
    rows, schema = _with_text(df, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in sets.runs(batch.column(len(keys))):
                owner, code, weight = sets.shingle_rows(data, off, k)
                first = np.sort(sets.first_by(owner, code if kind == "exact" else weight))
                own = owner[first]
                rank = np.arange(len(own)) - sets.offsets_of(own, hi - lo)[own] + 1
                spos = first - sets.offsets_of(owner, hi - lo)[own] + 1
                of = pa.array(lo + own)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(len(keys))), pa.array(rank.astype(np.int32)),
                                                  pa.array(spos.astype(np.int32)), pa.array(code[first])], names=[*keys, "rank", "spos", "code"])

    return rows.mapInArrow(run, schema + ", rank int, spos int, code long")


def set_arrays(df: DataFrame, keys: list[str], k: int = 3, kind: str = "exact") -> DataFrame:
    """``(*keys, set)``: sorted array of member codes, sentences with >= k bytes
    only. Made in the sentence's own row; nothing is shuffled."""
    if kind not in ("exact", "weighted"):
        raise ValueError(kind)
    rows, schema = _with_text(df, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in sets.runs(batch.column(len(keys))):
                owner, code, weight = sets.shingle_rows(data, off, k)
                if kind == "weighted":
                    first = sets.first_by(owner, weight)
                    owner, code = owner[first], code[first]
                kept = sets.first_by(owner, code)
                some = np.flatnonzero(np.diff(off) >= k)
                begin = sets.offsets_of(owner[kept], hi - lo)
                members = pa.ListArray.from_arrays(pa.array(np.append(begin[some], begin[-1]).astype(np.int32)), pa.array(code[kept]))
                taken = pa.array(lo + some)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(taken) for i in range(len(keys))), members], names=[*keys, "set"])

    return rows.mapInArrow(run, schema + ", set array<bigint>")


def shingle_stats(df: DataFrame, keys: list[str], k: int = 3) -> DataFrame:
    """Per sentence: number of shingles, exact set size, weighted set size.

    Set sizes are distinct counts of codes and of weights; sentences shorter
    than k report zeros. Counted in the sentence's own row; nothing is shuffled.
    """
    rows, schema = _with_text(df, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in sets.runs(batch.column(len(keys))):
                owner, code, weight = sets.shingle_rows(data, off, k)
                counts = [np.bincount(o, minlength=hi - lo) for o in (owner, *(owner[sets.first_by(owner, v)] for v in (code, weight)))]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(keys))), *map(pa.array, counts)],
                                                 names=[*keys, "n_shingles", "n_set_exact", "n_set_weighted"])

    return rows.mapInArrow(run, schema + ", n_shingles long, n_set_exact long, n_set_weighted long")
