"""Vocabulary: distinct shingles with dense ids in first-occurrence order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textoverlap.functions import sets
from textoverlap.functions.shingle import code_hex
from textoverlap.session import materialize


def dense_rank_by(df: DataFrame, order_cols: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """Adds ``name`` = 1-based rank of each row under ``order_cols`` (unique keys).

    Distributed: rows are range-partitioned and frozen to the checkpoint folder
    (so a retried task sees the same ranges); per-range counts (one row per
    range) give offsets; ranks inside a range come from a window partitioned
    by range. No step moves the whole table into one task.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *order_cols).withColumn("_rp", F.spark_partition_id())
    r = materialize(r, "rank")
    counts = r.groupBy("_rp").agg(F.count(F.lit(1)).alias("_c"))
    # one row per range: bounded by the partition count
    offs = counts.select("_rp", F.coalesce(F.sum("_c").over(
        Window.orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_rp").orderBy(*order_cols)
    return (r.join(F.broadcast(offs), "_rp")
            .withColumn(name, (F.col("_off") + F.row_number().over(w)).cast("long"))
            .drop("_rp", "_off"))


def vocabulary(shingle_rows: DataFrame, order_keys: list[str], k: int = 3) -> DataFrame:
    """``(code, shingle, first_*, n_occurrences, vid)`` over all shingle rows.

    ``shingle_rows`` has ``code``, ``spos`` and the sentence order keys (e.g.
    ``doc_id, pos``). The id follows the first occurrence in (keys, spos) order,
    as the original builds its vocabulary from the full shingle list.
    """
    return _ranked(shingle_rows, order_keys, k, F.count(F.lit(1)))


def _ranked(rows: DataFrame, order_keys: list[str], k: int, occurrences: Column) -> DataFrame:
    first = F.min(F.struct(*[F.col(c) for c in order_keys], F.col("spos"))).alias("f")
    v = rows.groupBy("code").agg(first, occurrences.alias("n_occurrences"))
    flat = v.select("code", "n_occurrences",
                    *[F.col("f." + c).alias("first_" + c) for c in order_keys + ["spos"]])
    ranked = dense_rank_by(flat, ["first_" + c for c in order_keys + ["spos"]], "vid")
    return ranked.withColumn("shingle", code_hex(F.col("code"), k))


def key_numbers(columns: list[pa.Array]) -> np.ndarray:
    """A number for each row: equal for equal keys, nulls included, and in the order of the keys, nulls first."""
    n = len(columns[0])
    at = np.zeros(n, dtype=np.int64)
    for c in columns:
        kinds = c.dictionary_encode(null_encoding="encode")
        order = pc.sort_indices(kinds.dictionary, null_placement="at_start").to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        at = np.unique(at * max(len(order), 1) + rank[kinds.indices.to_numpy(zero_copy_only=False)], return_inverse=True)[1]
    return at


def sentence_vocabulary(sents: DataFrame, order_keys: list[str], k: int = 3) -> DataFrame:
    """``vocabulary`` of all shingles of the sentences ``(*order_keys, text)``.

    The shingles of an Arrow batch are counted where they are made: a row a distinct shingle and batch is shuffled, not one
    a shingle, and the first occurrence, which Spark finds by sorting, is sorted over those rows only.
    """
    kinds = dict(sents.dtypes)
    rows = sents.select(*order_keys, F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = key_numbers([batch.column(i) for i in range(len(order_keys))])
            batch, key = batch.take(pa.array(np.argsort(key, kind="stable"))), np.sort(key)
            for lo, hi, data, off in sets.runs(batch.column(len(order_keys))):
                owner, code, _ = sets.shingle_rows(data, off, k)
                if not len(owner):
                    continue
                spos = np.arange(len(owner)) - sets.offsets_of(owner, hi - lo)[owner] + 1
                own = key[lo:hi]
                # rows stand by key and place, but for those of a key that comes twice
                at = np.arange(len(owner)) if (np.diff(own) > 0).all() else np.lexsort((spos, own[owner]))
                first = at[sets.first_by(np.zeros(len(at), dtype=np.int64), code[at])]
                n = np.bincount(np.searchsorted(code[first], code))
                of = pa.array(lo + owner[first])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(len(order_keys))), pa.array(spos[first].astype(np.int32)),
                                                  pa.array(code[first]), pa.array(n)], names=[*order_keys, "spos", "code", "n"])

    found = rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in order_keys) + ", spos int, code long, n long")
    return _ranked(found, order_keys, k, F.sum("n"))
