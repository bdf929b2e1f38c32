"""Cosine listing of the lines of a group (classic mode's second half), with vocabulary and permutations scoped to the group.

All groups go through the same few steps; there is no pass per group. Vocabulary ids: the first occurrence of each
shingle of a group by an aggregation with a partial step, then a number in that order (a window over a group's distinct shingles,
not over its lines). The join that gives the members their ids is salted (``blocking.salted_join``), so a shingle of one
large group that is in every line does not gather in a task. A group's lines are dealt into blocks of about ``BLOCK`` lines and its
block pairs to tasks; vectors are made where they are compared.

A vector has as many coordinates as the group has lines. Its cosine has no bound that prunes pairs, so work grows with the
square of a group's lines; only pairs from the threshold on are returned.

Defined cases: rows with a null group, line or text take no part; a line shorter than a shingle counts as a line and is similar
to none; (group, line) is unique; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textoverlap.functions.dense import cosines, dense_vectors
from textoverlap.functions.text import ascii_lower
from textoverlap.operators.blocking import salted_join
from textoverlap.operators.shingles import member_rows, shingles
from textoverlap.session import materialize

BLOCK = 128
_FOUND = "grp long, line_a long, line_b long, cosine double"


def clean_lines(lines: DataFrame) -> DataFrame:
    """``grp, line, text``: lower-cased, without one leading blank."""
    text = F.regexp_replace(ascii_lower(F.col("text")), "^ ", "").alias("text")
    return lines.select(F.col("grp").cast("long").alias("grp"), F.col("line").cast("long").alias("line"), text).dropna()


def group_members(clean: DataFrame, k: int = 3, block_rows: int = 2048) -> DataFrame:
    """``grp, line, ids``: the weighted set of each line that has one, in ids of its group's vocabulary."""
    keys = ["grp", "line"]
    first = shingles(clean, keys, k).groupBy("grp", "code").agg(F.min(F.struct("line", "spos")).alias("f"))
    vocab = first.select("grp", "code", F.row_number().over(Window.partitionBy("grp").orderBy("f")).cast("long").alias("vid"))
    members = salted_join(member_rows(clean, keys, k, "weighted"), vocab, ["grp", "code"], "line", block_rows)
    return members.groupBy(*keys).agg(F.collect_list("vid").alias("ids"))  # one line's set


def similar_lines_cosine(lines: DataFrame, t: float = 0.7, k: int = 3, block_rows: int = 2048) -> DataFrame:
    """``grp, line_a, line_b, cosine`` of line pairs of a group with a cosine of at least ``t``, line_a < line_b."""
    clean = materialize(clean_lines(lines), "lines")
    sizes = clean.groupBy("grp").agg(F.count(F.lit(1)).cast("int").alias("n"))
    rows = salted_join(group_members(clean, k, block_rows), sizes, ["grp"], "line", block_rows)
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("nb", blocks).withColumn("own", F.pmod(F.xxhash64("line"), "nb").cast("int"))
    dealt = rows.select("grp", "line", "ids", "n", "own", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    dealt = dealt.withColumns({"lb": F.least("own", "other"), "rb": F.greatest("own", "other")})

    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        n, own, line = part.column("n")[0].as_py(), part.column("own").to_numpy(), part.column("line").to_numpy()
        lb, rb = part.column("lb")[0].as_py(), part.column("rb")[0].as_py()
        ids = part.column("ids").combine_chunks()
        offsets = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
        vectors = dense_vectors(ids.flatten().to_numpy(), offsets, n)
        a, b = np.flatnonzero(own == lb), np.flatnonzero(own == rb)
        value = cosines(vectors[a], vectors[b]) if len(a) and len(b) else np.zeros((len(a), len(b)))
        i, j = np.nonzero((value >= t) & (line[a][:, None] < line[b] if lb == rb else True))
        x, y = line[a[i]], line[b[j]]
        grp = np.full(len(i), part.column("grp")[0].as_py(), dtype=np.int64)
        return pa.table({"grp": grp, "line_a": np.minimum(x, y), "line_b": np.maximum(x, y), "cosine": value[i, j]})

    return dealt.groupBy("grp", "lb", "rb").applyInArrow(run, _FOUND)
