"""MinHash signatures with seeded affine permutations.

Coordinate j of a sentence's dense vector is the vocabulary id of the member
that comes first under permutation j, as in the original; the permutation is
``rank_j(v) = (a_j * v + b_j) mod p`` with fixed, seeded coefficients instead
of an unseeded shuffle, so results repeat and every engine computes the same.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.config import PERM_PRIME

VID_BITS = 31  # rank and id share a long
ROWS = 2048  # sentences whose signatures are made at once
RANKS = 1 << 21  # ranks held at once


def permutation_coefficients(num_perm: int, seed: int) -> list[tuple[int, int, int]]:
    """``[(j, a_j, b_j)]`` for j = 1..num_perm, 1 <= a < p, 0 <= b < p."""
    rng = random.Random(seed)
    return [(j, rng.randrange(1, PERM_PRIME), rng.randrange(0, PERM_PRIME)) for j in range(1, num_perm + 1)]


def signature_values(ids: np.ndarray, begin: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(set, permutation): the member that comes first; set i has ``ids`` from ``begin[i]`` on and is not empty."""
    out, step = np.empty((len(begin), len(a)), dtype=np.int64), max(1, RANKS // max(len(ids), 1))
    for j in range(0, len(a), step):
        rank = (ids[:, None] * a[j:j + step] + b[j:j + step]) % PERM_PRIME
        out[:, j:j + step] = np.minimum.reduceat((rank << VID_BITS) | ids[:, None], begin, axis=0) & ((1 << VID_BITS) - 1)
    return out


def minhash(members: DataFrame, keys: list[str], num_perm: int, seed: int,
            id_col: str = "vid") -> DataFrame:
    """``(*keys, j, vid)``: the argmin member id under each permutation.

    A sentence's members meet in one row (a set, no larger than the sentence), which gives its whole signature; they are
    shuffled once, not once a permutation. Ids are below ``2**VID_BITS``.
    """
    a, b = (np.array(c, dtype=np.int64) for c in list(zip(*permutation_coefficients(num_perm, seed)))[1:])
    sets = members.groupBy(*keys).agg(F.collect_list(F.col(id_col).cast("long")).alias("_ids"))
    kinds = dict(members.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                column = batch.column(len(keys))
                ids, begin = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])[:-1].astype(np.int64)
                out = signature_values(ids, begin, a, b)
                of = pa.array(np.repeat(np.arange(batch.num_rows), num_perm))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(len(keys))),
                                                  pa.array(np.tile(np.arange(1, num_perm + 1, dtype=np.int32), batch.num_rows)), pa.array(out.ravel())],
                                                 names=[*keys, "j", id_col])

    return sets.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keys) + f", j int, {id_col} long")
