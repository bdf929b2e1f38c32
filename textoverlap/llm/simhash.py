"""SimHash near-duplicate detection with pigeonhole blocks.

``fingerprints``: a 64-bit SimHash of every whole text. ``links``: distinct fingerprints are cut into
``distance + 3`` blocks; two that differ in at most ``distance`` bits agree on at least three of them, so a join
on every choice of three blocks finds all close pairs, and the Hamming distance verifies each. ``near_duplicates``
closes the links to components.

Equal fingerprints are one row before any join, so exact copies are never paired. A bucket of more than
``bucket_rows`` distinct fingerprints (thousands of near copies) is not paired either: its members are joined on
the fingerprints at half the distance around them. Two fingerprints within 2 bits always have a common neighbour
within 1 bit, and such a neighbour has at most 65 members, so the same components follow from a number of rows
linear in the bucket.

Defined cases: null and blank texts have no words and the fingerprint zero, which links like any other; texts
shorter than a shingle are one shingle; repeated rows are rows of one component; rows with a null doc_id get
the smallest doc_id of their component (null if it has none); an empty table gives an empty result; further
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize
from textoverlap.llm.graph import components
from textoverlap.llm.tokens import text_buffer

SEED = 42
BITS = 64


def simhash(text: bytes, shingle: int) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half of the shingles' XXH64 values."""
    w = text.lower().split()  # bytes: lowers A-Z only, splits on 0x20 and 0x09-0x0D only
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= shingle:
        hashes = xxhash.xxh64_digest(line, SEED)
    else:
        size = np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[a:b], SEED) for a, b in
                           zip(start[:len(w) - shingle + 1].tolist(), end[shingle - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint's 64 bits as a long."""
    narrow = docs.select(*[F.col(k) for k in keys], F.col(text).alias("__text"))
    schema = narrow.drop("__text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(batch.num_columns - 1))
            data, at = buf.tobytes(), off.tolist()
            fps = np.array([simhash(data[a:b], shingle) for a, b in zip(at, at[1:])], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps.view(np.int64), type=pa.int64())],
                names=[*batch.schema.names[:-1], "fp"])

    return narrow.mapInArrow(run, schema)


def _masks(distance: int) -> list[tuple[int, int]]:
    """(choice number, mask as a signed long) of every choice of three blocks."""
    n = distance + 3
    cut = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:])]
    masks = [sum(c) for c in combinations(blocks, 3)]
    return [(i, m - (1 << BITS) if m >> (BITS - 1) else m) for i, m in enumerate(masks)]


def links(fps: DataFrame, distance: int = 2, bucket_rows: int = 64) -> DataFrame:
    """``(a, b)`` pairs of distinct values of ``fp``, all within ``distance`` bits, whose components are those
    of all pairs within that distance. ``fps`` holds distinct fingerprints."""
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("byte").alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in _masks(distance)])).alias("s")).select("s.c", "s.k", "fp")
    count = keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keyed.join(count, ["c", "k"]), "buckets")
    usual = shared.where(F.col("n") <= bucket_rows).drop("n")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = (usual.withColumnRenamed("fp", "a").join(usual.withColumnRenamed("fp", "b"), ["c", "k"])
             .where("a < b").where(near).select("a", "b"))
    full = shared.where(F.col("n") > bucket_rows).select("fp").distinct()
    return pairs.union(_around(full, distance, near))


def _around(fps: DataFrame, distance: int, near) -> DataFrame:
    """Links among all ``fps`` through shared neighbours (distance up to 2; for more, one bit at a time is not
    enough and the radius around each fingerprint is ``ceil(distance / 2)``)."""
    radius = (distance + 1) // 2
    flips = [0]
    for r in range(1, radius + 1):
        flips += [sum(1 << b for b in c) for c in combinations(range(BITS), r)]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    near_by = fps.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in signed])).alias("hub"))
    group = near_by.groupBy("hub").agg(F.collect_list("fp").alias("g")).where(F.size("g") > 1)  # at most len(flips)
    if distance % 2 == 0:
        star = group.select(F.array_min("g").alias("a"), F.explode("g").alias("b"))
        return star.where("a < b").where(near).distinct()
    a = group.select(F.col("g"), F.explode("g").alias("a"))
    return a.select("a", F.explode("g").alias("b")).where("a < b").where(near).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, text: str = "text",
                    keys: tuple[str, ...] = ("doc_id",), bucket_rows: int = 64) -> DataFrame:
    """``keys``, ``fp``, ``root``, ``component_id``: per row of ``docs`` the smallest doc_id (first key) reachable
    over links; ``root`` is the component's smallest fingerprint."""
    marked = materialize(fingerprints(docs, shingle, text, keys), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min(keys[0]).alias("first")), "distinct_fp")
    roots = components(links(distinct.select("fp"), distance, bucket_rows))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    grouped = materialize(grouped, "components")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = grouped.join(least, "root").select(F.col("fp").alias("fp_"), "root", "component_id")
    return marked.join(by_fp, marked.fp == by_fp.fp_).drop("fp_")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the document with the smallest doc_id.

    A row is known by its doc_id and the hash of its text (null doc_ids come last), and rows that repeat both
    count once. All columns stay as they are.
    """
    no_id = F.lit(-(1 << 63))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"),
                        F.coalesce(docs["doc_id"].cast("long"), no_id).alias("id"),
                        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("th"))
    found = near_duplicates(keyed, shingle, distance, keys=("id", "th"))
    keep = found.groupBy("root").agg(F.min(F.struct((F.col("id") == no_id).alias("none"), "id", "th")).alias("k"))
    kept = keyed.drop("text").join(keep.select("k.id", "k.th"), ["id", "th"])
    return kept.dropDuplicates(["id", "th"]).select("row.*")
