"""Hard-negative mining with a multiway hyperplane tree (GNAT) whose eliminated subtrees hold no wanted vector.

Scores are integer inner products. With one more coordinate ``sqrt(top - |v|^2)`` (``top``: the largest squared norm; a
query has 0 there) the distance of a query and a row is ``sqrt(|q|^2 + top - 2 * score)``: a score window is an annulus
around the query, and the triangle inequality holds.

The tree: every node has up to ``FANOUT`` split points; a row goes to the child of the nearest one. A node stores, for
each split point and each sibling subtree, the least and the largest distance of the subtree's rows to that point.
A subtree is left out if for some split point that range, seen from the query, misses the annulus. Split points come from
a sample of at most ``SAMPLE_ROWS`` rows (those of smallest hash); the ranges and the leaves cover every row, so results
are exact (recall 1) whatever the sample. Leaves are scanned whole.

``hard_negatives`` searches twice for the positives and twice for the negatives: first only the query's own leaf, whose
k-th score narrows the annulus, then every leaf that the annulus meets. Leaves are packed into buckets of about
``BUCKET_ROWS`` rows (a larger leaf is cut by a hash of the id), and queries into chunks of ``CHUNK_QUERIES``; a task
compares one bucket with one chunk, so neither a heavy leaf nor the number of queries gathers in a task. The driver holds
the sample, the tree (at most ``FANOUT ** MAX_LEVELS`` leaves) and a count per leaf.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; shorter vectors
are padded with zeros; a repeated id counts once, with its smallest (label, vector); equal scores go by the smaller id;
an empty table, a table without anchors and an anchor without positives or negatives give no rows; vectors too large for
exact scores in a long (squared norm over 2^56, component over 2^28) are refused; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize

FANOUT = 8
MAX_LEVELS = 4
LEAF_ROWS = 1024  # wanted
SAMPLE_ROWS = 8192
BUCKET_ROWS = 2048
CHUNK_QUERIES = 1024
STEP = 256  # windows compared at once with a bucket
NO_LIMIT = 1 << 60


def quantised(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """``id long, label int, v array<bigint>`` of the rows that take part: components ``floor(scale * x)``."""
    x = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"),
                       F.col(vector).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    ok = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True))
    return x.where(ok).select("id", "label", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass
class Tree:
    """``points[level]``: split points of the level's nodes, ``node * FANOUT + child`` a row; ``low``, ``high``: by
    level, node, split point and sibling. A missing child has ``used`` False."""

    top: float
    points: list[np.ndarray]
    used: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]

    @property
    def leaves(self) -> int:
        return FANOUT ** len(self.points)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))

    def distances(self, x: np.ndarray, up: np.ndarray, level: int, node: int) -> np.ndarray:
        """Of rows (``up``: their further coordinate) to a node's split points; infinite for missing ones."""
        own = slice(node * FANOUT, (node + 1) * FANOUT)
        p = self.points[level][own]
        square = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * (x @ p.T) + (up[:, None] - self.lift(p)) ** 2
        return np.where(self.used[level][own], np.sqrt(np.maximum(square, 0)), np.inf)

    def place(self, x: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of each row; ``seen(level, node, child, distances)`` is told of every node on the way."""
        at, up = np.zeros(len(x), dtype=np.int64), self.lift(x)
        for level in range(len(self.points)):
            to = np.empty_like(at)
            for node in np.unique(at).tolist():
                k = np.flatnonzero(at == node)
                d = self.distances(x[k], up[k], level, node)
                child = d.argmin(axis=1)
                to[k] = node * FANOUT + child
                if seen:
                    seen(level, node, child, d)
            at = to
        return at

    def alive(self, q: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """By query and leaf: whether the leaf may hold a row with a score from ``least`` to ``most``."""
        own = (q * q).sum(axis=1)
        slack = 1e-6 * (math.sqrt(self.top) + np.sqrt(own)) + 1e-6  # over any rounding of a distance
        inner = np.sqrt(np.maximum(own + self.top - 2.0 * most, 0)) - slack
        outer = np.where(least <= -NO_LIMIT, np.inf, np.sqrt(np.maximum(own + self.top - 2.0 * least, 0)) + slack)
        up, open_ = np.zeros(len(q)), np.ones((len(q), 1), dtype=bool)
        for level in range(len(self.points)):
            child = np.zeros((len(q), FANOUT ** (level + 1)), dtype=bool)
            for node in range(FANOUT ** level):
                k = np.flatnonzero(open_[:, node])
                if not len(k):
                    continue
                d = self.distances(q[k], up[k], level, node)[:, :, None]
                low, high = self.low[level][node], self.high[level][node]  # infinite, minus infinite where empty
                split = self.used[level][node * FANOUT:(node + 1) * FANOUT]
                with np.errstate(invalid="ignore"):
                    hit = (np.maximum(d - high, low - d) <= outer[k, None, None]) & (d + high >= inner[k, None, None])
                child[np.ix_(k, range(node * FANOUT, (node + 1) * FANOUT))] = hit[:, split, :].all(axis=1) & np.isfinite(low[split][0])
            open_ = child
        return open_


def fit(sample: np.ndarray, top: float, rows: int, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split points for ``rows`` rows from a sample; the ranges are still empty. Each node takes the sample's first row of
    its own and then, in turn, the one farthest from those taken."""
    levels = min(MAX_LEVELS, max(1, math.ceil(math.log(max(rows / leaf_rows, 1), FANOUT))))
    tree = Tree(top, [], [], [], [])
    at, dim = np.zeros(len(sample), dtype=np.int64), sample.shape[1]
    up = tree.lift(sample)
    whole = np.column_stack([sample, up])
    for level in range(levels):
        n = FANOUT ** level
        tree.points.append(np.zeros((n * FANOUT, dim)))
        tree.used.append(np.zeros(n * FANOUT, dtype=bool))
        tree.low.append(np.full((n, FANOUT, FANOUT), np.inf))
        tree.high.append(np.full((n, FANOUT, FANOUT), -np.inf))
        to = np.zeros_like(at)
        for node in range(n):
            k = np.flatnonzero(at == node)
            nearest, pick = np.full(len(k), np.inf), 0
            if not len(k) and level and tree.used[level - 1][node]:  # rounding may deal all of a sample's rows elsewhere
                tree.points[level][node * FANOUT] = tree.points[level - 1][node]
                tree.used[level][node * FANOUT] = True
            for child in range(FANOUT if len(k) else 0):
                tree.points[level][node * FANOUT + child] = sample[k[pick]]
                tree.used[level][node * FANOUT + child] = True
                nearest = np.minimum(nearest, ((whole[k] - whole[k[pick]]) ** 2).sum(axis=1))
                pick = int(nearest.argmax())
                if nearest[pick] <= 0:
                    break
            if len(k):
                to[k] = node * FANOUT + tree.distances(sample[k], up[k], level, node).argmin(axis=1)
        at = to
    return tree


@dataclass
class Index:
    """``rows``: ``id, label, v, leaf, bucket``; ``first`` and ``parts``: by leaf, its first bucket and the number of buckets
    that it is cut into; ``buckets``: how many there are."""

    tree: Tree
    rows: DataFrame
    first: np.ndarray
    parts: np.ndarray
    buckets: int
    size: int

    def chunks(self, queries: int) -> int:
        return max(1, -(-queries // CHUNK_QUERIES))


def index(rows: DataFrame, leaf_rows: int = LEAF_ROWS, bucket_rows: int = BUCKET_ROWS, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """The tree over ``id, label, v`` (array<bigint>); None if there are no rows."""
    spark = rows.sparkSession
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("s")).select("id", "s.label", "s.v")
    one = materialize(one, "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    stats = one.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("top"),
                    F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, c: F.greatest(s, F.abs(c)))).alias("most")).first()
    if not stats["n"]:
        return None
    if stats["top"] > 2.0 ** 56 or stats["most"] > 1 << 28:
        raise ValueError("vectors are too large for exact integer scores")
    dim = max(stats["dim"], 1)
    padded = one.select("id", "label", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))).alias("v"))
    drawn = padded.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()  # at most sample_rows rows
    tree = fit(matrix(drawn.column("v")).astype(np.float64), stats["top"], stats["n"], leaf_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.place(matrix(batch.column(2)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=["id", "label", "v", "leaf"])

    placed = materialize(padded.mapInArrow(place, "id long, label int, v array<bigint>, leaf int"), "placed")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = [x.copy() for x in tree.low], [x.copy() for x in tree.high]

        def seen(level, node, child, d):
            for j in np.unique(child).tolist():
                own = d[child == j]
                low[level][node, :, j] = np.minimum(low[level][node, :, j], own.min(axis=0))
                high[level][node, :, j] = np.maximum(high[level][node, :, j], own.max(axis=0))

        for batch in batches:
            if batch.num_rows:
                tree.place(matrix(batch.column(0)).astype(np.float64), seen)
        for level in range(len(low)):
            node, point, child = np.nonzero(np.isfinite(low[level]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), level, dtype=np.int32)), *(pa.array(x.astype(np.int32)) for x in (node, point, child)),
                                              pa.array(low[level][node, point, child]), pa.array(high[level][node, point, child])],
                                             names=["level", "node", "point", "child", "low", "high"])

    found = placed.select("v").mapInArrow(ranges, "level int, node int, point int, child int, low double, high double")
    for r in found.groupBy("level", "node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():  # bounded by the tree
        tree.low[r["level"]][r["node"], r["point"], r["child"]] = r["low"]
        tree.high[r["level"]][r["node"], r["point"], r["child"]] = r["high"]
    counts = np.zeros(tree.leaves, dtype=np.int64)
    for r in placed.groupBy("leaf").count().collect():  # one row a leaf
        counts[r["leaf"]] = r["count"]
    first, parts, bucket, held = np.zeros(tree.leaves, dtype=np.int64), np.ones(tree.leaves, dtype=np.int64), 0, 0
    for leaf, n in enumerate(counts.tolist()):
        if held and held + n > bucket_rows:
            bucket, held = bucket + 1, 0
        first[leaf], parts[leaf] = bucket, max(1, -(-n // bucket_rows))
        held += n
        if parts[leaf] > 1:
            bucket, held = bucket + int(parts[leaf]), 0
    spread = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, parts))], "leaf int, first int, parts int")
    rows = (placed.join(F.broadcast(spread), "leaf")  # one row a leaf
            .select("id", "label", "v", "leaf", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("bucket")))
    return Index(tree, rows, first, parts, bucket + 1, stats["n"])


_VISIT = "bucket int, chunk int, anchor long, key long, label int, v array<bigint>, least long, most long, same boolean, leaves array<int>"
_FOUND = "anchor long, key long, id long, score long"


def _types(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in schema.split(", ")])


def search(ix: Index, windows: DataFrame, queries: int, k: int, home: bool = False) -> DataFrame:
    """``anchor, key, id, score``: of each window the first ``k`` rows by (score descending, id) among those with a score
    from ``least`` to ``most`` and the anchor's label (``same``) or another, the anchor itself left out.

    ``windows``: ``anchor, key, label, v, leaf, least, most, same``. ``queries``: the number of anchors. ``home``: only the
    anchor's own leaf is read, so fewer may be found.
    """
    tree, first, parts, n_chunks = ix.tree, ix.first, ix.parts, ix.chunks(queries)
    schema, found = _types(_VISIT), _types(_FOUND)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, STEP):
                batch = whole.slice(a, STEP)
                least, most = (batch.column(i).to_numpy() for i in (5, 6))
                if home:
                    alive = np.zeros((batch.num_rows, tree.leaves), dtype=bool)
                    alive[np.arange(batch.num_rows), batch.column(4).to_numpy()] = True
                else:
                    alive = tree.alive(matrix(batch.column(3)).astype(np.float64), least, most)
                visits = []
                for i in range(batch.num_rows):
                    by: dict[int, list[int]] = {}
                    for leaf in np.flatnonzero(alive[i]).tolist():
                        for b in range(int(first[leaf]), int(first[leaf] + parts[leaf])):
                            by.setdefault(b, []).append(leaf)
                    visits += [(i, b, leaves) for b, leaves in by.items()]
                if not visits:
                    continue
                row, bucket, leaves = zip(*visits)
                own = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), own.column(8), own.column(0), own.column(1), own.column(2), own.column(3),
                                                  own.column(5), own.column(6), own.column(7), pa.array(leaves, pa.list_(pa.int32()))], schema=schema)

    chunk = F.pmod(F.xxhash64("anchor"), F.lit(n_chunks)).cast("int").alias("chunk")
    visits = windows.select("anchor", "key", "label", "v", "leaf", "least", "most", "same", chunk).mapInArrow(route, _VISIT)
    every = ix.rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))

    def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return found.empty_table()
        rows = rows.sort_by("id")
        x, ids, label = matrix(rows.column("v")), rows.column("id").to_numpy(), rows.column("label").to_numpy()
        leaves, leaf = np.unique(rows.column("leaf").to_numpy(), return_inverse=True)
        exact = np.float64 if tree.top < 2.0 ** 52 else np.int64  # sums of products stay exact
        x, out = x.astype(exact), []
        for at in range(0, asked.num_rows, STEP):
            part = asked.slice(at, STEP)
            score = (matrix(part.column("v")).astype(exact) @ x.T).astype(np.int64)
            visited = np.array([np.isin(leaves, w) for w in part.column("leaves").to_pylist()])[:, leaf]
            anchor, least, most = (part.column(c).to_numpy()[:, None] for c in ("anchor", "least", "most"))
            alike = part.column("label").to_numpy()[:, None] == label
            same = part.column("same").to_numpy()[:, None]
            ok = visited & (score >= least) & (score <= most) & (ids != anchor) & (alike == same)
            for i in np.flatnonzero(ok.any(axis=1)).tolist():
                at_i = np.flatnonzero(ok[i])
                best = at_i[np.argsort(-score[i, at_i], kind="stable")[:k]]  # rows stand by id
                out.append((np.full(len(best), anchor[i, 0]), np.full(len(best), part.column("key")[i].as_py()), ids[best], score[i, best]))
        if not out:
            return found.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=found)

    got = every.groupBy("bucket", "chunk").cogroup(visits.groupBy("bucket", "chunk")).applyInArrow(scan, _FOUND)
    by = Window.partitionBy("anchor", "key").orderBy(F.col("score").desc(), "id")
    return got.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, **sizes) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``id, label, v`` (integer components, see ``quantised``). An anchor's positives are its first rows of the
    same label; for each, the first rows of another label with ``percent`` to 100 per cent of the positive's score.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    ix = index(rows, **sizes)
    if ix is None:
        return spark.createDataFrame([], schema)
    anchors = materialize(ix.rows.where(anchor).select(F.col("id").alias("anchor"), "label", "v", "leaf"), "anchors")
    n = anchors.count()

    def narrowed(windows: DataFrame, k: int, name: str) -> DataFrame:
        """The search in two steps; the k-th score in the own leaf raises the least score."""
        seed = search(ix, windows, n, k, home=True).where(F.col("rank") == k).select("anchor", "key", F.col("score").alias("at"))
        seed = materialize(seed, name + "_seed")
        least = F.greatest("least", F.coalesce("at", F.col("least")))
        near = windows.join(seed, ["anchor", "key"], "left").withColumn("least", least).drop("at")
        return materialize(search(ix, near, n, k), name)

    limits = [F.lit(x).cast("long").alias(c) for c, x in (("least", -NO_LIMIT), ("most", NO_LIMIT))]
    alike = anchors.select("anchor", F.lit(0).cast("long").alias("key"), "label", "v", "leaf", *limits, F.lit(True).alias("same"))
    best = narrowed(alike, positives, "positives").select("anchor", F.col("id").alias("key"), F.col("score").alias("most"))
    least = F.expr(f"(most * {percent} + 99) div 100")
    others = materialize(best.where("most >= 0").join(anchors, "anchor")
                         .select("anchor", "key", "label", "v", "leaf", least.alias("least"), "most", F.lit(False).alias("same")), "windows")
    hard = narrowed(others, negatives, "negatives")
    out = hard.join(best, ["anchor", "key"])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                      F.col("most").alias("positive_score"), F.col("score").alias("negative_score"))
