"""K-d tree sharding of documents by metadata, with leaves of near equal bytes.

The tree starts with all documents and as many shares as shards. A node of k shares is cut along its widest metadata
dimension at the weighted quantile that gives floor(k / 2) of k shares of its bytes to the left child, until every
leaf is one share: the target bytes. Dimensions: the logarithm of the size, and a hash position for each string
column. A document's place along a dimension is (coordinate, hash of the row), so many documents of one
source, language or size can be cut anywhere.

Quantiles are found for all nodes of a level together by histograms of sums, narrowed to the range of the bin that
holds the cut until the bin weighs less than ``tolerance`` of a shard: every pass is one aggregation of at most
nodes x ``BINS`` rows, of which one row a node comes to the driver. The tree (one entry a node) is then applied to
every row by an expression, without a join. Slots are numbered within ranges of the row hash, as many as the number of rows
asks for, after the sizes of the ranges before, so no shard passes through one task.

Law: ``bytes``. Equal texts are not kept together: a group of copies may exceed a shard.

Defined cases: a null text has no bytes; null metadata has a coordinate of its own; rows that are equal in doc_id
and text lie in one shard, in any order; with fewer documents than shards some shards are empty; empty tables give
empty results; all columns of the input are kept as they are in ``row``.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize

BINS = 1024
RECORD_BYTES = 16     # per document beside its text
_COORD, _TIE = 20, 40  # bits
RANGE_ROWS = 4096  # rows of a shard per range in which slots are numbered, about


class Tree:
    """Nodes by number: cut dimension and place, children, shares and first shard; ``dim`` -1 marks a leaf."""

    def __init__(self, shards: int):
        self.dim, self.cut, self.left, self.right, self.shares, self.first = [-1], [0], [0], [0], [shards], [0]
        self.depth = 0

    def split(self, node: int, dim: int, cut: int) -> None:
        a = self.shares[node] // 2
        self.dim[node], self.cut[node], self.left[node], self.right[node] = dim, cut, len(self.dim), len(self.dim) + 1
        for shares, first in ((a, self.first[node]), (self.shares[node] - a, self.first[node] + a)):
            for column, value in zip((self.dim, self.cut, self.left, self.right, self.shares, self.first), (-1, 0, 0, 0, shares, first)):
                column.append(value)

    def node(self, coords: Column, tie: Column) -> Column:
        """Number of the leaf that a row falls into."""
        dim, cut, left, right = (_array(x) for x in (self.dim, self.cut, self.left, self.right))

        def down(n: Column, _: Column) -> Column:
            return (F.when(F.get(dim, n) < 0, n).when(_place(coords, tie, F.get(dim, n)) <= F.get(cut, n), F.get(left, n))
                    .otherwise(F.get(right, n)))

        n = F.lit(0).cast("long")
        return F.reduce(F.sequence(F.lit(1), F.lit(self.depth)), n, down) if self.depth else n


def _array(values: list[int]) -> Column:
    """Constant array (one entry a node), as a literal that the optimiser folds."""
    return F.from_json(F.lit(json.dumps(values)), "array<long>")


def _place(coords: Column, tie: Column, dim: Column) -> Column:
    return F.shiftleft(F.get(coords, dim.cast("int")).cast("long"), _TIE) + tie


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + RECORD_BYTES).cast("long")


def _prepared(docs: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """``row`` (all columns), ``doc_id``, ``size``, ``crc``, ``coords`` and ``tie``."""
    top = 1 << _COORD
    size = size_of(docs["text"])
    # sizes up to 2**40 bytes on a logarithmic scale; strings at a hash position, null before all
    coords = [F.floor(F.log2(size.cast("double")) / 40.0 * (top - 1)).cast("int")]
    coords += [F.coalesce(F.pmod(F.xxhash64(docs[c]), F.lit(top - 1)).cast("int") + F.when(docs[c].isNotNull(), 1), F.lit(0))
               for c in dimensions if c in docs.columns]
    crc = F.crc32(F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8"))
    tie = F.pmod(F.xxhash64(docs["doc_id"].cast("string"), crc, size), F.lit(1 << _TIE))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                       size.alias("size"), crc.alias("crc"), F.array(*coords).alias("coords"), tie.alias("tie"))


def build_tree(base: DataFrame, shards: int, dims: int, tolerance: float = 0.002) -> Tree:
    """Tree over ``base`` (``size``, ``coords`` of ``dims`` entries, ``tie``), a written table: it is read a few times a level."""
    tree = Tree(shards)
    while True:
        here = base.select(tree.node(F.col("coords"), F.col("tie")).alias("node"), "size", "coords", "tie")
        open_ = [n for n, d in enumerate(tree.dim) if d < 0 and tree.shares[n] > 1]
        if not open_:
            return tree
        here = here.where(F.get(_array([int(d < 0 and k > 1) for d, k in zip(tree.dim, tree.shares)]), F.col("node")) == 1)
        extent = here.groupBy("node").agg(
            F.sum("size").alias("size"), F.min("tie").alias("tie0"), F.max("tie").alias("tie1"),
            *[f(F.get("coords", F.lit(d))).alias(f"{name}{d}") for d in range(dims) for name, f in (("lo", F.min), ("hi", F.max))])
        state = {}
        for r in extent.collect():  # one row a node
            d = max(range(dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
            n, k = r["node"], tree.shares[r["node"]]
            state[n] = {"dim": d, "lo": r[f"lo{d}"] << _TIE, "hi": (r[f"hi{d}"] << _TIE) + (1 << _TIE) - 1, "below": 0,
                        "want": r["size"] * (k // 2) / k, "small": tolerance * r["size"] / k, "done": None}
        while any(s["done"] is None for s in state.values()):
            _narrow(here, len(tree.dim), state)
        for n in open_:
            tree.split(n, state[n]["dim"] if n in state else 0, state[n]["done"] if n in state else 0)
        tree.depth += 1


def _narrow(here: DataFrame, nodes: int, state: dict) -> None:
    """One histogram pass for all nodes whose cut is still open."""
    todo = {n: s for n, s in state.items() if s["done"] is None}
    at = lambda k: F.get(_array([todo[n][k] if n in todo else 0 for n in range(nodes)]), F.col("node"))
    width = [max(1, -(-(todo[n]["hi"] - todo[n]["lo"] + 1) // BINS)) if n in todo else 0 for n in range(nodes)]
    w = F.get(_array(width), F.col("node"))
    place = (here.select("node", "size", _place(F.col("coords"), F.col("tie"), at("dim")).alias("p"), at("lo").alias("lo"),
                         at("hi").alias("hi"), w.alias("w")).where((F.col("w") > 0) & F.col("p").between(F.col("lo"), F.col("hi"))))
    bins = place.groupBy("node", F.expr("(p - lo) div w").alias("bin")).agg(
        F.sum("size").alias("size"), F.min("p").alias("p0"), F.max("p").alias("p1"))
    upto = F.sum("size").over(Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    want = F.from_json(F.lit(json.dumps([todo[n]["want"] - todo[n]["below"] if n in todo else 0.0 for n in range(nodes)])), "array<double>")
    # the first bin that reaches the wanted weight: one row a node
    cross = (bins.withColumn("upto", upto).where(F.col("upto") >= F.get(want, F.col("node")) - 0.5)
             .groupBy("node").agg(F.min_by(F.struct("size", "p0", "p1", "upto"), "bin").alias("b")).select("node", "b.*"))
    for r in cross.collect():
        s = todo[r["node"]]
        before = s["below"] + r["upto"] - r["size"]
        if r["p0"] == r["p1"] or r["size"] <= s["small"]:
            whole = abs(before + r["size"] - s["want"]) <= abs(before - s["want"])
            s["done"] = r["p1"] if whole else r["p0"] - 1
        else:
            s["lo"], s["hi"], s["below"] = r["p0"], r["p1"], before


def shard(docs: DataFrame, shards: int = 40, dimensions: tuple[str, ...] = ("source", "lang"), tolerance: float = 0.002) -> DataFrame:
    """``row`` (all columns of ``docs``), ``doc_id``, ``size``, ``crc``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    ready = _prepared(docs, dimensions)
    dims = 1 + sum(c in docs.columns for c in dimensions)
    base = materialize(ready.select("size", "coords", "tie"), "metadata")
    tree = build_tree(base, shards, dims, tolerance)
    bits = min(_TIE, max(2, math.ceil(math.log2(max(1, base.count() / (shards * RANGE_ROWS))))))
    first = F.get(_array(tree.first), tree.node(F.col("coords"), F.col("tie"))).cast("int")
    placed = ready.select("row", "doc_id", "size", "crc", "tie", first.alias("shard"),
                          F.shiftright("tie", _TIE - bits).alias("range"))
    counts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("shard").alias("s"), F.col("range").alias("r"), F.coalesce(before, F.lit(0)).alias("before"))
    offsets = materialize(offsets, "slot_offsets")
    own = F.row_number().over(Window.partitionBy("shard", "range").orderBy("tie", "doc_id", "crc"))
    joined = placed.join(offsets, (placed["shard"] == offsets["s"]) & (placed["range"] == offsets["r"]))
    return joined.select("row", "doc_id", "size", "crc", "shard", (F.col("before") + own - 1).cast("long").alias("slot"))
