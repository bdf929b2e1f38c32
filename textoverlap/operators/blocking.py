"""Skew-safe pair generation for equi-keys.

A plain equi-join on a hot key (a length bucket holding a third of all
sentences, a shingle every sentence contains) sends all its pairs to one task.
Here each key is cut into ``ceil(count / block_rows)`` blocks by a hash of the
row id, every row is replicated once per partner block, and the join runs on
``(key, left_block, right_block)``. Every task then sees at most
``block_rows**2`` pairs, no pair is produced twice, and none is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.session import materialize


BROADCAST_KEYS = 1 << 18  # heavy keys that are broadcast; beyond it they are joined by shuffle


def _heavy(df: DataFrame, key: str, block_rows: int, name: str) -> DataFrame:
    """``(_k, name)``: the number of blocks of each key with more than ``block_rows`` rows; every other key has one.

    The table has at most rows / block_rows rows. It is written, counted, and broadcast where small, so that what it is
    joined to is not shuffled by its plain, skewed key.
    """
    n = F.count(F.lit(1))
    heavy = (df.groupBy(key).agg(n.alias("_n")).where(F.col("_n") > block_rows)
             .select(F.col(key).alias("_k"), F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias(name)))
    return small_keys(heavy)


def small_keys(heavy: DataFrame) -> DataFrame:
    """``heavy``, written, and broadcast if it has few rows."""
    heavy = materialize(heavy, "heavy_keys")
    return F.broadcast(heavy) if heavy.count() <= BROADCAST_KEYS else heavy


def _with_blocks(df: DataFrame, heavy: DataFrame, key: str, name: str) -> DataFrame:
    return df.join(heavy, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(name, F.lit(1)))


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], by: str, block_rows: int, counts: DataFrame | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has at most one row a key.

    A key of more than ``block_rows`` rows is dealt out: its rows by a hash of ``by``, its row of ``table`` once for each of
    the blocks. The other keys are joined as they are. ``counts``: the keys and ``n``, where the rows of a key are known
    already (keys that are missing there have few).
    """
    one = F.xxhash64(*keys)
    if counts is None:
        heavy = _heavy(rows.select(one.alias("_h")), "_h", block_rows, "_nb")
    else:
        heavy = counts.where(F.col("n") > block_rows).groupBy(one.alias("_k")).agg(F.ceil(F.max("n") / F.lit(block_rows)).cast("int").alias("_nb"))
        heavy = small_keys(heavy)
    deal = lambda df: _with_blocks(df.withColumn("_h", one), heavy, "_h", "_nb")
    left = deal(rows).withColumn("_s", F.pmod(F.xxhash64(by), "_nb")).drop("_nb", "_h")
    right = deal(table).withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb").cast("long") - 1))).drop("_nb", "_h")
    return left.join(right, [*keys, "_s"]).drop("_s")


def _spread(left: DataFrame, right: DataFrame, key: str, partitions: int | None):
    """Hash-partition both sides on the block-pair key with a fixed count.

    The pair join is heavy per input byte (quadratic work), so AQE must not
    coalesce its input into a few tasks; an explicit ``repartition(n, cols)``
    is left alone by AQE and the join reuses the partitioning.
    """
    if not partitions:
        return left, right
    cols = [key, "_lb", "_rb"]
    return left.repartition(partitions, *cols), right.repartition(partitions, *cols)


def pair_partitions(spark, factor: int = 4) -> int:
    """Partition count for pair joins: a multiple of the configured shuffle width."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(n, spark.sparkContext.defaultParallelism) * factor


def blocked_self_pairs(df: DataFrame, key: str, id_col: str, block_rows: int,
                       partitions: int | None = None, possible: Column | None = None) -> DataFrame:
    """Unordered pairs of rows sharing ``key``, each pair once, ``l_id < r_id``.

    Columns of ``df`` come back prefixed ``l_`` and ``r_``; rows are swapped so
    the smaller ``id_col`` is on the left. With ``possible``, a symmetric test
    on those columns, pairs that fail it go before ids are compared, and the
    others come back in either order.
    """
    cols = [c for c in df.columns if c != key]
    b = _with_blocks(df, _heavy(df, key, block_rows, "_nb"), key, "_nb")
    blk = F.pmod(F.xxhash64(F.col(id_col)), F.col("_nb")).cast("int")
    b = b.withColumn("_blk", blk)
    # left copy of a row in block i meets blocks j >= i, right copy in block j meets i <= j
    left = b.select(F.col(key), F.col("_blk").alias("_lb"),
                    F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_rb"),
                    *[F.col(c).alias("l_" + c) for c in cols])
    right = b.select(F.col(key), F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_lb"),
                     F.col("_blk").alias("_rb"), *[F.col(c).alias("r_" + c) for c in cols])
    left, right = _spread(left, right, key, partitions)
    j = left.join(right, [key, "_lb", "_rb"])
    lid, rid = F.col("l_" + id_col), F.col("r_" + id_col)
    if possible is not None:
        return j.where(possible & ((F.col("_lb") < F.col("_rb")) | (lid < rid))).drop("_lb", "_rb")
    j = j.where((F.col("_lb") < F.col("_rb")) | (lid < rid)).where(lid != rid)
    swap = lid > rid
    out = [F.col(key)]
    for c in cols:
        out.append(F.when(swap, F.col("r_" + c)).otherwise(F.col("l_" + c)).alias("l_" + c))
        out.append(F.when(swap, F.col("l_" + c)).otherwise(F.col("r_" + c)).alias("r_" + c))
    return j.select(*out)


def blocked_cross_pairs(left: DataFrame, right: DataFrame, key: str, id_col: str,
                        block_rows: int, partitions: int | None = None) -> DataFrame:
    """All pairs (l, r) of a left and a right row sharing ``key``.

    Columns come back prefixed ``l_`` / ``r_``. Both sides are blocked, so a
    key that is hot on either side is spread over a grid of tasks.
    """
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    hl, hr = _heavy(left, key, block_rows, "_nl"), _heavy(right, key, block_rows, "_nr")
    lb, rb = (_with_blocks(_with_blocks(df, hl, key, "_nl"), hr, key, "_nr") for df in (left, right))
    lsel = lb.select(F.col(key), F.pmod(F.xxhash64(F.col(id_col)), F.col("_nl")).cast("int").alias("_lb"),
                     F.explode(F.sequence(F.lit(0), F.col("_nr") - 1)).alias("_rb"),
                     *[F.col(c).alias("l_" + c) for c in lcols])
    rsel = rb.select(F.col(key), F.explode(F.sequence(F.lit(0), F.col("_nl") - 1)).alias("_lb"),
                     F.pmod(F.xxhash64(F.col(id_col)), F.col("_nr")).cast("int").alias("_rb"),
                     *[F.col(c).alias("r_" + c) for c in rcols])
    lsel, rsel = _spread(lsel, rsel, key, partitions)
    return lsel.join(rsel, [key, "_lb", "_rb"]).drop("_lb", "_rb")
