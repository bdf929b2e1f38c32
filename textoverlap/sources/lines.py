"""Lines of text files with their positions, counted across the splits of a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textoverlap.functions.text import ascii_lower
from textoverlap.operators.blocking import salted_join
from textoverlap.session import materialize

SPLIT_ROWS = 1 << 18


def number_lines(raw: DataFrame) -> DataFrame:
    """``grp, position, text`` of ``grp, file, block, seq, text``: position counts a group's lines from 1, by file, by the split's
    place in the file and by ``seq``.

    The rows of each split are counted (one row a split) and summed up within the group; rows are numbered within their
    split. So a file of many splits is numbered as by one reader, and no file passes through one task.
    """
    counts = raw.groupBy("grp", "file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("grp", "file", "block", F.coalesce(before, F.lit(0)).alias("before"))  # one row a split
    own = F.row_number().over(Window.partitionBy("grp", "file", "block").orderBy("seq"))
    rows = raw.withColumn("own", own)
    joined = salted_join(rows, offsets, ["grp", "file", "block"], "own", SPLIT_ROWS, counts)
    return joined.select("grp", (F.col("before") + F.col("own")).cast("long").alias("position"), "text")


def raw_lines(spark: SparkSession, paths: str | list[str], grp: str | None = None) -> DataFrame:
    """``grp, file, block, seq, text`` as read, written once so that splits and order stand; ``grp`` is an expression on ``file``."""
    at = F.col("_metadata.file_path")
    raw = spark.read.text(paths).select(at.alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                        F.monotonically_increasing_id().alias("seq"), F.regexp_replace("value", "\r$", "").alias("text"))
    return materialize(raw.withColumn("grp", F.expr(grp) if grp else F.col("file")), "lines_as_read")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, position, text``: every line of the files, counted from 1 in its file. Files may be larger than a split."""
    return number_lines(raw_lines(spark, paths)).withColumnRenamed("grp", "file")


def read_numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Numbered sentences, one per line (``"1. This is a sentence."``): ``file, position, line_no, text``.

    ``line_no`` is the number before the dot, null for a line without one, which is kept whole; ``text`` is the body, ASCII
    lower-cased, without the number, the dot and one following space. The
    original tool cut a fixed three bytes and the last byte of every line;
    here the number is parsed, so lines >= 10 and files without a final
    newline are read correctly.
    """
    num = F.regexp_extract("text", r"^\s*([0-9]+)\.", 1)
    body = F.regexp_replace("text", r"^\s*[0-9]+\. ?", "")
    return read_lines(spark, paths).select("file", "position", F.when(num != "", num).cast("long").alias("line_no"),
                                           ascii_lower(body).alias("text"))
