"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textoverlap.session import materialize, tables_dir

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"
__all__ = ["WORD", "SPACE", "read", "materialize", "words", "n_words", "shared_folder", "partitions"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building them: each word becomes one character, white space none."""
    one = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*", "w")
    return F.length(F.regexp_replace(one, SPACE, "")).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of this application's tables that tasks can open as plain files.

    Memory-mapped arrays need a mounted file system. The folder is resolved as Spark resolves it, a path without a scheme
    against the default file system; other file systems are refused rather than replaced by a
    local folder that other machines cannot see.
    """
    import uuid
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    whole = at.getFileSystem(conf).makeQualified(at).toUri()
    if whole.getScheme() != "file":
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {whole}")
    path = os.path.join(whole.getPath(), f"{name}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path
