"""Document sources.

Every reader returns a DataFrame with an orderable ``doc_id`` and a ``text``
column, so the same operators run on parquet tables and on folders of files.
"""

from __future__ import annotations

import os
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FEW_PATHS = 1000  # of so short a list only the named files are opened


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` from a parquet table; other columns are pruned at the scan."""
    return read_table(spark, sf_dir, table).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per regular file under ``path`` (not recursive): the whole file
    as ``text``, its path as ``doc_id`` and its size in bytes.

    Directories and unreadable entries are skipped by the file index.
    """
    df = (spark.read.option("wholetext", "true")
          .option("recursiveFileLookup", "false")
          .option("ignoreMissingFiles", "true")
          .text(path))
    return df.select(F.col("_metadata.file_path").alias("doc_id"),
                     F.col("value").alias("text"),
                     F.col("_metadata.file_size").alias("file_size"))


def _plain(path):
    """A path without its scheme, as the reader and a caller may write it."""
    return F.regexp_replace(path, "^file:(//)?", "")


def read_paths(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """``doc_id, text, status``: one row per requested path, ``status`` ``ok`` or ``no text`` with a null text (missing, a
    folder, not to be opened, or without a byte: readers skip empty files). No path fails the job.

    ``paths``: a list, or a DataFrame with ``doc_id``. The folders of the paths are read (their number reaches the driver, not
    that of the paths); of a short list only the files that it names. Repeated paths are one row.
    """
    few = None
    if not isinstance(paths, DataFrame):
        few = [p for p in paths if p is not None] if len(paths) <= FEW_PATHS else None
        paths = spark.createDataFrame([(p,) for p in paths], "doc_id string")
    asked = paths.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("p", _plain(F.col("doc_id")))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(folder: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        return fs.exists(path) and fs.getFileStatus(path).isDirectory()

    folders = sorted({r["f"] for r in asked.select(F.regexp_extract("doc_id", "^(.*)/[^/]*$", 1).alias("f")).distinct().collect()})
    folders = [f for f in folders if f and there(f)]
    if not folders:
        return asked.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit("no text").alias("status"))
    read = (spark.read.format("binaryFile").option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
            .option("recursiveFileLookup", "false").load(folders))
    if few is not None:  # names as they are, or as a URL writes them
        names = {p.rsplit("/", 1)[-1] for p in few}
        read = read.where(F.col("_metadata.file_name").isin(sorted(names | {quote(n, safe="~!$&'()*+,;=:@") for n in names})))
    found = read.select(_plain(F.col("path")).alias("p"), F.decode("content", "UTF-8").alias("text"))
    j = asked.join(found.withColumn("ok", F.lit(True)), "p", "left")
    return j.select("doc_id", "text", F.when(F.col("ok"), "ok").otherwise("no text").alias("status"))


def unreadable_paths(spark: SparkSession, requested: list[str] | DataFrame,
                     docs: DataFrame) -> DataFrame:
    """Requested paths that produced no document (missing or unreadable).

    The original tool printed a message and skipped the pair; callers anti-join
    the result away instead of failing the job.
    """
    if not isinstance(requested, DataFrame):
        requested = spark.createDataFrame([(p,) for p in requested], "doc_id string")
    norm = F.regexp_replace(F.col("doc_id"), "^file:(//)?", "")
    # the reader's paths are URL-encoded (a plus sign stands for itself)
    got = docs.select(F.url_decode(F.replace(norm, F.lit("+"), F.lit("%2B"))).alias("p"))
    return (requested.select(norm.alias("p"), F.col("doc_id"))
            .join(got, "p", "left_anti").select("doc_id"))
