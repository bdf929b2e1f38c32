"""Incremental sentence extraction for a folder that receives documents.

New files are read whole, split by the same stateless operator as the batch
jobs and appended to a parquet sentence table; the batch similarity joins
then run on that table. The stream keeps no state, so its checkpoint holds
only the file log and offsets.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textoverlap.operators.sentences import sentences
from textoverlap.session import checkpoint_dir


def start_sentence_ingest(spark: SparkSession, in_dir: str, out_dir: str, name: str = "sentences",
                          available_now: bool = False) -> StreamingQuery:
    """Stream ``in_dir``'s text files into ``out_dir`` as ``(doc_id, pos, text, n_bytes, n_chars)``."""
    raw = (spark.readStream.format("text").option("wholetext", "true")
           .option("maxFilesPerTrigger", 1000).load(in_dir))
    docs = raw.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))
    out = sentences(docs)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "streams", name))
         .option("path", out_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
