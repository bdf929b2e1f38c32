import os
import tempfile

from textoverlap.streaming import start_sentence_ingest


def test_stream_sentences(spark):
    src = tempfile.mkdtemp(prefix="to-stream-in-")
    out = tempfile.mkdtemp(prefix="to-stream-out-")
    for name, text in [("a.txt", "One. Two!"), ("b.txt", "Three? four")]:
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    q = start_sentence_ingest(spark, src, out, name=os.path.basename(out), available_now=True)
    q.awaitTermination(120)
    rows = sorted(r.text for r in spark.read.parquet(out).collect())
    assert rows == ["one", "three", "two"]
