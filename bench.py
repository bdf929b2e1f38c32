"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is run to completion with a full-result aggregate (no collect of
rows to the driver, no row limit).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from textoverlap.plans.queries import QUERIES  # noqa: E402
from textoverlap.session import build_session, drop_tables  # noqa: E402

# Queries whose cost grows near-linearly with the corpus (plus candidates and output).
# The exact edit-distance join (similar_sentence_pairs, doc_scores, ...)
# and the exact Jaccard join compare every pair inside a length band (this
# corpus has ~10K distinct 3-byte shingles, so prefixes are not selective);
# they are checked at sf0.01. At sf0.1 the banded variants stand in.
HEADLINE = [
    "sentences",
    "shingle_stats",
    "vocabulary",
    "minhash_dense",
    "lsh_jaccard_pairs",
    "doc_scores_banded",
]


def consume(df) -> int:
    """Run the whole plan; return the row count (hash of all columns forces every value)."""
    h = F.sum(F.xxhash64(*[F.col(c) for c in df.columns]) % 1000003)
    return df.agg(F.count(F.lit(1)).alias("n"), h.alias("h")).collect()[0]["n"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), app="textoverlap-bench", driver_memory="24g")
    times, rows = {}, {}
    for n in names:
        t0 = time.time()
        rows[n] = consume(QUERIES[n](spark, sf_dir))
        times[n] = round(time.time() - t0, 3)
        drop_tables(spark)
        print(f"# {n}: {times[n]}s rows={rows[n]}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
