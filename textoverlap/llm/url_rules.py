"""URL block and allow rules by a sort-merge range join.

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's path; the longest
fitting rule (host and path together) wins. Canonical keys are the reversed host's labels, a ``#`` (which no host
holds) and the path, so a rule is the interval of keys that begin with its own, and intervals nest or are disjoint. A url
stands at one point for each number of labels that rules have: its host's last labels with its path.

Distinct points and rules are range-partitioned by key and swept in order with a stack of the rules that are open: rules
that the key has left are taken off, and the top of the stack is the longest that fits. A rule that opened in an
earlier range is carried to the head of a later one: those are rules whose key is a prefix of the range's first key,
found by an equi-join of a few prefixes a range. Neither side is broadcast or collected, so rules may be as many as urls.

Defined cases: a null url or one without ``://`` has an empty host and path; rows that repeat a url are judged alike; equal
rules count once, a block before an allow; urls that no rule fits get ``default``; empty tables give empty results;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textoverlap.config import LOWER, UPPER
from textoverlap.llm.common import materialize, partitions


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("#"), path)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def _sweep(events: DataFrame) -> DataFrame:
    """``(key, rule, verdict)`` of every point that a rule covers; ``events``: part, key, kind, rule, verdict sorted
    within partitions, rules (kind 0) before points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] = []
        part = None
        for batch in batches:
            found = []
            for p, key, kind, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, rule, verdict))
                elif stack:
                    found.append((key, *stack[-1][1:]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found)], names=["key", "rule", "verdict"])

    return events.select("part", "key", "kind", "rule", "verdict").mapInArrow(run, "key string, rule string, verdict string")


def range_join(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``(key, rule, verdict)``: for each distinct ``key`` of ``points`` the longest rule whose key it begins with.
    ``rules``: distinct key, rule, verdict."""
    n = partitions(points.sparkSession)
    events = points.select("key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("rule"),
                           F.lit(None).cast("string").alias("verdict")).distinct().union(
        rules.select("key", F.lit(0), "rule", "verdict"))
    ranged = materialize(events.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()), "url_events")
    lengths = rules.agg(F.collect_set(F.length("key")).alias("n")).first()["n"]  # at most the longest rule's characters
    heads = ranged.groupBy("part").agg(F.min("key").alias("head"))
    heads = heads.select("part", "head", F.explode(F.array(*[F.lit(x) for x in lengths] or [F.lit(0)])).alias("n"))
    carried = heads.where(F.length("head") >= F.col("n")).select("part", F.substring("head", 1, F.col("n")).alias("key"))
    carried = carried.join(rules, "key").select("key", F.lit(0).alias("kind"), "rule", "verdict", "part")
    every = ranged.unionByName(carried).repartition(n, "part").sortWithinPartitions("part", "key", "kind")
    return _sweep(every)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """All rows of ``pages`` as ``row`` with ``host``, ``path``, ``rule`` (host and path of the winner, else null) and
    ``verdict``. ``rules``: host, path, verdict (``block`` or ``allow``)."""
    rules = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         "verdict")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block after allow in order
    rules = materialize(rules.select(_key(_reversed(F.col("host")), F.col("path")).alias("key"),
                                     F.concat("host", "path").alias("rule"), "verdict", F.size(_reversed(F.col("host"))).alias("labels")), "url_rules")
    counts = rules.agg(F.collect_set("labels").alias("n")).first()["n"]  # a few numbers: labels in a host
    parsed = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), host_of(pages[url]).alias("host"),
                          path_of(pages[url]).alias("path"))
    places = parsed.select("host", "path").distinct().withColumn("labels", _reversed(F.col("host")))
    places = places.select("host", "path", "labels", F.explode(F.array(*[F.lit(x) for x in sorted(counts)] or [F.lit(0)])).alias("n"))
    places = materialize(places.where((F.col("n") > 0) & (F.size("labels") >= F.col("n"))).select(
        "host", "path", _key(F.slice("labels", 1, F.col("n")), F.col("path")).alias("key")), "url_points")
    hits = range_join(places.select("key"), rules.drop("labels"))
    best = places.join(hits, "key").groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("key"), "rule")).alias("best"))
    best = best.select(F.col("host").alias("h"), F.col("path").alias("p"), "best.rule", "best.verdict")
    out = parsed.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return out.select("row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
