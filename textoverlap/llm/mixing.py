"""Mixing sources to target weights by distributed prefix sums.

Each document has a hash-random key. Within its source documents are ordered by key: ranges of the key (leading hex
digits of an MD5) are summed and prefix-summed per source, then rows are ordered and prefix-summed within a range,
so a source that holds most rows is many ranges in many tasks. A source whose target is e times its size plus a rest
is taken e times whole, and once more up to the cut at the rest: the documents whose middle word lies before it, so
the taken words miss the target by at most half a document.

Targets: the budget (all words) is shared by weight; a source's target stops at ``cap`` times its size, and the excess
is shared again by weight until none is above.

Defined cases: null and blank texts have size 0; the null source is one source, the last; rows that repeat a doc_id
are rows of their own, ordered by a hash of id and text (rows that repeat both are alike); a source without words has target 0; empty tables give empty results; all
columns of the input are kept as they are in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize, n_words
from textoverlap.operators.vocabulary import dense_rank_by

WEIGHTS = (5, 2, 1)
CAP = 3
RANGE_ROWS = 2048  # rows of the largest source per key range, about


def _key(doc_id: Column, text: Column) -> Column:
    """Of the id and the text: rows that share an id, or have none, lie apart and in a fixed order."""
    of_text = F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    return F.md5(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), of_text), "UTF-8"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target, number)`` of ``(source, source_size)``; weights repeat over the sources by
    code point, the null source last."""
    ranked = dense_rank_by(sources.withColumn("none", F.col("source").isNull()), ["none", "source"], "number")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("number") - 1, F.lit(len(weights))).cast("int"))
    table = materialize(ranked.select("source", "source_size", "number", weight.alias("weight"),
                                      (F.col("source_size") * cap).alias("most")), "sources")
    full = F.lit(0.0) * F.col("weight") > F.col("most")  # none at first
    level, stopped = 0.0, -1
    while True:  # at most one round a source; the number of sources at their cap only grows
        r = table.agg(F.sum("source_size").alias("all"), F.count_if(full).alias("stopped"),
                      F.sum(F.when(full, F.col("most"))).alias("spent"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if r["stopped"] == stopped or not r["weight"]:
            break
        stopped = r["stopped"]
        level = float((r["all"] or 0) - (r["spent"] or 0)) / r["weight"]
        full = F.lit(level) * F.col("weight") > F.col("most")
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"), "number")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``row`` (all columns of ``docs``), ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` (times the document
    is taken) and ``taken`` (its words, repeats counted)."""
    key = _key(docs["doc_id"], docs["text"])
    ready = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                        docs["source"].alias("source"), n_words(docs["text"]).alias("size"), key.alias("key"))
    narrow = materialize(ready.select("source", "size", F.substring("key", 1, 8).alias("key")), "sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    most = sizes.agg(F.max("rows").alias("n")).first()["n"] or 0
    digits = 1
    while digits < 8 and most > RANGE_ROWS * 16 ** digits:
        digits += 1
    goal = materialize(targets(sizes.select("source", "source_size"), weights, cap), "targets")
    ranged = narrow.join(goal, narrow["source"].eqNullSafe(goal["source"])).groupBy(
        "number", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialize(ranged.select(F.col("number").alias("n"), F.col("range").alias("r"),
                                        F.coalesce(before, F.lit(0)).alias("before")), "mix_offsets")
    with_goal = ready.join(goal.withColumnRenamed("source", "goal_of"), F.col("source").eqNullSafe(F.col("goal_of"))).drop("goal_of")
    with_goal = with_goal.withColumn("range", F.substring("key", 1, digits))
    own = with_goal.join(offsets, (F.col("number") == F.col("n")) & (F.col("range") == F.col("r")))
    order = Window.partitionBy("number", "range").orderBy("key", "doc_id", "size")
    upto = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    out = own.withColumn("upto", upto).withColumn("whole", whole).withColumn("rest", rest)
    more = (F.col("rest") > 0) & (F.col("upto") - F.col("size") / 2.0 <= F.col("rest"))
    copies = F.least(F.col("whole") + F.when(more, 1).otherwise(0), F.lit(cap)).cast("long")
    return out.select("row", "doc_id", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns it has."""
    out = mix(docs, weights, cap).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
