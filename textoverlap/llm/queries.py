"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textoverlap.llm import classifier, decontam, langid, lm, mixing, negatives, quality, sharding, simhash, spelling, substring, url_rules, warc
from textoverlap.llm.common import read

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _fold(n: int) -> Column:
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(n))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontam.matches(docs, bench, [F.col("doc_id").cast("long").alias("doc_id")], "doc_id long")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = _fold(3) == 1
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out")], "doc_id long, held_out boolean")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = _fold(7) == 2
    model = lm.fit(docs.where(~held))
    return lm.score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out")], "doc_id long, held_out boolean")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read(spark, sf_dir, "documents"), texts=False).drop("kept_text")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.round_trip(read(spark, sf_dir, "pages"))
    failed = F.raise_error(F.concat(F.lit("WARC record of page "), F.col("page_id").cast("string"), F.lit(": "), F.col("problem")))
    return got.select(F.when(F.col("problem").isNull(), F.col("page_id")).otherwise(failed.cast("long")).alias("page_id"),
                      "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " AS t(host, path, verdict)")
    return url_rules.judge(read(spark, sf_dir, "pages"), rules).select("row.page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = _fold(3) == 1
    model = classifier.fit(docs, labels.where(~held))
    out = classifier.score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out")], "doc_id long, held_out boolean")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _misspelt(doc_id: Column, word: Column) -> Column:
    """One code point of a word goes in one of 199 (document, word) pairs."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)
    h = F.crc32(F.encode(seed, "UTF-8"))
    at = F.pmod(h, F.char_length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(F.pmod(h, F.lit(199)) == 0, cut).otherwise(word)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.corpus_words(read(spark, sf_dir, "documents"), "[A-Za-z\u00C0-\u00FF]", 6, 5, _misspelt)
    return spelling.variants(words, ratio=5)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.quantised(read(spark, sf_dir, "embeddings"))
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_decontamination, op3_language, op4_lm_scores, op5_near_duplicates, op6_quality,
                                   op7_substring_dedup, op8_warc, op9_url_rules, op10_mixing, op11_quality_scores,
                                   op12_spelling, op13_hard_negatives)}
