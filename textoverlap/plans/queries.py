"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the given tables.

Every query reads whole tables; column names equal those of the SQL oracle
in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textoverlap.config import Params
from textoverlap.functions.shingle import code_hex
from textoverlap.functions.text import ascii_lower, delimiter_count
from textoverlap.functions.vectors import cosine, cosine_from_sums, magnitude
from textoverlap.operators import jaccard_join, edit_join
from textoverlap.operators.encoding import encoded_members, sentence_signatures
from textoverlap.operators.sentences import sentence_counts, sentence_id, sentences
from textoverlap.operators.shingles import member_rows, shingle_stats, shingles
from textoverlap.operators.signatures import minhash
from textoverlap.operators.vocabulary import sentence_vocabulary
from textoverlap.operators.line_cosine import similar_lines_cosine
from textoverlap.operators.report import cosine_lines, edit_distance_lines, fixed4, verdict
from textoverlap.plans import jobs
from textoverlap.plans import oracle_sql as osql
from textoverlap.session import materialize
from textoverlap.sources import read_documents, read_table

P = Params()
KEYS = ["doc_id", "pos"]
# Classic mode lists every line pair; the listing here holds pairs from this similarity on.
LISTED_SIMILARITY = 0.3


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    docs, cores = read_documents(spark, sf), spark.sparkContext.defaultParallelism
    # a table of fewer splits than cores (a single row group scans as one task) is dealt out; others are read as they are
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(2 * cores, "doc_id")


def _sents(spark, sf):
    return sentences(_docs(spark, sf))


def q_src_documents(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", F.octet_length("text").alias("n_bytes"), F.char_length("text").alias("n_chars"),
                    delimiter_count(F.col("text")).alias("n_delimiters"))


def q_ascii_lower(spark, sf):
    return _docs(spark, sf).select("doc_id", ascii_lower(F.col("text")).alias("text_lower"))


def q_sentences(spark, sf):
    return _sents(spark, sf).select("doc_id", "pos", "text", "n_bytes")


def q_sentence_lengths(spark, sf):
    return _sents(spark, sf).select("doc_id", "pos", "n_bytes", "n_chars")


def q_sentence_counts(spark, sf):
    return sentence_counts(_docs(spark, sf))


def q_shingles(spark, sf):
    return shingles(_sents(spark, sf), KEYS, P.k).select(*KEYS, "spos", "shingle", "code")


def q_shingle_weights(spark, sf):
    return shingles(_sents(spark, sf), KEYS, P.k).select(*KEYS, "spos", "weight")


def _ranked_set(sents, kind):
    rows = member_rows(sents, KEYS, P.k, kind)
    return rows.select(*KEYS, "rank", "code", code_hex(F.col("code"), P.k).alias("shingle"))


def q_shingle_sets(spark, sf):
    return _ranked_set(_sents(spark, sf), "exact")


def q_shingle_sets_weighted(spark, sf):
    return _ranked_set(_sents(spark, sf), "weighted")


def q_shingle_stats(spark, sf):
    return shingle_stats(_sents(spark, sf), KEYS, P.k)


def _vocab(sents):
    return sentence_vocabulary(sents, KEYS, P.k)


def q_vocabulary(spark, sf):
    return _vocab(_sents(spark, sf)).select("vid", "code", "shingle", "first_doc_id", "first_pos",
                                            "first_spos", "n_occurrences")


def _members(sents):
    """``(doc_id, pos, vid)``: weighted set of each sentence in vocabulary ids."""
    return encoded_members(sents, _vocab(sents), KEYS, P.k, P.salt_rows)


def _signatures(sents):
    """``(doc_id, pos, signature)`` of the weighted set of each sentence."""
    return sentence_signatures(sents, _vocab(sents), KEYS, P.k, P.salt_rows, P.num_perm, P.seed)


def q_sentence_membership(spark, sf):
    return _members(_sents(spark, sf))


def q_minhash_dense(spark, sf):
    s = _signatures(_sents(spark, sf)).select(*KEYS, F.posexplode("signature").alias("at", "vid"))
    return s.select(*KEYS, (F.col("at") + 1).alias("j"), "vid")


def q_signature_norms(spark, sf):
    # one row a sentence holds all its coordinates
    sq = F.aggregate("signature", F.lit(0).cast("long"), lambda total, v: total + v * v)
    return _signatures(_sents(spark, sf)).select(*KEYS, sq.alias("sq_norm")).withColumn("norm", F.sqrt(F.col("sq_norm").cast("double")))


def q_embedding_norms(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", magnitude(F.col("embedding")).alias("norm"))


def q_embedding_cosine(spark, sf):
    """Cosine of every vector with the mean vector of its label; one row per vector."""
    e = read_table(spark, sf, "embeddings")
    mean = (e.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos")
            .agg(F.avg(F.col("x").cast("double")).alias("x")))
    mean = mean.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("m"))  # one entry a dimension
    mean = mean.select(F.col("label").alias("of"), F.transform("m", lambda p: p["x"]).alias("mean"))
    j = e.join(mean, e["label"].eqNullSafe(mean["of"]))
    return j.select("vec_id", "label", F.round(cosine(F.col("embedding"), F.col("mean")), 9).alias("cosine"))


def q_similar_sentence_pairs(spark, sf):
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    return edit_join.similar_edit_pairs(c.distinct, P.sim_threshold, P.block_rows)


def q_similar_jaccard_pairs(spark, sf):
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    return jaccard_join.similar_jaccard_pairs(c.sets, P.sim_threshold, P.block_rows)


def q_signature_similarity(spark, sf):
    """Dense-vector cosine and signature agreement of the Jaccard-similar pairs."""
    sents = _sents(spark, sf)
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    pairs = jaccard_join.similar_jaccard_pairs(c.sets, P.sim_threshold, P.block_rows)
    pairs = materialize(pairs, "jaccard_pairs")
    met = pairs.select(F.explode(F.array("sid_a", "sid_b")).alias("sid")).distinct()
    of = sents.select(*KEYS, sentence_id().alias("sid")).join(met, "sid", "left_semi")
    # only sentences of a pair need a signature; their ids come from the vocabulary of all
    own = sents.join(of.select(*KEYS).distinct(), KEYS, "left_semi")
    dm = encoded_members(own, _vocab(sents), KEYS, P.k, P.salt_rows).join(of, KEYS).select("sid", "vid").distinct()
    sig = minhash(dm, ["sid"], P.num_perm, P.seed)
    sq = sig.groupBy("sid").agg(F.sum(F.col("vid") * F.col("vid")).alias("sq"))
    a = sig.select(F.col("sid").alias("sid_a"), "j", F.col("vid").alias("va"))
    b = sig.select(F.col("sid").alias("sid_b"), "j", F.col("vid").alias("vb"))
    j = pairs.select("sid_a", "sid_b").join(a, "sid_a").join(b, ["sid_b", "j"])
    agg = j.groupBy("sid_a", "sid_b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"),
                                          F.sum((F.col("va") == F.col("vb")).cast("int")).alias("eq"))
    agg = (agg.join(sq.select(F.col("sid").alias("sid_a"), F.col("sq").alias("sqa")), "sid_a")
           .join(sq.select(F.col("sid").alias("sid_b"), F.col("sq").alias("sqb")), "sid_b"))
    return agg.select("sid_a", "sid_b", cosine_from_sums(F.col("dot"), F.col("sqa"), F.col("sqb")).alias("cosine"),
                      (F.col("eq") / F.lit(float(P.num_perm))).alias("agreement"))


def q_doc_edit_scores(spark, sf):
    return jobs.edit_scores(jobs.Corpus.of(_docs(spark, sf), P.k), P)


def q_doc_lsh_scores(spark, sf):
    return jobs.lsh_scores(jobs.Corpus.of(_docs(spark, sf), P.k), P)


def q_doc_scores(spark, sf):
    return jobs.compare_corpus(_docs(spark, sf), P)


def q_flagged_documents(spark, sf):
    return jobs.flagged_pairs(_docs(spark, sf), P)


def q_doc_report(spark, sf):
    s = q_doc_scores(spark, sf)
    return s.select("doc1", "doc2", fixed4(F.col("lsh_similarity")).alias("lsh_text"),
                    fixed4(F.col("edit_similarity")).alias("edit_text"),
                    fixed4(F.col("overall_similarity")).alias("overall_text"),
                    verdict(F.col("flagged")).alias("verdict"))


def q_lsh_edit_pairs(spark, sf):
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    return jobs.edit_pairs(c, P, "banded")


def q_hamming_edit_pairs(spark, sf):
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    return jobs.edit_pairs(c, P, "hamming")


def q_lsh_jaccard_pairs(spark, sf):
    c = jobs.Corpus.of(_docs(spark, sf), P.k)
    return jobs.jaccard_pairs(c, P, "banded")


def q_doc_scores_banded(spark, sf):
    return jobs.compare_corpus(_docs(spark, sf), P, "banded")


def q_cross_corpus(spark, sf):
    right = read_documents(spark, sf, "benchmark", id_col="item_id")
    return jobs.compare_corpora(_docs(spark, sf), right, P)


def q_score_pairs(spark, sf):
    """The pairs of ``cross_corpus`` with the original's pair-scoped score beside the Jaccard score."""
    left, right = _docs(spark, sf), read_documents(spark, sf, "benchmark", id_col="item_id")
    pairs = materialize(jobs.compare_corpora(left, right, P).select("doc1", "doc2", F.col("lsh_similarity").alias("jaccard_similarity")), "pairs")
    s = jobs.score_pairs(left, right, pairs, P).withColumnRenamed("lsh_similarity", "dense_similarity")
    return s.join(pairs, ["doc1", "doc2"])


def q_compare_two(spark, sf):
    """Two-file mode on the two documents with the most sentences (of equal ones the smaller id)."""
    docs = _docs(spark, sf)
    two = sentence_counts(docs).orderBy(F.col("n_sentences").desc(), "doc_id").limit(2)
    return jobs.score_pairs(docs, docs, two.agg(F.min("doc_id").alias("doc1"), F.max("doc_id").alias("doc2")), P)


def q_line_edit_distance(spark, sf):
    """Classic mode over conversations: similar turns of one conversation, with the line of the listing."""
    turns = read_table(spark, sf, "conversations").select(F.col("conv_id").alias("grp"), F.col("turn").alias("line"), "text")
    p = edit_join.similar_lines(turns, LISTED_SIMILARITY, P.block_rows)
    return edit_distance_lines(p.withColumnRenamed("grp", "conv_id").select("conv_id", "line_a", "line_b", "distance", "similarity"))


def q_line_cosine(spark, sf):
    """Classic mode's cosine listing over conversations: turns of one conversation with similar dense vectors."""
    turns = read_table(spark, sf, "conversations").select(F.col("conv_id").alias("grp"), F.col("turn").alias("line"), "text")
    return cosine_lines(similar_lines_cosine(turns, P.sim_threshold, P.k, P.block_rows).withColumnRenamed("grp", "conv_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_documents": q_src_documents,
    "ascii_lower": q_ascii_lower,
    "sentences": q_sentences,
    "sentence_lengths": q_sentence_lengths,
    "sentence_counts": q_sentence_counts,
    "shingles": q_shingles,
    "shingle_weights": q_shingle_weights,
    "shingle_sets": q_shingle_sets,
    "shingle_sets_weighted": q_shingle_sets_weighted,
    "shingle_stats": q_shingle_stats,
    "vocabulary": q_vocabulary,
    "sentence_membership": q_sentence_membership,
    "minhash_dense": q_minhash_dense,
    "signature_norms": q_signature_norms,
    "embedding_norms": q_embedding_norms,
    "embedding_cosine": q_embedding_cosine,
    "similar_sentence_pairs": q_similar_sentence_pairs,
    "similar_jaccard_pairs": q_similar_jaccard_pairs,
    "signature_similarity": q_signature_similarity,
    "doc_edit_scores": q_doc_edit_scores,
    "doc_lsh_scores": q_doc_lsh_scores,
    "doc_scores": q_doc_scores,
    "flagged_documents": q_flagged_documents,
    "doc_report": q_doc_report,
    "cross_corpus": q_cross_corpus,
    "score_pairs": q_score_pairs,
    "compare_two": q_compare_two,
    "line_edit_distance": q_line_edit_distance,
    "line_cosine": q_line_cosine,
    "lsh_edit_pairs": q_lsh_edit_pairs,
    "hamming_edit_pairs": q_hamming_edit_pairs,
    "lsh_jaccard_pairs": q_lsh_jaccard_pairs,
    "doc_scores_banded": q_doc_scores_banded,
}

ORACLES: dict[str, str] = {
    "src_documents": osql.SRC_DOCUMENTS,
    "ascii_lower": osql.ASCII_LOWER,
    "sentences": osql.SENTENCES,
    "sentence_lengths": osql.SENTENCE_LENGTHS,
    "sentence_counts": osql.SENTENCE_COUNTS,
    "shingles": osql.SHINGLES,
    "shingle_weights": osql.SHINGLE_WEIGHTS,
    "shingle_sets": osql.SHINGLE_SETS,
    "shingle_sets_weighted": osql.SHINGLE_SETS_WEIGHTED,
    "shingle_stats": osql.SHINGLE_STATS,
    "vocabulary": osql.VOCABULARY,
    "sentence_membership": osql.SENTENCE_MEMBERSHIP,
    "minhash_dense": osql.minhash_dense(P.num_perm, P.seed),
    "signature_norms": osql.signature_norms(P.num_perm, P.seed),
    "embedding_norms": osql.EMBEDDING_NORMS,
    "embedding_cosine": osql.EMBEDDING_COSINE,
    "similar_sentence_pairs": osql.SIMILAR_SENTENCE_PAIRS,
    "similar_jaccard_pairs": osql.SIMILAR_JACCARD_PAIRS,
    "signature_similarity": osql.signature_similarity(P.num_perm, P.seed),
    "doc_edit_scores": osql.DOC_EDIT_SCORES,
    "doc_lsh_scores": osql.DOC_LSH_SCORES,
    "doc_scores": osql.DOC_SCORES,
    "flagged_documents": osql.FLAGGED_DOCUMENTS,
    "doc_report": osql.DOC_REPORT,
    "cross_corpus": osql.CROSS_CORPUS,
    "score_pairs": osql.SCORE_PAIRS,
    "compare_two": osql.COMPARE_TWO,
    "line_edit_distance": osql.LINE_EDIT_DISTANCE,
    "line_cosine": osql.LINE_COSINE,
    "lsh_edit_pairs": osql.lsh_edit_pairs(P.bands * P.rows, P.seed, P.bands, P.rows),
    "hamming_edit_pairs": osql.HAMMING_EDIT_PAIRS,
    "lsh_jaccard_pairs": osql.lsh_jaccard_pairs(P.bands * P.rows, P.seed, P.bands, P.rows),
    "doc_scores_banded": osql.doc_scores_banded(P.bands * P.rows, P.seed, P.bands, P.rows),
}
