"""User-level jobs composed from the operators.

* ``compare_corpus``: every document pair of one corpus with a non-zero score
  (the original's directory mode, without its 100-file cap).
* ``compare_corpora``: left corpus x right corpus (two-file mode generalised).
* ``score_pairs``: given pairs, with the original's own pair-scoped LSH score.
* ``compare_two``: two given documents of a corpus.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textoverlap.config import Params
from textoverlap.operators import banded_join, edit_join, hamming_bands, jaccard_join, pair_scores, scoring
from textoverlap.operators.blocking import salted_join, small_keys
from textoverlap.operators.line_cosine import similar_lines_cosine
from textoverlap.operators.report import cosine_lines, edit_distance_lines
from textoverlap.operators.sentences import distinct_sentences, postings, sentence_counts, sentence_id, sentences
from textoverlap.operators.shingles import set_arrays
from textoverlap.operators.vocabulary import dense_rank_by
from textoverlap.session import materialize
from textoverlap.sources import read_numbered_lines, read_paths


@dataclass
class Corpus:
    """Sentence-level views of one corpus: distinct sentences, their sets, and postings. Each is a table that is written when
    a join first reads it, and only then."""

    docs: DataFrame
    k: int = 3

    @classmethod
    def of(cls, docs: DataFrame, k: int = 3) -> "Corpus":
        return cls(docs, k)

    @cached_property
    def sents(self) -> DataFrame:
        return sentences(self.docs)

    @cached_property
    def distinct(self) -> DataFrame:
        return materialize(distinct_sentences(self.sents), "distinct_sentences")

    @cached_property
    def post(self) -> DataFrame:
        return materialize(postings(self.sents), "postings")

    @cached_property
    def counts(self) -> DataFrame:
        return materialize(sentence_counts(self.docs), "sentence_counts")

    def post_of(self, sids: DataFrame) -> DataFrame:
        """The postings of the sentences ``sids``, without those of the others."""
        met = small_keys(sids.select("sid").distinct())
        return materialize(postings(self.sents.withColumn("sid", sentence_id()).join(met, "sid", "left_semi")), "postings")

    @cached_property
    def sets(self) -> DataFrame:
        return materialize(set_arrays(self.distinct, ["sid", "n_bytes"], self.k, "exact"), "shingle_sets")


def edit_pairs(c: Corpus, p: Params = Params(), method: str = "exact") -> DataFrame:
    """Edit-similar distinct sentence pairs: ``exact`` (length-bucketed join, complete), ``hamming`` (bands of an
    edit-to-Hamming embedding, verified, misses few) or ``banded`` (MinHash LSH candidates, verified, misses many)."""
    if method == "exact":
        return edit_join.similar_edit_pairs(c.distinct, p.sim_threshold, p.block_rows)
    if method == "hamming":
        return hamming_bands.similar_edit_pairs_hamming(c.distinct, p.sim_threshold, p.block_rows)
    if method == "banded":
        return banded_join.similar_edit_pairs_banded(c.distinct, p.sim_threshold, p.bands * p.rows, p.seed,
                                                     p.bands, p.rows, p.block_rows, c.k)
    raise ValueError(method)


def edit_scores(c: Corpus, p: Params = Params(), method: str = "exact") -> DataFrame:
    pairs = materialize(edit_pairs(c, p, method), "edit_pairs")
    counts = scoring.pair_counts_self(pairs, c.distinct.select("sid"), c.post, p.block_rows)
    return scoring.ratio_scores(counts, c.counts, c.counts, "edit")


def jaccard_pairs(c: Corpus, p: Params = Params(), method: str = "exact") -> DataFrame:
    """Jaccard-similar distinct sentence pairs: ``exact`` (prefix-filter join)
    or ``banded`` (MinHash LSH candidates, verified)."""
    if method == "exact":
        return jaccard_join.similar_jaccard_pairs(c.sets, p.sim_threshold, p.block_rows)
    if method == "banded":
        return banded_join.similar_jaccard_pairs_banded(c.distinct, p.sim_threshold, p.bands * p.rows, p.seed,
                                                        p.bands, p.rows, p.block_rows, c.k)
    raise ValueError(method)


def lsh_scores(c: Corpus, p: Params = Params(), method: str = "exact") -> DataFrame:
    pairs = materialize(jaccard_pairs(c, p, method), "jaccard_pairs")
    self_sim = c.distinct.where(F.col("n_bytes") >= c.k).select("sid")  # the sentences with a set
    counts = scoring.pair_counts_self(pairs, self_sim, c.post, p.block_rows)
    return scoring.ratio_scores(counts, c.counts, c.counts, "lsh")


def compare_corpus(docs: DataFrame, p: Params = Params(), method: str = "exact") -> DataFrame:
    """``(doc1, doc2, n1, n2, lsh_similarity, edit_similarity,
    overall_similarity, flagged)`` for doc1 < doc2 with any similar pair.

    ``method``: ``exact`` joins, or ``banded``: candidates from bands, each verified; MinHash of the shingle sets for the
    Jaccard pairs, the edit-to-Hamming embedding for the edit pairs. Banded results are approximate: pairs may be missed."""
    c = Corpus.of(docs, p.k)
    by = {"exact": ("exact", "exact"), "banded": ("banded", "hamming")}[method]
    return scoring.combine(lsh_scores(c, p, by[0]), edit_scores(c, p, by[1]), p.flag_threshold)


def flagged_pairs(docs: DataFrame, p: Params = Params(), method: str = "exact") -> DataFrame:
    """The flagged rows of ``compare_corpus`` without the table of all pairs.

    The overall score is a mean, so one of the two must reach the threshold: pairs that can are found for each score, and
    only those are scored, both ways."""
    c = Corpus.of(docs, p.k)
    by = {"exact": ("exact", "exact"), "banded": ("banded", "hamming")}[method]
    found = {"lsh": (jaccard_pairs(c, p, by[0]), c.distinct.where(F.col("n_bytes") >= c.k)), "edit": (edit_pairs(c, p, by[1]), c.distinct)}
    weights = {k: materialize(scoring.all_weights(materialize(similar, k + "_pairs"), same, c.post, p.block_rows), k + "_weights")
               for k, (similar, same) in found.items()}
    reach = [scoring.reaching_pairs(w, c.post, c.counts, p.flag_threshold, p.block_rows) for w in weights.values()]
    pairs = materialize(reach[0].unionByName(reach[1]).distinct(), "reaching_pairs")
    lsh, edit = (scoring.ratio_scores(scoring.counts_of(pairs, weights[k], c.post), c.counts, c.counts, k) for k in ("lsh", "edit"))
    return scoring.combine(lsh, edit, p.flag_threshold).where("flagged")


def compare_corpora(left: DataFrame, right: DataFrame, p: Params = Params(), method: str = "exact") -> DataFrame:
    """Scores of (left document, right document) pairs with any similar pair; ``method`` as in ``compare_corpus``."""
    a, b = Corpus.of(left, p.k), Corpus.of(right, p.k)
    t, rows = p.sim_threshold, p.block_rows
    if method == "exact":
        ep = edit_join.similar_edit_pairs_rs(a.distinct, b.distinct, t, rows)
        jp = jaccard_join.similar_jaccard_pairs_rs(a.distinct, b.distinct, t, rows, p.k)
    elif method == "banded":
        ep = hamming_bands.similar_edit_pairs_hamming_rs(a.distinct, b.distinct, t, rows)
        jp = banded_join.similar_jaccard_pairs_banded_rs(a.distinct, b.distinct, t, p.bands * p.rows, p.seed, p.bands, p.rows, rows, p.k)
    else:
        raise ValueError(method)
    found = {name: materialize(pairs, name + "_pairs_rs") for name, pairs in (("edit", ep), ("lsh", jp))}
    met = found["edit"].select("sid_a", "sid_b").unionByName(found["lsh"].select("sid_a", "sid_b"))
    post = [c.post_of(met.select(F.col(sid).alias("sid"))) for c, sid in ((a, "sid_a"), (b, "sid_b"))]
    edit, lsh = (scoring.ratio_scores(scoring.pair_counts_rs(found[name], *post, rows), a.counts, b.counts, name) for name in ("edit", "lsh"))
    return scoring.combine(lsh, edit, p.flag_threshold)


def score_pairs(left: DataFrame, right: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Given pairs scored as the original scores them, zeros included: ``lsh_similarity`` is the share of sentence pairs with
    similar dense vectors, vocabulary and permutations scoped to the pair. A pair with a missing document is skipped."""
    s = pair_scores.score_pairs(left, right, pairs, p.sim_threshold, p.flag_threshold, p.k)
    return s.select("doc1", "doc2", "n1", "n2", F.col("dense_similarity").alias("lsh_similarity"), "edit_similarity",
                    "overall_similarity", "flagged")


def compare_two(docs: DataFrame, doc1, doc2, p: Params = Params()) -> DataFrame:
    """One row for the pair (doc1, doc2), zeros included (the two-file mode); none if a document is missing."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    pair = docs.sparkSession.range(1).select(F.lit(doc1).cast(kind).alias("doc1"), F.lit(doc2).cast(kind).alias("doc2"))
    return score_pairs(docs, docs, pair, p)


def compare_paths(spark: SparkSession, paths: list[str] | DataFrame, p: Params = Params(), method: str = "exact") -> DataFrame:
    """``compare_corpus`` over a list of files; pairs with a file that cannot be read are skipped (``read_paths`` tells which)."""
    docs = materialize(read_paths(spark, paths).where("status = 'ok'").select("doc_id", "text"), "path_documents")
    return compare_corpus(docs, p, method)


def line_listing(spark: SparkSession, paths: str | list[str], edit: float = 0.7, cosine: float = 0.7, p: Params = Params()) -> DataFrame:
    """Classic mode over files of numbered lines: ``file, kind, line_a, line_b, line`` of the line pairs of a file that are
    similar by edit distance (``kind`` 1) or by the cosine of dense vectors (2); lines are numbered by their position."""
    lines = materialize(read_numbered_lines(spark, paths).select("file", F.col("position").alias("line"), "text"), "numbered_lines")
    files = materialize(dense_rank_by(lines.select("file").distinct(), ["file"], "grp"), "files")
    own = salted_join(lines, files, ["file"], "line", p.salt_rows).select("grp", "line", "text")
    one = edit_distance_lines(edit_join.similar_lines(own, edit, p.block_rows)).select("grp", F.lit(1).alias("kind"), "line_a", "line_b", "line")
    two = cosine_lines(similar_lines_cosine(own, cosine, p.k, p.block_rows)).select("grp", F.lit(2).alias("kind"), "line_a", "line_b", "line")
    found = one.unionByName(two)
    return salted_join(found, files, ["grp"], "line_a", p.salt_rows).select("file", "kind", "line_a", "line_b", "line")
