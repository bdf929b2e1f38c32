"""DuckDB SQL that recomputes each registered query from the raw tables.

Plain joins and window functions; constants are stated here on their own and none of the engine's is imported. Brute
force where it is affordable. The oracles of the corpus-wide joins skip pairs by necessary conditions (length and
byte counts for the edit distance, prefixes for Jaccard); ``tests`` compare those joins with brute force without them.
The banded queries are approximate by definition, so their oracles make the same bands.
"""

from __future__ import annotations

import random

from textoverlap.config import REPORT_NEGATIVE, REPORT_POSITIVE  # fixed sentences, stated once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRIME = 2147483647
T = 0.7
# classes of bytes whose counts bound an edit distance
HIST_CLASSES = [(c, c) for c in LOWER] + [("sp", " "), ("dg", "[0-9]")]


def sentences_cte(table: str = "documents", id_col: str = "doc_id", name: str = "sents") -> str:
    return f"""
{name}_arr AS (
  SELECT {id_col} AS doc_id,
         list_slice(list_filter(list_transform(
             regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.!?]+'),
             lambda x: regexp_replace(x, '^[ \\n\\r\\t]+', '')), lambda x: x <> ''),
           1, length(regexp_extract_all(text, '[.!?]'))) AS arr,
         length(regexp_extract_all(text, '[.!?]')) AS n_delimiters
  FROM {table}),
{name} AS (
  SELECT doc_id, pos, text, strlen(text) AS n_bytes, length(text) AS n_chars
  FROM (SELECT doc_id, unnest(arr) AS text, generate_subscripts(arr, 1) AS pos FROM {name}_arr))"""


def shingles_cte(src: str = "sents", name: str = "shing") -> str:
    return f"""
{name} AS (
  SELECT doc_id, pos, spos, shingle, ('0x' || shingle)::BIGINT AS code,
         ('0x' || substr(shingle, 1, 2))::INT * 1 + ('0x' || substr(shingle, 3, 2))::INT * 2
           + ('0x' || substr(shingle, 5, 2))::INT * 3 AS weight
  FROM (SELECT doc_id, pos, spos, substr(hex(text), 2 * spos - 1, 6) AS shingle
        FROM (SELECT doc_id, pos, text, unnest(range(1, n_bytes - 1)) AS spos FROM {src} WHERE n_bytes >= 3)))"""


def q(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


SRC_DOCUMENTS = """SELECT doc_id, strlen(text) AS n_bytes, length(text) AS n_chars,
  length(regexp_extract_all(text, '[.!?]')) AS n_delimiters FROM documents"""

ASCII_LOWER = f"SELECT doc_id, translate(text, '{UPPER}', '{LOWER}') AS text_lower FROM documents"

SENTENCES = q("SELECT doc_id, pos, text, n_bytes FROM sents", sentences_cte())
SENTENCE_LENGTHS = q("SELECT doc_id, pos, n_bytes, n_chars FROM sents", sentences_cte())
SENTENCE_COUNTS = q("SELECT doc_id, coalesce(len(arr), 0) AS n_sentences, coalesce(n_delimiters, 0) AS n_delimiters "
                    "FROM sents_arr", sentences_cte())
SHINGLES = q("SELECT doc_id, pos, spos, shingle, code FROM shing", sentences_cte(), shingles_cte())
SHINGLE_WEIGHTS = q("SELECT doc_id, pos, spos, weight FROM shing", sentences_cte(), shingles_cte())

_SET_EXACT = """
set_exact AS (
  SELECT doc_id, pos, spos, shingle, code FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, pos, code ORDER BY spos) AS rn FROM shing) WHERE rn = 1)"""
_SET_WEIGHTED = """
set_weighted AS (
  SELECT doc_id, pos, spos, shingle, code FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, pos, weight ORDER BY spos) AS rn FROM shing) WHERE rn = 1)"""

SHINGLE_SETS = q("SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, pos ORDER BY spos) AS rank, "
                 "code, shingle FROM set_exact", sentences_cte(), shingles_cte(), _SET_EXACT)
SHINGLE_SETS_WEIGHTED = q("SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, pos ORDER BY spos) AS rank, "
                          "code, shingle FROM set_weighted", sentences_cte(), shingles_cte(), _SET_WEIGHTED)
SHINGLE_STATS = q("""SELECT s.doc_id, s.pos,
  coalesce(a.n, 0) AS n_shingles, coalesce(b.n, 0) AS n_set_exact, coalesce(c.n, 0) AS n_set_weighted
FROM sents s
LEFT JOIN (SELECT doc_id, pos, count(*) n FROM shing GROUP BY ALL) a USING (doc_id, pos)
LEFT JOIN (SELECT doc_id, pos, count(*) n FROM set_exact GROUP BY ALL) b USING (doc_id, pos)
LEFT JOIN (SELECT doc_id, pos, count(*) n FROM set_weighted GROUP BY ALL) c USING (doc_id, pos)""",
                  sentences_cte(), shingles_cte(), _SET_EXACT, _SET_WEIGHTED)

_VOCAB = """
vocab AS (
  SELECT code, shingle, doc_id AS first_doc_id, pos AS first_pos, spos AS first_spos, n_occurrences,
         row_number() OVER (ORDER BY doc_id, pos, spos) AS vid
  FROM (SELECT code, shingle, doc_id, pos, spos, count(*) OVER (PARTITION BY code) AS n_occurrences,
               row_number() OVER (PARTITION BY code ORDER BY doc_id, pos, spos) AS rn FROM shing) WHERE rn = 1)"""
VOCABULARY = q("SELECT vid, code, shingle, first_doc_id, first_pos, first_spos, n_occurrences FROM vocab",
               sentences_cte(), shingles_cte(), _VOCAB)
_MEMBERS = """
members AS (SELECT w.doc_id, w.pos, v.vid FROM set_weighted w JOIN vocab v USING (code))"""
SENTENCE_MEMBERSHIP = q("SELECT doc_id, pos, vid FROM members",
                        sentences_cte(), shingles_cte(), _SET_WEIGHTED, _VOCAB, _MEMBERS)


def _perms_cte(num_perm: int, seed: int) -> str:
    draw = random.Random(seed)
    vals = ", ".join(f"({j}, {draw.randrange(1, PRIME)}, {draw.randrange(0, PRIME)})" for j in range(1, num_perm + 1))
    return f"\nperms(j, a, b) AS (VALUES {vals})"


def _sig_cte(num_perm: int, seed: int, src: str = "members", keys: str = "doc_id, pos") -> str:
    return f"""
sig AS (
  SELECT {keys}, j, arg_min(vid, (a * vid + b) % {PRIME}) AS vid
  FROM {src} CROSS JOIN perms GROUP BY ALL)"""


def minhash_dense(num_perm: int, seed: int) -> str:
    return q("SELECT doc_id, pos, j, vid FROM sig", sentences_cte(), shingles_cte(), _SET_WEIGHTED, _VOCAB,
             _MEMBERS, _perms_cte(num_perm, seed), _sig_cte(num_perm, seed))


def signature_norms(num_perm: int, seed: int) -> str:
    return q("SELECT doc_id, pos, sum(vid * vid) AS sq_norm, sqrt(sum(vid * vid)::DOUBLE) AS norm FROM sig GROUP BY ALL",
             sentences_cte(), shingles_cte(), _SET_WEIGHTED, _VOCAB, _MEMBERS, _perms_cte(num_perm, seed),
             _sig_cte(num_perm, seed))


EMBEDDING_NORMS = """SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm
FROM embeddings"""


# --- similarity joins -------------------------------------------------------

def _hist_cols(col: str = "text") -> str:
    parts = []
    for n, p in HIST_CLASSES:
        if len(p) == 1 and p.isalpha():
            parts.append(f"length({col}) - length(replace({col}, '{p}', '')) AS h_{n}")
        else:
            parts.append(f"length({col}) - length(regexp_replace({col}, '{p}', '', 'g')) AS h_{n}")
    parts.append(f"strlen({col}) - length(regexp_replace({col}, '[^\\x00-\\x7F]', '', 'g')) AS h_na")
    return ", ".join(parts)


_HN = ["h_" + n for n, _ in HIST_CLASSES] + ["h_na"]


def _edit_pairs_cte(src: str = "sents", name: str = "edit_pairs", src_b: str | None = None) -> str:
    """Brute force over pairs whose byte lengths lie in the same or adjacent
    log-length buckets (a necessary condition for similarity >= T); a
    byte-class histogram bound (exact) guards the Levenshtein call.
    src_b given: R x S, else self-join."""
    l1 = " + ".join(f"abs(a.{h} - b.{h})" for h in _HN)
    oth = lambda s: f"({s}.n - (" + " + ".join(f"{s}.{h}" for h in _HN) + "))"
    l1 = f"{l1} + abs({oth('a')} - {oth('b')})"
    lmax = "greatest(a.n, b.n)"
    slack = f"({1 - T} * {lmax} + 1.0)"
    bucket = f"floor(ln(strlen(text)) / ln(1.0 / {T - 0.01}))::INT AS bucket"
    feats = f"SELECT md5(text) AS sid, text, strlen(text) AS n, {bucket}, {_hist_cols()}"
    keep = f"abs(a.n - b.n) <= {slack} AND ({l1} + abs(a.n - b.n)) / 2 <= {slack}"
    feats = feats.replace("SELECT md5", "SELECT row_number() OVER () AS rid, md5", 1)
    pairs = lambda other, on: f"SELECT a.rid AS ra, b.rid AS rb FROM {name}_d a JOIN {other} b ON {on} WHERE {keep}"
    # pairs of row numbers are materialised first, so that the distances are computed by all threads
    if src_b:
        other = f"{name}_db"
        extra = f"\n{other} AS MATERIALIZED ({feats} FROM (SELECT DISTINCT text FROM {src_b})),"
        near = [pairs(other, f"b.bucket = a.bucket + {i}") for i in (0, 1, -1)]
        first, second = "a", "b"
    else:
        other, extra = f"{name}_d", ""
        near = [pairs(other, "b.bucket = a.bucket AND a.rid < b.rid"), pairs(other, "b.bucket = a.bucket + 1")]
        first, second = "CASE WHEN a.sid < b.sid THEN a.{0} ELSE b.{0} END", "CASE WHEN a.sid < b.sid THEN b.{0} ELSE a.{0} END"
    col = lambda side, c: side.format(c) if "{0}" in side else f"{side}.{c}"
    return f"""
{name}_d AS MATERIALIZED ({feats} FROM (SELECT DISTINCT text FROM {src})),{extra}
{name}_p AS MATERIALIZED ({" UNION ALL ".join(near)}),
{name}_c AS (
  SELECT {col(first, "sid")} AS sid_a, {col(second, "sid")} AS sid_b, {col(first, "n")} AS len_a, {col(second, "n")} AS len_b,
         levenshtein(a.text, b.text) AS distance
  FROM {name}_p p JOIN {name}_d a ON a.rid = p.ra JOIN {other} b ON b.rid = p.rb),
{name} AS MATERIALIZED (
  SELECT sid_a, sid_b, len_a, len_b, distance, 1.0 - distance / greatest(len_a, len_b)::DOUBLE AS similarity
  FROM {name}_c WHERE 1.0 - distance / greatest(len_a, len_b)::DOUBLE >= {T})"""


SIMILAR_SENTENCE_PAIRS = q("SELECT * FROM edit_pairs", sentences_cte(), _edit_pairs_cte())


# brute force over all turn pairs of a conversation
LINE_EDIT_DISTANCE = f"""
WITH l AS (SELECT conv_id, turn, regexp_replace(translate(text, '{UPPER}', '{LOWER}'), '^ ', '') AS t FROM conversations),
p AS (SELECT a.conv_id, a.turn AS line_a, b.turn AS line_b, levenshtein(a.t, b.t) AS distance,
        greatest(strlen(a.t), strlen(b.t)) AS longest
      FROM l a JOIN l b ON a.conv_id = b.conv_id AND a.turn < b.turn WHERE strlen(a.t) > 0 AND strlen(b.t) > 0)
SELECT conv_id, line_a, line_b, distance, 1.0 - distance / longest::DOUBLE AS similarity,
  printf('Edit Distance between sentence %d and %d is %d.', line_a, line_b, distance) AS line
FROM p WHERE 1.0 - distance / longest::DOUBLE >= 0.3"""


# vocabulary and as many permutations as lines for each conversation, every pair of turns
LINE_COSINE = f"""
WITH l AS MATERIALIZED (
  SELECT conv_id, turn, t, count(*) OVER (PARTITION BY conv_id) AS n
  FROM (SELECT conv_id, turn, regexp_replace(translate(text, '{UPPER}', '{LOWER}'), '^ ', '') AS t FROM conversations)
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND t IS NOT NULL),
sh AS MATERIALIZED (
  SELECT conv_id, turn, n, spos, x AS code, ('0x' || substr(x, 1, 2))::INT + ('0x' || substr(x, 3, 2))::INT * 2
         + ('0x' || substr(x, 5, 2))::INT * 3 AS weight
  FROM (SELECT *, substr(hex(t), 2 * spos - 1, 6) AS x FROM (SELECT *, unnest(range(1, strlen(t) - 1)) AS spos FROM l WHERE strlen(t) >= 3))),
v AS (SELECT conv_id, code, row_number() OVER (PARTITION BY conv_id ORDER BY f) AS vid
      FROM (SELECT conv_id, code, min((turn, spos)) AS f FROM sh GROUP BY ALL)),
pm AS MATERIALIZED (SELECT w.conv_id, w.turn, w.n, v.vid FROM (SELECT conv_id, turn, n, weight, arg_min(code, spos) AS code FROM sh GROUP BY ALL) w
       JOIN v ON v.conv_id = w.conv_id AND v.code = w.code),
perm AS (
  SELECT j, 1 + ((j * j % 2147483647) * 48271 + j * 16807 + 20240601) % 2147483646 AS a,
         ((j * j % 2147483647) * 69621 + j * 40692 + 1062042) % 2147483647 AS b FROM (SELECT unnest(range(1, (SELECT max(n) FROM pm) + 1)) AS j)),
sig AS (SELECT conv_id, turn, j, arg_min(vid, (a * vid + b) % 2147483647) AS vid FROM pm JOIN perm ON j <= n GROUP BY ALL),
vec AS MATERIALIZED (SELECT conv_id, turn, list(vid::DOUBLE ORDER BY j) AS v, sqrt(sum(vid * vid)::DOUBLE) AS norm FROM sig GROUP BY ALL),
p AS (SELECT a.conv_id, a.turn AS line_a, b.turn AS line_b, list_dot_product(a.v, b.v) / (a.norm * b.norm) AS cosine
      FROM vec a JOIN vec b ON a.conv_id = b.conv_id AND a.turn < b.turn)
SELECT *, printf('Cosine Similarity between Sentence %d and %d is %f.', line_a, line_b, cosine) AS line FROM p WHERE cosine >= 0.7"""


def _sets_cte(src: str = "sents", name: str = "sets") -> str:
    return f"""
{name}_tok AS (
  SELECT DISTINCT md5(text) AS sid, ('0x' || substr(hex(text), 2 * spos - 1, 6))::BIGINT AS code
  FROM (SELECT text, unnest(range(1, n_bytes - 1)) AS spos FROM (SELECT DISTINCT text, n_bytes FROM {src}) WHERE n_bytes >= 3)),
{name} AS (SELECT sid, count(*) AS n FROM {name}_tok GROUP BY sid)"""


def _jaccard_pairs_cte(name: str = "jac_pairs", a: str = "sets", b: str | None = None) -> str:
    """Prefix-filter candidates (exact for Jaccard >= T), verified by counting
    shared tokens with a join."""
    b = b or a
    self_join = b == a
    freq_src = f"SELECT code FROM {a}_tok" + ("" if self_join else f" UNION ALL SELECT code FROM {b}_tok")
    cond = "pa.sid < pb.sid AND " if self_join else ""
    return f"""
{name}_df AS (SELECT code, count(*) AS df FROM ({freq_src}) GROUP BY code),
{name}_pa AS MATERIALIZED (
  SELECT t.sid, t.code, s.n, t.r FROM (SELECT t.*, row_number() OVER (PARTITION BY t.sid ORDER BY f.df, t.code) AS r
     FROM {a}_tok t JOIN {name}_df f USING (code)) t JOIN {a} s USING (sid)
  WHERE r <= s.n - ceil(s.n * {T} - 1e-9) + 1),
{name}_pb AS MATERIALIZED (
  SELECT t.sid, t.code, s.n, t.r FROM (SELECT t.*, row_number() OVER (PARTITION BY t.sid ORDER BY f.df, t.code) AS r
     FROM {b}_tok t JOIN {name}_df f USING (code)) t JOIN {b} s USING (sid)
  WHERE r <= s.n - ceil(s.n * {T} - 1e-9) + 1),
{name}_cand AS MATERIALIZED (
  SELECT DISTINCT pa.sid AS sid_a, pb.sid AS sid_b, pa.n AS size_a, pb.n AS size_b
  FROM {name}_pa pa JOIN {name}_pb pb ON {cond}pa.code = pb.code
  WHERE least(pa.n, pb.n) >= greatest(pa.n, pb.n) * {T} - 1e-9
    AND 1 + least(pa.n - pa.r, pb.n - pb.r) >= {T / (1 + T)} * (pa.n + pb.n) - 1e-9),
{name}_la AS MATERIALIZED (SELECT sid, list(code) AS toks FROM {a}_tok GROUP BY sid),
{name}_lb AS MATERIALIZED (SELECT sid, list(code) AS toks FROM {b}_tok GROUP BY sid),
{name} AS MATERIALIZED (
  SELECT sid_a, sid_b, size_a, size_b, intersection, intersection / (size_a + size_b - intersection)::DOUBLE AS jaccard
  FROM (SELECT c.sid_a, c.sid_b, c.size_a, c.size_b, len(list_intersect(la.toks, lb.toks)) AS intersection
        FROM {name}_cand c JOIN {name}_la la ON la.sid = c.sid_a JOIN {name}_lb lb ON lb.sid = c.sid_b)
  WHERE intersection / (size_a + size_b - intersection)::DOUBLE >= {T})"""


SIMILAR_JACCARD_PAIRS = q("SELECT * FROM jac_pairs", sentences_cte(), _sets_cte(), _jaccard_pairs_cte())


# --- document scores ---------------------------------------------------------

_POST = """
post AS MATERIALIZED (SELECT md5(text) AS sid, doc_id, count(*) AS mult FROM sents GROUP BY ALL),
ndoc AS MATERIALIZED (SELECT doc_id, coalesce(len(arr), 0) AS n FROM sents_arr)"""


def _pair_scores(name: str, pairs: str, self_sids: str) -> str:
    return f"""
{name}_e AS (SELECT sid_a AS x, sid_b AS y FROM {pairs} UNION ALL SELECT sid_b, sid_a FROM {pairs}
             UNION ALL SELECT sid, sid FROM ({self_sids})),
{name}_e1 AS MATERIALIZED (
  SELECT e.y, p1.doc_id AS doc1, p1.mult AS m1 FROM {name}_e e JOIN post p1 ON p1.sid = e.x),
{name}_cnt AS MATERIALIZED (
  SELECT e1.doc1, p2.doc_id AS doc2, sum(e1.m1 * p2.mult) AS similar_pairs
  FROM {name}_e1 e1 JOIN post p2 ON p2.sid = e1.y
  WHERE e1.doc1 < p2.doc_id GROUP BY e1.doc1, p2.doc_id),
{name}_scores AS MATERIALIZED (
  SELECT c.doc1, c.doc2, a.n AS n1, b.n AS n2, c.similar_pairs AS {name}_pairs,
         c.similar_pairs / (a.n::BIGINT * b.n)::DOUBLE AS {name}_similarity
  FROM {name}_cnt c JOIN ndoc a ON a.doc_id = c.doc1 JOIN ndoc b ON b.doc_id = c.doc2)"""


_EDIT_SCORES = _pair_scores("edit", "edit_pairs", "SELECT DISTINCT md5(text) AS sid FROM sents")
_LSH_SCORES = _pair_scores("lsh", "jac_pairs", "SELECT sid FROM sets")

DOC_EDIT_SCORES = q("SELECT * FROM edit_scores", sentences_cte(), _POST, _edit_pairs_cte(), _EDIT_SCORES)
DOC_LSH_SCORES = q("SELECT * FROM lsh_scores", sentences_cte(), _POST, _sets_cte(), _jaccard_pairs_cte(),
                   _LSH_SCORES)

_COMBINED = """
combined AS (
  SELECT coalesce(l.doc1, e.doc1) AS doc1, coalesce(l.doc2, e.doc2) AS doc2,
         coalesce(l.n1, e.n1) AS n1, coalesce(l.n2, e.n2) AS n2,
         coalesce(l.lsh_similarity, 0.0) AS lsh_similarity, coalesce(e.edit_similarity, 0.0) AS edit_similarity,
         (coalesce(l.lsh_similarity, 0.0) + coalesce(e.edit_similarity, 0.0)) / 2.0 AS overall_similarity
  FROM lsh_scores l FULL OUTER JOIN edit_scores e ON l.doc1 = e.doc1 AND l.doc2 = e.doc2)"""

_ALL_SCORES = (sentences_cte(), _POST, _edit_pairs_cte(), _EDIT_SCORES, _sets_cte(), _jaccard_pairs_cte(),
               _LSH_SCORES, _COMBINED)
DOC_SCORES = q("SELECT *, overall_similarity >= 0.5 AS flagged FROM combined", *_ALL_SCORES)
FLAGGED_DOCUMENTS = q("SELECT *, true AS flagged FROM combined WHERE overall_similarity >= 0.5", *_ALL_SCORES)
DOC_REPORT = q(f"""SELECT doc1, doc2, printf('%.4f', lsh_similarity) AS lsh_text, printf('%.4f', edit_similarity) AS edit_text,
  printf('%.4f', overall_similarity) AS overall_text,
  CASE WHEN overall_similarity >= 0.5
       THEN '{REPORT_POSITIVE}'
       ELSE '{REPORT_NEGATIVE}' END AS verdict
FROM combined""", *_ALL_SCORES)


def _rs_scores(name: str, pairs: str) -> str:
    return f"""
{name}_cnt AS MATERIALIZED (
  SELECT p1.doc_id AS doc1, p2.doc_id AS doc2, sum(p1.mult * p2.mult) AS similar_pairs
  FROM {pairs} e JOIN post p1 ON p1.sid = e.sid_a JOIN post_b p2 ON p2.sid = e.sid_b GROUP BY ALL),
{name}_scores AS MATERIALIZED (
  SELECT c.doc1, c.doc2, a.n AS n1, b.n AS n2, c.similar_pairs AS {name}_pairs,
         c.similar_pairs / (a.n::BIGINT * b.n)::DOUBLE AS {name}_similarity
  FROM {name}_cnt c JOIN ndoc a ON a.doc_id = c.doc1 JOIN ndoc_b b ON b.doc_id = c.doc2)"""


_POST_B = """
post_b AS (SELECT md5(text) AS sid, doc_id, count(*) AS mult FROM bsents GROUP BY ALL),
ndoc_b AS (SELECT doc_id, coalesce(len(arr), 0) AS n FROM bsents_arr)"""

CROSS_CORPUS = q("SELECT *, overall_similarity >= 0.5 AS flagged FROM combined",
                 sentences_cte(), sentences_cte("benchmark", "item_id", "bsents"), _POST, _POST_B,
                 _edit_pairs_cte("sents", "edit_pairs", "bsents"), _rs_scores("edit", "edit_pairs"),
                 _sets_cte(), _sets_cte("bsents", "bsets"), _jaccard_pairs_cte("jac_pairs", "sets", "bsets"),
                 _rs_scores("lsh", "jac_pairs"), _COMBINED)


def _pair_scope(right: str = "sents", counts: str = "ndoc") -> tuple[str, ...]:
    """Both scores of the rows of ``pairs``, every cross pair of sentences compared: vocabulary and permutations of one pair."""
    return (f"""
pn AS MATERIALIZED (SELECT p.doc1, p.doc2, a.n AS n1, b.n AS n2 FROM pairs p JOIN ndoc a ON a.doc_id = p.doc1 JOIN {counts} b ON b.doc_id = p.doc2),
ps AS MATERIALIZED (
  SELECT p.doc1, p.doc2, 1 AS side, s.pos, s.text, s.n_bytes AS n FROM pairs p JOIN sents s ON s.doc_id = p.doc1
  UNION ALL SELECT p.doc1, p.doc2, 2, s.pos, s.text, s.n_bytes FROM pairs p JOIN {right} s ON s.doc_id = p.doc2),
psh AS MATERIALIZED (
  SELECT doc1, doc2, side, pos, spos, x AS code, ('0x' || substr(x, 1, 2))::INT + ('0x' || substr(x, 3, 2))::INT * 2
         + ('0x' || substr(x, 5, 2))::INT * 3 AS weight
  FROM (SELECT *, substr(hex(text), 2 * spos - 1, 6) AS x FROM (SELECT *, unnest(range(1, n - 1)) AS spos FROM ps WHERE n >= 3))),
pv AS MATERIALIZED (
  SELECT doc1, doc2, code, row_number() OVER (PARTITION BY doc1, doc2 ORDER BY f) AS vid
  FROM (SELECT doc1, doc2, code, min((side, pos, spos)) AS f FROM psh GROUP BY ALL)),
pm AS MATERIALIZED (
  SELECT w.doc1, w.doc2, w.side, w.pos, v.vid, pn.n1 + pn.n2 AS n
  FROM (SELECT doc1, doc2, side, pos, weight, arg_min(code, spos) AS code FROM psh GROUP BY ALL) w
  JOIN pv v ON v.doc1 = w.doc1 AND v.doc2 = w.doc2 AND v.code = w.code JOIN pn ON pn.doc1 = w.doc1 AND pn.doc2 = w.doc2),
{_PAIR_PERMS},
psig AS MATERIALIZED (
  SELECT doc1, doc2, side, pos, j, min(((a * vid + b) % 2147483647) * 4294967296 + vid) % 4294967296 AS vid
  FROM pm JOIN perm ON j <= n GROUP BY ALL),
pvec AS MATERIALIZED (
  SELECT doc1, doc2, side, pos, list(vid::DOUBLE ORDER BY j) AS v, sqrt(sum(vid * vid)::DOUBLE) AS norm FROM psig GROUP BY ALL),
pdense AS (
  SELECT a.doc1, a.doc2, count(*) AS c FROM pvec a JOIN pvec b ON a.doc1 = b.doc1 AND a.doc2 = b.doc2 AND a.side = 1 AND b.side = 2
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.7 GROUP BY ALL),
pedit AS (
  SELECT a.doc1, a.doc2, count(*) AS c FROM ps a JOIN ps b ON a.doc1 = b.doc1 AND a.doc2 = b.doc2 AND a.side = 1 AND b.side = 2
  WHERE abs(a.n - b.n) <= 0.3 * greatest(a.n, b.n) + 1 AND 1.0 - levenshtein(a.text, b.text) / greatest(a.n, b.n)::DOUBLE >= 0.7 GROUP BY ALL),
pscore AS (
  SELECT pn.doc1, pn.doc2, n1, n2, coalesce(d.c, 0) / (n1 * n2)::DOUBLE AS dense, coalesce(e.c, 0) / (n1 * n2)::DOUBLE AS edit
  FROM pn LEFT JOIN pdense d ON d.doc1 = pn.doc1 AND d.doc2 = pn.doc2 LEFT JOIN pedit e ON e.doc1 = pn.doc1 AND e.doc2 = pn.doc2)""",)


# the permutations: rank of id v under permutation j is (a * v + b) % 2147483647
_PAIR_PERMS = """
perm AS MATERIALIZED (
  SELECT j, 1 + ((j * j % 2147483647) * 48271 + j * 16807 + 20240601) % 2147483646 AS a,
         ((j * j % 2147483647) * 69621 + j * 40692 + 1062042) % 2147483647 AS b
  FROM (SELECT unnest(range(1, (SELECT max(n) FROM pm) + 1)) AS j))"""

SCORE_PAIRS = q("""SELECT s.doc1, s.doc2, s.n1, s.n2, c.lsh_similarity AS jaccard_similarity, dense AS dense_similarity, edit AS edit_similarity,
  (dense + edit) / 2.0 AS overall_similarity, (dense + edit) / 2.0 >= 0.5 AS flagged
FROM pscore s JOIN combined c ON c.doc1 = s.doc1 AND c.doc2 = s.doc2""",
                sentences_cte(), sentences_cte("benchmark", "item_id", "bsents"), _POST, _POST_B,
                _edit_pairs_cte("sents", "edit_pairs", "bsents"), _rs_scores("edit", "edit_pairs"),
                _sets_cte(), _sets_cte("bsents", "bsets"), _jaccard_pairs_cte("jac_pairs", "sets", "bsets"),
                _rs_scores("lsh", "jac_pairs"), _COMBINED.replace("combined AS (", "combined AS MATERIALIZED ("),
                "\npairs AS MATERIALIZED (SELECT doc1, doc2 FROM combined)", *_pair_scope("bsents", "ndoc_b"))

COMPARE_TWO = q("""SELECT doc1, doc2, n1, n2, dense AS lsh_similarity, edit AS edit_similarity, (dense + edit) / 2.0 AS overall_similarity,
  (dense + edit) / 2.0 >= 0.5 AS flagged FROM pscore""",
                sentences_cte(), _POST, """
pairs AS MATERIALIZED (
  SELECT min(doc_id) AS doc1, max(doc_id) AS doc2 FROM (SELECT doc_id FROM ndoc ORDER BY n DESC, doc_id LIMIT 2))""", *_pair_scope())


def signature_similarity(num_perm: int, seed: int) -> str:
    """Dense-vector cosine and signature agreement of Jaccard-similar pairs."""
    members = """
dmembers AS (
  SELECT DISTINCT md5(w.text) AS sid, v.vid FROM (SELECT s.text, w.code FROM set_weighted w
    JOIN sents s USING (doc_id, pos)) w JOIN vocab v USING (code))"""
    pairs = f"""
sq AS MATERIALIZED (SELECT sid, sum(vid * vid) AS sq FROM sig GROUP BY sid),
pa AS MATERIALIZED (SELECT p.sid_a, p.sid_b, a.j, a.vid AS va FROM jac_pairs p JOIN sig a ON a.sid = p.sid_a),
pab AS MATERIALIZED (SELECT pa.sid_a, pa.sid_b, pa.va, b.vid AS vb FROM pa JOIN sig b ON b.sid = pa.sid_b AND b.j = pa.j),
dots AS (SELECT sid_a, sid_b, sum(va * vb) AS dot, sum((va = vb)::INT) AS eq FROM pab GROUP BY sid_a, sid_b)"""
    return q(f"""SELECT d.sid_a, d.sid_b, d.dot / (sqrt(na.sq::DOUBLE) * sqrt(nb.sq::DOUBLE)) AS cosine,
  d.eq / {num_perm}.0 AS agreement
FROM dots d JOIN sq na ON na.sid = d.sid_a JOIN sq nb ON nb.sid = d.sid_b""",
             sentences_cte(), shingles_cte(), _SET_WEIGHTED, _VOCAB, members, _perms_cte(num_perm, seed),
             _sig_cte(num_perm, seed, "dmembers", "sid").replace("sig AS (", "sig AS MATERIALIZED ("),
             _sets_cte(), _jaccard_pairs_cte(), pairs)


# --- banded MinHash LSH ---------------------------------------------------------

def _band_pairs_cte(num_perm: int, seed: int, bands: int, rows: int, name: str = "band_pairs") -> str:
    """Signatures over shingle codes, bands of ``rows`` values, equality join
    per band, then the exact edit-similarity test on the candidates."""
    return f"""
bsig AS MATERIALIZED (
  SELECT sid, j, arg_min(code, (a * code + b) % {PRIME}) AS code
  FROM sets_tok CROSS JOIN perms GROUP BY sid, j),
bandv AS MATERIALIZED (
  SELECT sid, (j - 1) // {rows} AS band, list(code ORDER BY j) AS vals FROM bsig WHERE j <= {bands * rows}
  GROUP BY sid, (j - 1) // {rows}),
bcand AS MATERIALIZED (
  SELECT DISTINCT a.sid AS sid_a, b.sid AS sid_b FROM bandv a JOIN bandv b
    ON a.band = b.band AND a.vals = b.vals AND a.sid < b.sid),
btext AS MATERIALIZED (SELECT DISTINCT md5(text) AS sid, text, strlen(text) AS n FROM sents),
{name}_c AS (
  SELECT c.sid_a, c.sid_b, ta.n AS len_a, tb.n AS len_b, levenshtein(ta.text, tb.text) AS distance
  FROM bcand c JOIN btext ta ON ta.sid = c.sid_a JOIN btext tb ON tb.sid = c.sid_b),
{name} AS MATERIALIZED (
  SELECT sid_a, sid_b, len_a, len_b, distance, 1.0 - distance / greatest(len_a, len_b)::DOUBLE AS similarity
  FROM {name}_c WHERE 1.0 - distance / greatest(len_a, len_b)::DOUBLE >= {T})"""


_BAND_JACCARD = f"""
band_jac AS MATERIALIZED (
  SELECT c.sid_a, c.sid_b, sa.n AS size_a, sb.n AS size_b, count(*) AS intersection,
         count(*) / (sa.n + sb.n - count(*))::DOUBLE AS jaccard
  FROM bcand c JOIN sets sa ON sa.sid = c.sid_a JOIN sets sb ON sb.sid = c.sid_b
  JOIN sets_tok ta ON ta.sid = c.sid_a JOIN sets_tok tb ON tb.sid = c.sid_b AND tb.code = ta.code
  GROUP BY c.sid_a, c.sid_b, sa.n, sb.n
  HAVING count(*) / (sa.n + sb.n - count(*))::DOUBLE >= {T})"""


def lsh_jaccard_pairs(num_perm: int, seed: int, bands: int, rows: int) -> str:
    return q("SELECT * FROM band_jac", sentences_cte(), _sets_cte(), _perms_cte(num_perm, seed),
             _band_pairs_cte(num_perm, seed, bands, rows), _BAND_JACCARD)


def lsh_edit_pairs(num_perm: int, seed: int, bands: int, rows: int) -> str:
    return q("SELECT * FROM band_pairs", sentences_cte(), _sets_cte(), _perms_cte(num_perm, seed),
             _band_pairs_cte(num_perm, seed, bands, rows))


def _mixed(*parts: str) -> str:
    """The formula of the embedding's bits and positions, as columns x0 .. x4 of one select."""
    x0 = "xor(" * (len(parts) - 1) + f"({parts[0]} + 1)::BIGINT * 73856093"
    for p, f in zip(parts[1:], (19349663, 83492791, 49979687)):
        x0 += f", ({p} + 1)::BIGINT * {f})"
    return f"""{x0} AS x0, ((x0 & 2147483647) * 2654435761) & 2147483647 AS x1, xor(x1, x1 >> 15) AS x2,
         ((x2 & 2147483647) * 2246822519) & 2147483647 AS x3, xor(x3, x3 >> 13) AS x4"""


# Bands of the embedding: 16 walks, 4 bands a walk, 4 positions a band, each sentence in its own length bucket and the next.
_HAMMING = f"""
hs AS MATERIALIZED (
  SELECT row_number() OVER ()::INT AS id, md5(text) AS sid, text, strlen(text) AS n, floor(ln(strlen(text)) / ln(1.0 / 0.69))::INT AS bucket,
         list_transform(range(strlen(text)), lambda i: ('0x' || substr(hex(text), 2 * i + 1, 2))::UTINYINT) AS bs
  FROM (SELECT DISTINCT text FROM sents)),
hsteps AS MATERIALIZED (SELECT b AS bucket, least(2048, floor(1.3 * exp(b * ln(1.0 / 0.69))) + 1)::INT AS steps
  FROM (SELECT unnest(range((SELECT max(bucket) FROM hs) + 2)) AS b)),
hpos AS MATERIALIZED (
  SELECT bucket, w, band, p, (x4 % steps)::SMALLINT AS pos FROM (
    SELECT bucket, steps, w, band, p, {_mixed("bucket", "w", "band", "p")}
    FROM hsteps, range(16) a(w), range(4) b(band), range(4) c(p))),
hlast AS MATERIALIZED (SELECT hs.id, max(pos) AS last FROM hs JOIN hpos ON hpos.bucket IN (hs.bucket, hs.bucket + 1) GROUP BY hs.id),
hwalk(id, w, j, here, c) AS (
  SELECT id, w::UTINYINT, 0::SMALLINT, 0::SMALLINT, bs[1] FROM hs, range(16) a(w)
  UNION ALL
  SELECT m.id, m.w, (m.j + 1)::SMALLINT, m.to_, CASE WHEN m.to_ < hs.n THEN hs.bs[m.to_ + 1] ELSE 0 END
  FROM (SELECT id, w, j, (here + ((x4 >> 7) & 1))::SMALLINT AS to_
        FROM (SELECT id, w, j, here, {_mixed("w", "j", "c")} FROM hwalk)) m
  JOIN hlast ON hlast.id = m.id AND m.j < hlast.last JOIN hs ON hs.id = m.id),
hseen AS MATERIALIZED (SELECT * FROM hwalk),
hkey AS MATERIALIZED (
  SELECT s.id, p.bucket, p.w, p.band, p.bucket = s.bucket AS own, string_agg(v.c::VARCHAR, ',' ORDER BY p.p) AS seen
  FROM hs s JOIN hpos p ON p.bucket IN (s.bucket, s.bucket + 1) JOIN hseen v ON v.id = s.id AND v.w = p.w AND v.j = p.pos GROUP BY ALL),
hcand AS MATERIALIZED (
  SELECT DISTINCT a.id AS ia, b.id AS ib FROM hkey a JOIN hkey b
    ON a.bucket = b.bucket AND a.w = b.w AND a.band = b.band AND a.seen = b.seen AND a.id < b.id AND (a.own OR b.own)
  JOIN hs sa ON sa.id = a.id JOIN hs sb ON sb.id = b.id WHERE abs(sa.n - sb.n) <= 0.3 * greatest(sa.n, sb.n) + 1),
ham_pairs AS MATERIALIZED (
  SELECT least(a.sid, b.sid) AS sid_a, greatest(a.sid, b.sid) AS sid_b, CASE WHEN a.sid < b.sid THEN a.n ELSE b.n END AS len_a,
         CASE WHEN a.sid < b.sid THEN b.n ELSE a.n END AS len_b, levenshtein(a.text, b.text) AS distance,
         1.0 - distance / greatest(a.n, b.n)::DOUBLE AS similarity
  FROM hcand JOIN hs a ON a.id = ia JOIN hs b ON b.id = ib WHERE 1.0 - levenshtein(a.text, b.text) / greatest(a.n, b.n)::DOUBLE >= {T})"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


HAMMING_EDIT_PAIRS = _recursive(q("SELECT * FROM ham_pairs", sentences_cte(), _HAMMING))


def doc_scores_banded(num_perm: int, seed: int, bands: int, rows: int) -> str:
    edit = _pair_scores("edit", "ham_pairs", "SELECT DISTINCT md5(text) AS sid FROM sents")
    return _recursive(q("SELECT *, overall_similarity >= 0.5 AS flagged FROM combined",
                        sentences_cte(), _POST, _sets_cte(), _perms_cte(num_perm, seed),
                        _band_pairs_cte(num_perm, seed, bands, rows), _HAMMING, edit, _BAND_JACCARD,
                        _pair_scores("lsh", "band_jac", "SELECT sid FROM sets"), _COMBINED))


EMBEDDING_COSINE = """
WITH x AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
), m AS (
  SELECT label, pos, avg(x) AS m FROM x GROUP BY label, pos
)
SELECT vec_id, x.label, round(CASE WHEN sum(x * x) = 0 OR sum(m * m) = 0 THEN 0.0
                              ELSE sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))) END, 9) AS cosine
FROM x JOIN m ON x.label IS NOT DISTINCT FROM m.label AND x.pos = m.pos
GROUP BY vec_id, x.label
"""
