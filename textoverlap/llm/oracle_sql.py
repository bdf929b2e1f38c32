"""DuckDB SQL for the queries that SQL can express; constants are stated here on their own."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

OP9 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), hit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN hit USING (page_id)
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") AS number
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, 3 * source_size AS most FROM s
), o AS (  -- in the order in which sources reach their limit
  SELECT *, row_number() OVER ranked AS j, coalesce(sum(most) OVER (ranked ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ranked ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(source_size) OVER () AS budget
  FROM w WINDOW ranked AS (ORDER BY most / weight, number)
), l AS (
  SELECT min_by(CAST(budget - spent AS DOUBLE) / open, j) AS level
  FROM o WHERE NOT CAST(budget - spent AS DOUBLE) / open * weight > most
), t AS (
  SELECT source, source_size, CASE WHEN level * weight > most THEN CAST(most AS DOUBLE) ELSE level * weight END AS target FROM w, l
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY t.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * least(whole + CASE WHEN target - whole * source_size > 0 AND upto - size / 2.0 <= target - whole * source_size
                                      THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM c
"""

_STOP = ("the of and to in that is was with for der die und das ist von mit den nicht ein de la le et les des est "
         "que un une el los las del por con para una y en").split()
_VOTES = [  # good when, bad when
    ("symbol_ratio <= 0.02", "symbol_ratio > 0.1"), ("letter_ratio >= 0.92", "letter_ratio < 0.87"), ("stop_kinds >= 3", "stop_kinds < 1"),
    ("false", "dup_line_ratio > 0.3"), ("false", "repeat_ratio > 0.3"), ("false", "mean_word < 2.5 OR mean_word > 12"),
    ("false", "upper_ratio > 0.3"), ("false", "digit_ratio > 0.2"), ("false", "shout_ratio > 0.3"), ("false", "variety < 0.1")]


def _op6() -> str:
    n = len(_VOTES)
    stop = ", ".join(f"'{y}'" for x in _STOP for y in (x, x[0].upper() + x[1:]))
    counted = lambda keep: rf"length(regexp_replace(t, '[^{keep}]+', '', 'g'))"
    votes = ", ".join(f"CASE WHEN {g} THEN 1 WHEN {b} THEN -1 ELSE 0 END AS v{j}" for j, (g, b) in enumerate(_VOTES))
    odds = "ln(good) - ln(1 - good)" + "".join(
        f" + CASE v{j} WHEN 1 THEN ln(g{j}) - ln(1 - b{j}) WHEN -1 THEN ln(1 - g{j}) - ln(b{j}) ELSE 0 END" for j in range(n))
    q = f"(1.0 / (1.0 + exp(-({odds}))))"
    first = "SELECT 0.8::DOUBLE AS good, " + ", ".join(f"0.9::DOUBLE AS g{j}, 0.9::DOUBLE AS b{j}" for j in range(n))
    bound = "least(greatest(({0} + 0.018 * sum(n)) / ({1} + 0.02 * sum(n)), 0.55), 0.995)"
    step = "SELECT least(greatest(sum(n * q) / sum(n), 0.5), 0.99) AS good, " + ", ".join(
        bound.format(f"sum(CASE WHEN v{j} = 1 THEN n * q ELSE 0 END)", f"sum(CASE WHEN v{j} <> 0 THEN n * q ELSE 0 END)") + f" AS g{j}, "
        + bound.format(f"sum(CASE WHEN v{j} = -1 THEN n * (1 - q) ELSE 0 END)", f"sum(CASE WHEN v{j} <> 0 THEN n * (1 - q) ELSE 0 END)") + f" AS b{j}"
        for j in range(n))
    rounds = f"m0 AS MATERIALIZED ({first})" + "".join(
        f",\nm{k} AS MATERIALIZED ({step} FROM (SELECT pt.*, {q} AS q FROM pt, m{k - 1}))" for k in range(1, 13))
    vs = ", ".join(f"v{j}" for j in range(n))
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
tri AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM tri) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) x(o) GROUP BY doc_id),
base AS MATERIALIZED (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST({counted("#*$%&|<>")} AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, {counted(chr(92) + "p{Lu}")} AS upper, {counted(chr(92) + "p{L}")} AS letters, {counted("0-9")} AS digits,
         {counted("!")} AS shouts, len(list_distinct(list_filter(w, lambda x: x IN ({stop})))) AS stops, len(list_distinct(w)) AS kinds
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d) d LEFT JOIN rep USING (doc_id)),
ratio AS (
  SELECT *, CASE WHEN n_words > 0 THEN n_symbols / n_words END AS symbol_ratio, CASE WHEN n_words > 0 THEN n_repeat_words / n_words END AS repeat_ratio,
         CASE WHEN n_words > 0 THEN word_chars / n_words END AS mean_word, CASE WHEN n_words > 0 THEN n_dup_lines / greatest(n_lines, 1) END AS dup_line_ratio,
         CASE WHEN letters > 0 THEN upper / letters END AS upper_ratio, CASE WHEN word_chars > 0 THEN letters / word_chars END AS letter_ratio,
         CASE WHEN word_chars > 0 THEN digits / word_chars END AS digit_ratio, CASE WHEN n_words > 0 THEN shouts / n_words END AS shout_ratio,
         CASE WHEN n_words > 0 THEN stops END AS stop_kinds, CASE WHEN n_words > 0 THEN kinds / n_words END AS variety FROM base),
voted AS MATERIALIZED (SELECT *, {votes}, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM ratio),
pt AS MATERIALIZED (SELECT {vs}, CAST(count(*) AS DOUBLE) AS n FROM voted WHERE NOT base_failed GROUP BY ALL),
{rounds}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {q} >= 0.5 AS kept FROM voted, m12
"""


# every anchor against every row
OP13 = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER own AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW own AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER own <= 5
"""


def _op12() -> str:
    """CRC-32 is linear: the value of each byte by its distance from the end, and that of as many zero bytes, by exclusive or.
    Near words by the edit distance of every two words, in an alphabet of one byte a code point."""
    wide = "".join(chr(c) for c in range(0xC0, 0x100))
    narrow = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).islower() and chr(c) != "'")[:64]
    return f"""
WITH RECURSIVE run AS MATERIALIZED (
  SELECT doc_id, w, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS m FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z{wide}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM documents) WHERE length(w) >= 6 GROUP BY doc_id, w
), t8(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM t8 WHERE k < 8
), tab AS MATERIALIZED (SELECT b, c FROM t8 WHERE k = 8
), far(b, k, c) AS (
  SELECT b, 0, c FROM tab
  UNION ALL SELECT far.b, k + 1, xor(tab.c, far.c >> 8) FROM far JOIN tab ON tab.b = far.c & 255 WHERE k < (SELECT max(strlen(m)) FROM run)
), zero(k, c) AS (
  SELECT 0, 4294967295
  UNION ALL SELECT k + 1, xor(tab.c, zero.c >> 8) FROM zero JOIN tab ON tab.b = zero.c & 255 WHERE k < (SELECT max(strlen(m)) FROM run)
), message AS MATERIALIZED (SELECT DISTINCT m, strlen(m) AS size, hex(m) AS x FROM run
), hashed AS (
  SELECT m, xor(xor(bit_xor(far.c), any_value(zero.c)), 4294967295) AS h
  FROM (SELECT m, size, i, CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) AS b FROM (SELECT *, unnest(range(size)) AS i FROM message)) p
  JOIN far ON far.b = p.b AND far.k = size - 1 - i JOIN zero ON zero.k = size GROUP BY m
), made AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word
  FROM run JOIN hashed USING (m)
), v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS l, translate(word, '{wide}', '{narrow}') AS x
  FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), near AS MATERIALIZED (
  SELECT a.word, a.n AS own, b.word AS other, b.n FROM v a JOIN v b ON b.l = a.l AND a.word <> b.word WHERE levenshtein(a.x, b.x) = 1
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM v a JOIN v b ON b.l = a.l + 1 WHERE levenshtein(a.x, b.x) = 1
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM v a JOIN v b ON b.l = a.l - 1 WHERE levenshtein(a.x, b.x) = 1
), best AS MATERIALIZED (
  SELECT word, other AS form, n AS form_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other COLLATE "C") = 1 AND n >= 5 * own
), up(word, here, depth) AS (
  SELECT word, form, 1 FROM best UNION ALL SELECT up.word, best.form, depth + 1 FROM up JOIN best ON best.word = up.here
)
SELECT v.word, best.form, coalesce(r.root, v.word) AS root, v.n, coalesce(c.n_near, 0) AS n_near, best.form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN (SELECT word, arg_max(here, depth) AS root FROM up GROUP BY word) r USING (word)
LEFT JOIN (SELECT word, count(*) AS n_near FROM near GROUP BY word) c USING (word)
"""


ORACLES = {"op6_quality": _op6(), "op8_warc": OP8, "op9_url_rules": OP9, "op10_mixing": OP10, "op12_spelling": _op12(),
           "op13_hard_negatives": OP13}
