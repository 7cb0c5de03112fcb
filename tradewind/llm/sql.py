"""The corpus queries that SQL can express, for the side-by-side check."""

from __future__ import annotations


def crc32(numbers: str) -> str:
    """Unsigned checksum of a list of byte values, bit by bit, as SQL has no function for it."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {numbers}), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"""


def ascii_bytes(text: str) -> str:
    return f"[CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')]"


def letter_bytes(text: str) -> str:
    """UTF-8 of letters up to U+00FF: one byte or two."""
    two = "CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END"
    return f"flatten([{two} FOR c IN string_split({text}, '')])"


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Exact integer arithmetic with ties by id.
TOP_K = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v,
    row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.r AS q_row, q.vec_id AS query_id, c.vec_id, c.r, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.r <> c.r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id, r) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Near words by their common pattern with one letter left open, or by one left out.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, times, {crc32(f"list_concat({ascii_bytes('id || chr(58)')}, {letter_bytes('run')})")} AS h FROM runs WHERE length(run) >= 6
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), holes AS MATERIALIZED (
  SELECT word, n, i, length(word) AS size, word[: i] || word[i + 2 :] AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
    CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS here, form AS further FROM formed
  UNION ALL SELECT c.word, c.further, f.form FROM chain c JOIN formed f ON f.word = c.further
)
SELECT word, f.form, c.here AS root, n, n_near, form_n FROM formed f JOIN (SELECT word, here FROM chain WHERE further IS NULL) c USING (word)
"""

# Every string of 400 bytes by its place and checksum, over hexadecimal text cut into overlapping chunks.
REPEATS = """
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS size FROM documents
), chunks AS (
  SELECT r, c, h[2 * c + 1 : 2 * c + 1598] AS part, least(400, size - 399 - c) AS n
  FROM (SELECT r, h, size, unnest(range(0, size - 399, 400)) AS c FROM texts WHERE size >= 400)
), strings AS MATERIALIZED (
  SELECT r, c + i AS p, md5_number(part[2 * i + 1 : 2 * i + 800]) AS s FROM (SELECT r, c, part, unnest(range(n)) AS i FROM chunks)
), twice AS MATERIALIZED (
  SELECT r, p FROM strings WHERE s IN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1)
), spans AS MATERIALIZED (
  SELECT r, island, min(p) AS a, max(p) + 400 AS b FROM (
    SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS island FROM (
      SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS opens FROM twice))
  GROUP BY ALL
), kept AS (
  SELECT r, string_agg(h[2 * low + 1 : 2 * high], '' ORDER BY low) AS rest FROM (
    SELECT r, coalesce(lag(b) OVER w, 0) AS low, a AS high FROM spans WINDOW w AS (PARTITION BY r ORDER BY a)
    UNION ALL SELECT r, max(b), max(size) FROM spans JOIN texts USING (r) GROUP BY r) JOIN texts USING (r) GROUP BY r
), removed AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS gone, count(*) AS n FROM spans GROUP BY r)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(coalesce(rest, CASE WHEN n IS NULL THEN h ELSE '' END))) AS kept_sha256
FROM texts LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

MANIFEST = f"""
WITH RECURSIVE marked AS (
  SELECT doc_id, lang, text,
    {crc32(ascii_bytes("coalesce(CAST(doc_id AS VARCHAR), '')"))} % 3 = 0 AS offered,
    translate(text, '{UPPER}', '{LOWER}') AS lowered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN offered THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS tampered
  FROM marked
), leaves AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed
), levels AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM levels WHERE n > 1
  GROUP BY tree, level, idx // 8, n
), below AS MATERIALIZED (SELECT * FROM levels),
tops AS (
  SELECT 0 AS level, tree - 1 AS idx, (SELECT count(*) FROM below WHERE n = 1) AS n, digest FROM below WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 8, n
), nodes AS MATERIALIZED (
  SELECT tree, level, idx, n, digest FROM below UNION ALL SELECT 0, level, idx, n, digest FROM tops
), sides AS MATERIALIZED (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL
), walk AS (
  SELECT row_number() OVER () AS r, doc_id, leaf, tree AS home, tree, 0 AS level, idx, n, '' AS proof, coalesce(tampered, leaf) AS folded
  FROM leaves
  UNION ALL
  SELECT r, doc_id, leaf, home, CASE WHEN w.n > 1 THEN w.tree ELSE 0 END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
    CASE WHEN w.n > 1 THEN w.idx // 8 ELSE w.tree - 1 END,
    CASE WHEN w.n > 1 THEN (w.n + 7) // 8 ELSE (SELECT count(*) FROM below WHERE n = 1) END,
    proof || coalesce(before || after, ''), CASE WHEN w.n > 1 THEN sha256(before || folded || after) ELSE folded END
  FROM walk w LEFT JOIN sides s ON w.n > 1 AND s.tree = w.tree AND s.level = w.level AND s.idx = w.idx
  WHERE w.n > 1 OR w.tree > 0
), ends AS (SELECT * FROM walk WHERE tree = 0 AND n = 1)
SELECT doc_id, leaf, b.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM ends JOIN (SELECT tree, digest FROM below WHERE n = 1) b ON b.tree = home, (SELECT digest FROM tops WHERE n = 1) t
"""
