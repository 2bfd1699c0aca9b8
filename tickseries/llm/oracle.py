"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# White space of a line key: \x20 and \x09 to \x0D.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _moved(old: str, chosen: str) -> str:
    """SQL for codebooks at the floor of the mean of the parts that chose each entry."""
    return f"""SELECT o.part, o.entry, o.w, coalesce(f.c, o.c) AS c FROM {old} o LEFT JOIN (
    SELECT part, m % 64 AS entry, w, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS c
    FROM x JOIN {chosen} USING (r, part) GROUP BY ALL) f ON o.part = f.part AND o.entry = f.entry AND o.w = f.w"""


def _chosen(books: str) -> str:
    """SQL for the nearest entry of each part: 64 times the squared distance plus the entry."""
    return f"""SELECT r, part, min(dist * 64 + entry) AS m FROM (
    SELECT r, x.part, entry, sum((v - c) * (v - c)) AS dist FROM x JOIN {books} b ON x.part = b.part AND x.w = b.w GROUP BY ALL) GROUP BY ALL"""


ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), low AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1
), deg AS (SELECT a AS r, count(*) AS n FROM pairs GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN low USING (r) LEFT JOIN deg USING (r)
""",
    "op6_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, p, line, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d)
), hot AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10
), s AS (
  SELECT r, count(*) AS n_lines, count(hot.k) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE hot.k IS NULL), '') AS kept
  FROM l LEFT JOIN hot USING (k) GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN s USING (r)
""",
    "op9_warc": """
WITH h AS (SELECT page_id, coalesce(html, '') AS p FROM pages
), x AS (SELECT page_id, p, upper(sha1(p)) AS s FROM h
), bits AS (
  SELECT page_id, p, array_to_string(list_transform(range(1, 41), lambda i:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [strpos('0123456789ABCDEF', substr(s, i::INT, 1))]), '') AS b FROM x
), dg AS (
  SELECT page_id, p, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(b, (5*i+1)::INT, 1)::INT + 8 * substr(b, (5*i+2)::INT, 1)::INT + 4 * substr(b, (5*i+3)::INT, 1)::INT
    + 2 * substr(b, (5*i+4)::INT, 1)::INT + substr(b, (5*i+5)::INT, 1)::INT, 1)), '') AS payload_digest FROM bits
), last AS (SELECT p, max(page_id) AS m FROM dg GROUP BY p
), j AS (SELECT dg.*, m, m IS NOT NULL AND page_id IS DISTINCT FROM m AS rev FROM dg JOIN last USING (p))
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN rev THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN rev THEN m END AS refers_to FROM j
""",
    "op11_spelling_variants": f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc_table AS (SELECT i, c FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS w FROM documents
), d AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS b FROM runs GROUP BY ALL
), crc(doc_id, w, n, b, p, c) AS (
  SELECT doc_id, w, n, b, 0, 4294967295 FROM d
  UNION ALL SELECT doc_id, w, n, b, p + 1, xor(crc.c >> 8, t.c) FROM crc
    JOIN crc_table t ON t.i = xor(crc.c & 255, ('0x' || substr(b, 2 * p + 1, 2))::BIGINT) WHERE 2 * p < length(b)
), h AS (SELECT w, n, xor(c, 4294967295) AS h FROM crc WHERE 2 * p = length(b)
), spoilt AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word FROM h
), v AS (SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3
), cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(length(word)))::INT AS i FROM v)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM cuts a JOIN v ON v.word = a.cut
  UNION SELECT v.word, a.word, a.n FROM cuts a JOIN v ON v.word = a.cut
), best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY 1
), f AS (
  SELECT word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), reach(word, root) AS (
  SELECT word, word FROM v UNION ALL SELECT reach.word, f.form FROM reach JOIN f ON f.word = reach.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, reach.root, f.n, f.n_near, f.form_n FROM f JOIN reach USING (word) JOIN f AS ends ON ends.word = reach.root WHERE ends.form IS NULL
""",
    "op12_vector_codes": f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS r, vec_id, label, e FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), x AS (
  SELECT r, i // (len(e) // 16) AS part, i % (len(e) // 16) AS w, e[i + 1] AS v FROM (SELECT *, unnest(range(len(e))) AS i FROM k)
), d0 AS MATERIALIZED (SELECT part, r AS entry, w, v AS c FROM x WHERE r < 64
), m0 AS MATERIALIZED ({_chosen('d0')}
), d1 AS MATERIALIZED ({_moved('d0', 'm0')}
), m1 AS MATERIALIZED ({_chosen('d1')}
), d2 AS MATERIALIZED ({_moved('d1', 'm1')}
), m2 AS MATERIALIZED ({_chosen('d2')}
), coded AS (SELECT r, string_agg(printf('%02x', (m % 64)::INT), '' ORDER BY part) AS code, sum(m // 64)::BIGINT AS error FROM m2 GROUP BY r
), books AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY part, entry, w)) AS codebooks_sha256 FROM d2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN k USING (r), books
""",
}
