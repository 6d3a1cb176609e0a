"""DuckDB SQL for the operators that SQL can express (op2's is in ``quality``)."""

import string

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _crc_of_byte(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of an SQL expression."""
    steps = f"CAST([{', '.join(str(_crc_of_byte(b)) for b in range(256))}] AS UBIGINT[])"
    data = (f"list_transform(range(octet_length(encode({text}))), "
            f"lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS UBIGINT))")
    return (f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, list_extract({steps}, CAST(xor(c & 255, b) + 1 AS INTEGER))), "
            "4294967295::UBIGINT), 4294967295::UBIGINT)")

#: op5: all pairs by common shingles, then everything reachable over the links.
NEAR_DUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(range(greatest(len(ws) - 3, 1)),
         lambda i: array_to_string(ws[i + 1:i + 4], ' '))) END AS sh FROM d
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS node FROM s UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.node
), c AS (
  SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)"""

#: op8: all products of the queries.
TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.uid <> c.uid
), k AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5"""

#: op10: holders of every key, then each document's remaining lines.
LINE_DEDUP = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOWER}) AS key FROM l
), h AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (WHERE keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN h USING (key) GROUP BY rid, doc_id"""

#: op12: every word's variants by one deleted or replaced place, met by equal variants.
SPELLING = rf"""
WITH RECURSIVE r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w
  FROM documents
), g AS (
  SELECT d, w, count(*) AS n, {crc32("d || ':' || w")} AS h FROM r GROUP BY d, w
), c AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n FROM g
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), p AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v
), x AS (
  SELECT word, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS replaced, substr(word, 1, i - 1) || substr(word, i + 1) AS deleted FROM p
), e AS (
  SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.replaced = b.replaced AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON x.deleted = v.word
  UNION SELECT v.word, x.word FROM x JOIN v ON x.deleted = v.word
), f AS (
  SELECT e.a AS word, count(*) AS n_near, max(v.n) AS top, arg_min(e.b, (-v.n, e.b)) AS near FROM e JOIN v ON v.word = e.b GROUP BY e.a
), k AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * v.n THEN near END AS form, CASE WHEN top >= 2 * v.n THEN top END AS form_n
  FROM v LEFT JOIN f USING (word)
), t AS (
  SELECT word, word AS root, form AS next FROM k UNION ALL SELECT t.word, k.word, k.form FROM t JOIN k ON k.word = t.next
)
SELECT k.word, form, root, n, n_near, form_n FROM k JOIN t USING (word) WHERE t.next IS NULL"""

#: op13: counts and gains per bucket, then each document's mean gain and noise.
RESAMPLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), o AS (
  SELECT uid, unnest(ws) AS w FROM d
), q AS (
  SELECT w, CAST({crc32("w")} % 10000 AS BIGINT) AS bucket FROM (SELECT w FROM o UNION SELECT w FROM b)
), s AS (
  SELECT bucket, count(*) AS s FROM o JOIN q USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM b JOIN q USING (w) GROUP BY bucket
), g AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
         / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), m AS (
  SELECT uid, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM o JOIN q USING (w) JOIN g USING (bucket) GROUP BY uid
), z AS (
  SELECT uid, doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (uid)
), c AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM z
), a AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS able FROM c
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END AS rank FROM a"""
