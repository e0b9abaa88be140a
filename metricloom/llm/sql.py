"""SQL for the queries of this subpackage that SQL can express."""

SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

SQL["op1_line_dedup"] = rf"""
WITH parts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents
), lines AS (
  SELECT doc_id, i, p[i + 1] AS raw,
    regexp_extract_all(translate(p[i + 1], '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM parts)
), dist AS (
  SELECT w, array_to_string(w, ' ') AS norm, min({{'d': doc_id, 'i': i}}) AS f
  FROM lines WHERE len(w) > 0 GROUP BY w
), vars AS (
  SELECT norm, f, k, array_to_string(list_concat(w[:k], w[k + 2:]), ' ') AS v
  FROM (SELECT *, unnest(range(len(w))) AS k FROM dist WHERE len(w) >= 8)
), near AS (
  SELECT norm FROM (SELECT norm, f, min(f) OVER (PARTITION BY v, k) AS m FROM vars) WHERE m < f
  UNION
  SELECT a.norm FROM vars a JOIN dist b ON a.v = b.norm WHERE len(b.w) >= 8 AND b.f < a.f
  UNION
  SELECT b.norm FROM dist b JOIN vars a ON a.v = b.norm WHERE len(b.w) >= 8 AND a.f < b.f
), marked AS (
  SELECT l.doc_id, l.i, l.raw,
    len(l.w) > 0 AND ({{'d': l.doc_id, 'i': l.i}} > d.f OR n.norm IS NOT NULL) AS gone
  FROM lines l LEFT JOIN dist d ON array_to_string(l.w, ' ') = d.norm
  LEFT JOIN near n ON d.norm = n.norm
)
SELECT p.doc_id,
  CASE WHEN p.text IS NULL THEN NULL
    ELSE coalesce(string_agg(m.raw, chr(10) ORDER BY m.i) FILTER (NOT coalesce(m.gone, false)), '')
  END AS text,
  CAST(count(m.i) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (coalesce(m.gone, false)) AS BIGINT) AS n_dropped
FROM parts p LEFT JOIN marked m ON p.doc_id = m.doc_id GROUP BY p.doc_id, p.text
"""

# The sixteen fixed values of the checksum's table by half bytes.
_CRC = ", ".join(str(x) for x in (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
))

SQL["op11_spelling"] = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, w, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w
    FROM documents) WHERE length(w) >= 5 GROUP BY doc_id, w
), bytes AS (
  SELECT doc_id, w, k, list_transform(
    string_split(regexp_replace(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)), '(..)', '\1 ', 'g'), ' '),
    lambda x: 16 * (strpos('0123456789ABCDEF', x[1]) - 1) + strpos('0123456789ABCDEF', x[2]) - 1) AS b,
    length(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w))) // 2 AS size
  FROM runs
), crc AS (
  SELECT w, k, xor(4294967295, list_reduce(list_prepend(4294967295, CAST(b[1:size] AS BIGINT[])), lambda c, x:
    xor(xor(xor(c, x) >> 4, [{_CRC}][(xor(c, x) & 15) + 1]) >> 4,
      [{_CRC}][(xor(xor(c, x) >> 4, [{_CRC}][(xor(c, x) & 15) + 1]) & 15) + 1]))) AS h
  FROM bytes
), words AS (
  SELECT w, sum(k) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, k
    FROM crc) WHERE length(w) >= 5 GROUP BY w HAVING sum(k) >= 3
), cut AS (
  SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS v FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM words)
), near AS (
  SELECT a.w, b.w AS o, b.n AS m FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.w <> b.w
  UNION SELECT a.w, b.w, b.n FROM cut a JOIN words b ON a.v = b.w
  UNION SELECT b.w, a.w, a.n FROM cut a JOIN words b ON a.v = b.w
), best AS (
  SELECT w, count(*) AS n_near, min({{'m': -m, 'o': o}}) AS f FROM near GROUP BY w
), forms AS (
  SELECT words.w, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -f.m >= 2 * n THEN f.o END AS form, CASE WHEN -f.m >= 2 * n THEN -f.m END AS form_n
  FROM words LEFT JOIN best ON words.w = best.w
), steps AS (
  SELECT w, form AS r FROM forms WHERE form IS NOT NULL
  UNION SELECT steps.w, f.form FROM steps JOIN forms f ON f.w = steps.r WHERE f.form IS NOT NULL
), roots AS (
  SELECT s.w, s.r FROM steps s JOIN forms f ON f.w = s.r WHERE f.form IS NULL
)
SELECT f.w AS word, form, coalesce(r, f.w) AS root, CAST(n AS BIGINT) AS n,
  CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms f LEFT JOIN roots ON roots.w = f.w
"""
