"""DuckDB SQL for the queries that SQL can express; written without the operators' code."""

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
m AS (SELECT page_id, body, strlen(body) AS n, max(page_id) OVER (PARTITION BY body) AS stored FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND stored <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND stored <> page_id THEN stored END AS refers_to
FROM m"""

OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT doc_id, t, [x FOR x IN regexp_split_to_array(t, '[ \x09-\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^ \x09-\x0D]')] AS l FROM d),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM s WHERE len(w) >= 8)),
twice AS (SELECT doc_id, body FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM windows SEMI JOIN twice USING (doc_id, body))
  GROUP BY 1),
f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         len(regexp_extract_all(t, '[A-Z]')) AS n_capitals,
         len([i FOR i IN range(1, len(w)) IF w[i] = w[i + 1]]) AS n_adjacent
  FROM s LEFT JOIN covered c USING (doc_id)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR 100 * n_capitals > 40 * word_chars
            OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_adjacent > 20 * n_words) AS kept
FROM j"""


def _words(table: str, key: str) -> str:
    return (
        f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w "
        f"FROM {table}")


OP6 = f"""
WITH b AS ({_words('benchmark', 'item_id')}),
d AS ({_words('documents', 'doc_id')}),
spans AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS body
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS k FROM b) WHERE k > 0)),
sizes AS (SELECT DISTINCT k FROM spans),
asked AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS body
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d JOIN sizes ON len(w) >= k)),
hits AS (SELECT doc_id, k, i, item_id FROM asked JOIN spans USING (k, body)),
places AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_id, k, i FROM hits))
  GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
       coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places p USING (doc_id) LEFT JOIN items i USING (doc_id)"""


def _field(name: str) -> str:
    body = f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({body}) || ':' || {body}, '-')"


#: One bit per step; a byte enters before the first of its eight steps.
_CRC = (
    "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten("
    "[[CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(CAST(doc_id AS VARCHAR), '')])), "
    "lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)")


def _levels(tree: str, height: int) -> str:
    """CTEs {tree}1 to {tree}{height}: the trees' nodes per level, runs of eight hashed; single nodes stay."""
    steps = []
    for k in range(height):
        steps.append(f"""
{tree}_runs{k} AS (SELECT g, p // 8 AS r, max(n) AS n, list(d ORDER BY p) AS ds FROM {tree}{k} WHERE n > 1 GROUP BY g, p // 8),
{tree}{k + 1} AS (
  SELECT g, r AS p, (n + 7) // 8 AS n, sha256(array_to_string(ds, '')) AS d FROM {tree}_runs{k}
  UNION ALL SELECT g, p, n, d FROM {tree}{k} WHERE n = 1)""")
    return ",".join(steps)


def _fold(rows: str, tree: str, height: int) -> str:
    """CTEs {rows}1 to {rows}{height}: ``rows`` with ``f`` and ``proof`` one level further each."""
    steps = []
    for k in range(height):
        left, right = "array_to_string(ds[1:p % 8], '')", "array_to_string(ds[p % 8 + 2:], '')"
        steps.append(f"""
{rows}{k + 1} AS (
  SELECT id, a.g, p // 8 AS p, CASE WHEN ds IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f,
         CASE WHEN ds IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
  FROM {rows}{k} a LEFT JOIN {tree}_runs{k} b ON a.g = b.g AND a.p // 8 = b.r)""")
    return ",".join(steps)


_TALL, _WIDE = 8, 3  # levels of 8 ** 8 documents a language and 8 ** 3 languages

OP13 = f"""
WITH t AS (
  SELECT row_number() OVER () AS id, *, translate(text, '{_CAPITALS}', '{_SMALL}') AS lowered,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g FROM documents),
h AS (
  SELECT id, g, doc_id, lang,
         sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', 'text')))})) AS leaf,
         sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', 'lowered')))})) AS other FROM t),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         count(*) OVER (PARTITION BY g) AS n FROM h),
tree0 AS (SELECT g, p, n, leaf AS d FROM leaves),{_levels('tree', _TALL)},
top0 AS (SELECT 0 AS g, g - 1 AS p, (SELECT count(*) FROM tree{_TALL}) AS n, d FROM tree{_TALL}),{_levels('top', _WIDE)},
at0 AS (
  SELECT id, g, p, CASE WHEN coalesce({_CRC} % 3 = 0, false) THEN other ELSE leaf END AS f, '' AS proof
  FROM leaves),{_fold('at', 'tree', _TALL)},
up0 AS (SELECT id, 0 AS g, g - 1 AS p, f, proof FROM at{_TALL}),{_fold('up', 'top', _WIDE)}
SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, sha256(u.proof) AS proof_sha256, u.f AS folded_root,
       u.f = r.d AS verified
FROM leaves l JOIN up{_WIDE} u USING (id) JOIN tree{_TALL} s ON s.g = l.g CROSS JOIN top{_WIDE} r"""
