"""SQL twins (DuckDB) of the operators that SQL can express on whole tables."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str, table: str = "documents", keep: str = "doc_id") -> str:
    return (
        f"SELECT row_number() OVER () AS r, {keep}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"
    )


REPEATED = f"""WITH d AS MATERIALIZED ({_words("coalesce(text, '')", _SPACED)}),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) t(i)),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, i FROM win JOIN again USING (s)), unnest(range(i, i + 35)) t(p)),
word AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) t(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)"""

DECONTAMINATION = f"""WITH d AS MATERIALIZED ({_words(_LOWER, _ALNUM)}),
b AS ({_words(_LOWER, _ALNUM, "benchmark", "CAST(item_id AS VARCHAR) AS item")}),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT DISTINCT r, i, n, item FROM runs JOIN win USING (s, n)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) t(p) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)"""

COMPONENTS = f"""WITH RECURSIVE d AS MATERIALIZED ({_words(_LOWER, _SPACED)}),
shingle AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
            FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(i) WHERE len(w) > 0),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
pairs AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingle x JOIN shingle y USING (s) WHERE x.r <> y.r GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN size x ON x.r = a JOIN size y ON y.r = b
         WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT DISTINCT a, a AS b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_ AS (SELECT a AS r, min(doc_id) AS c FROM reach JOIN d ON d.r = b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM d LEFT JOIN size USING (r) LEFT JOIN least_ USING (r)"""

ARCHIVES = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS n,
             first_value(page_id) OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS f FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(x, 1 + 10 * (k // 8), 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31 AS INTEGER), 1)), '')
           AS payload_digest,
       CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN f END AS refers_to
FROM d"""

# crc32 of up to 20 digits, bit by bit: the polynomial is fixed by the checksum.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [CAST(k AS BIGINT) FOR k IN range(8)]),
                             lambda r, _: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""

TRIE = f"""WITH t AS MATERIALIZED (
  SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         length(coalesce(text, '')) AS n, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(n ORDER BY turn NULLS FIRST, k) AS ns FROM t GROUP BY c),
cut AS (SELECT *, CAST(xor({_CRC}, 4294967295) % 6 AS BIGINT) AS h FROM own),
built AS MATERIALIZED (SELECT x.c, list_concat(coalesce(y.ks, [])[1:h], x.ks[h + 1:]) AS ks,
                              list_concat(coalesce(y.ns, [])[1:h], x.ns[h + 1:]) AS ns
                       FROM cut x LEFT JOIN own y ON y.c = x.c - x.c % 100),
member AS MATERIALIZED (SELECT c, d, len(ks) AS size, coalesce(array_to_string(ks[1:d], ','), '') AS k,
                               CASE WHEN d > 0 THEN coalesce(array_to_string(ks[1:d - 1], ','), '') END AS up,
                               CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS n
                        FROM built, unnest(range(0, len(ks) + 1)) u(d)),
node AS MATERIALIZED (SELECT d, k, any_value(up) AS up, min(c) AS c, count(*) AS n_convs, any_value(n) AS n,
                             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends
                      FROM member GROUP BY d, k),
child AS (SELECT up AS k, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
under AS (SELECT DISTINCT x.d, x.k, y.d AS d2, y.k AS k2 FROM member x JOIN member y ON x.c = y.c AND y.d >= x.d),
total AS (SELECT under.d, under.k, sum((node.n_convs - 1) * node.n) AS saved, count(*) FILTER (WHERE child.n IS NULL) AS leaves
          FROM under JOIN node ON node.d = d2 AND node.k = k2 LEFT JOIN child ON child.d = d2 AND child.k = k2 GROUP BY ALL)
SELECT node.c AS conv_id, CAST(node.d AS BIGINT) AS depth, parent.c AS parent_conv_id, CAST(node.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(child.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN total USING (d, k) LEFT JOIN child USING (d, k) LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.k = node.up"""
