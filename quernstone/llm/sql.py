"""DuckDB SQL for the results of operators that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e2.b FROM r JOIN e2 ON r.b = e2.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""

_OP2_WORD = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

OP2 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_OP2_WORD}) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_OP2_WORD}) AS w FROM benchmark WHERE item_id IS NOT NULL),
t AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT item, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0))),
d AS (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)),
h AS (SELECT doc_id, i, d.k, item FROM d JOIN t ON d.g = t.g AND d.k = t.k),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN x USING (doc_id)
"""

OP3 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS points, sha256(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h FROM d)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY points DESC, doc_id) = doc_id AS kept,
       h AS text_sha256
FROM n
"""

OP7 = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM g),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM m WHERE least < doc_id),
a AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
k AS (SELECT a.doc_id, count(*) FILTER (WHERE x.p IS NOT NULL) AS n_removed, string_agg(CASE WHEN x.p IS NULL THEN word END, ' ' ORDER BY a.p) AS kept FROM a LEFT JOIN x ON a.doc_id = x.doc_id AND a.p = x.p GROUP BY a.doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""

#: crc32 of a string of code points below 2048, by the table of its 256 bytes.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC_TABLE = f"SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: {_CRC_STEP}) ORDER BY b) AS crc FROM range(256) AS r(b)"
_CRC_BYTES = "flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 | (unicode(x)::BIGINT >> 6), 128 | (unicode(x)::BIGINT & 63)] END))"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_CRC_BYTES}), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)"

OP11 = f"""
WITH RECURSIVE t AS MATERIALIZED ({_CRC_TABLE}),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT id || ':' || run AS s, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY id, run),
h AS (SELECT run, n, {_CRC} AS h FROM d, t),
o AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
g AS MATERIALIZED (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM g a JOIN g b ON a.less = b.less AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, a.n, v.word, v.n FROM g a JOIN v ON a.less = v.word
  UNION SELECT v.word, v.n, a.word, a.n FROM g a JOIN v ON a.less = v.word
),
q AS (SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM p),
f AS MATERIALIZED (SELECT word, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM q WHERE k = 1),
c AS (SELECT word, word AS root, 0 AS depth FROM v UNION ALL SELECT c.word, f.form, depth + 1 FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, form, form_n, (SELECT arg_max(root, depth) FROM c WHERE c.word = v.word) AS root FROM v LEFT JOIN f USING (word)
"""

OP12 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""


def _centroid_sql(rounds: int = 3) -> str:
    """Each round: distances by component, the nearest centroid, and the floor of its members' mean; empty centroids stay."""
    near = lambda k: (
        f"s{k} AS (SELECT id, c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS distance FROM v JOIN c{k} m USING (d) GROUP BY id, c), "
        f"a{k} AS MATERIALIZED (SELECT id, c, distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, c) AS place FROM s{k}) WHERE place = 1)"
    )
    parts = []
    for k in range(rounds):
        mean = f"SELECT c, d, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{k} JOIN v USING (id) GROUP BY c, d"
        parts += [near(k), f"n{k} AS ({mean})", f"c{k + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(n.x, o.x) AS x FROM c{k} o LEFT JOIN n{k} n USING (c, d))"]
    parts.append(near(rounds))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
),
v AS MATERIALIZED (SELECT id, unnest(range(1, 65)) AS d, unnest(x) AS x FROM k),
i AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM k QUALIFY c < 16),
c0 AS MATERIALIZED (SELECT CAST(c AS INTEGER) AS c, unnest(range(1, 65)) AS d, unnest(x) AS x FROM i),
{", ".join(parts)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN k USING (id) JOIN h USING (c)
"""


OP13 = _centroid_sql()
