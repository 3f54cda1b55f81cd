"""DuckDB SQL for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows of 50 words that start in a document with a smaller id.
SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
holder AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN holder USING (g) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word WHERE NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.doc_id = word.doc_id AND gone.p = word.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

#: Windows of ten words of an item, or the whole shorter item.
DECONTAMINATION = f"""
WITH b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
item AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM item),
win AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN sizes ON len(w) >= k)),
hit AS (SELECT win.doc_id, win.i, win.k, item.item_id FROM win JOIN item ON win.k = item.k AND win.g = item.g),
place AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(place.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(held.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(held.s, '')) AS items_sha256, coalesce(place.n, 0) > 0 AS contaminated
FROM d LEFT JOIN place USING (doc_id) LEFT JOIN held USING (doc_id)"""

_BIT = " + ".join(f"{16 >> j} * CAST(substr(bits, 5 * i + {j + 1}, 1) AS INTEGER)" for j in range(5))

#: Equal payloads refer to the page with the smallest id.
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
x AS (SELECT *, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS bits FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + {_BIT} AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to
FROM x"""

#: Bytes that a 400-byte string covers which also starts anywhere else.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
win AS (SELECT doc_id, s, md5(array_slice(b, s, s + 399)) AS g FROM (SELECT doc_id, b, unnest(range(1, n - 398)) AS s FROM d WHERE n >= 400)),
often AS (SELECT doc_id, s FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
cut AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh FROM often),
run AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM cut),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS e FROM run GROUP BY doc_id, r),
piece AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 1) AS f, a AS t FROM span
  UNION ALL SELECT d.doc_id, coalesce(x.e, 1), d.n + 1 FROM d LEFT JOIN (SELECT doc_id, max(e) AS e FROM span GROUP BY doc_id) x USING (doc_id)),
kept AS (SELECT doc_id, string_agg(hex(array_slice(b, f, t - 1)), '' ORDER BY f) AS h FROM piece JOIN d USING (doc_id) WHERE t > f GROUP BY doc_id),
gone AS (SELECT doc_id, CAST(sum(e - a) AS BIGINT) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

_TERMS = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: The ten best documents of each item by whole-number weights of its terms.
LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
held AS (SELECT doc_id, t, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, unnest(w) AS t, len(w) AS n FROM d) WHERE t IN (SELECT t FROM item) GROUP BY doc_id, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, size GROUP BY t),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS s FROM held JOIN weight USING (t), size),
score AS (SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM item JOIN part USING (t) GROUP BY item_id, doc_id),
best AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 10"""

_VECTOR = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
_NEAREST = """
a{r} AS MATERIALIZED (SELECT n, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT n, v, c, list_sum(list_transform(list_zip(v, x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{r}) GROUP BY n, v)"""
_MOVED = """
m{s} AS (SELECT c, i, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS e, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i),
c{s} AS MATERIALIZED (SELECT c{r}.c, coalesce(y, x) AS x FROM c{r} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS y FROM m{s} GROUP BY c) USING (c))"""

#: Five rounds of whole-number centroids, then the last assignment.
CENTROIDS = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, {_VECTOR} AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS c, v AS x FROM v ORDER BY sha256('2:' || vec_id) LIMIT 40),
{",".join(_NEAREST.format(r=r) + "," + _MOVED.format(r=r, s=r + 1) for r in range(5))},
{_NEAREST.format(r=5)},
total AS (SELECT c, CAST(sum(d) AS BIGINT) AS inertia FROM a5 GROUP BY c)
SELECT vec_id, a5.c AS cluster, CAST(d AS BIGINT) AS distance, total.inertia AS cluster_inertia, (SELECT CAST(sum(inertia) AS BIGINT) FROM total) AS inertia,
  sha256(array_to_string(x, ',')) AS centroid_sha256
FROM a5 JOIN v ON v.n = a5.n JOIN c5 ON c5.c = a5.c JOIN total ON total.c = a5.c"""

#: Components of documents whose distinct four-word shingles overlap by at least 80 in 100.
MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_AZ}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
size AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
both_hold AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_hold JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN size USING (doc_id)"""
