"""The queries of the numbered operators that SQL can express, for the same tables."""

OP2 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS k FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, least(len(w) + 1, 2)))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
same AS (SELECT w, count(*) AS copies FROM d GROUP BY w)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  CASE WHEN n > 0 THEN copies ELSE 1 END AS n_copies, d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id JOIN same USING (w)"""

OP3 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS k FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)),
low AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (k) WHERE low < doc_id)),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

OP4 = r"""
WITH d AS (SELECT doc_id, source, length(regexp_replace(ltrim(coalesce(text, ''), E' \t\n\x0b\x0c\r'),
    '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*', 'x', 'g'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (SELECT *, (sid - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s),
r AS (SELECT *, cap / weight AS room FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY room, sid) AS place FROM r WINDOW b AS (ORDER BY room, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap::DOUBLE, (SELECT arg_min(level, place) FROM l WHERE level <= room) * weight) AS target FROM l),
p AS (SELECT source, source_size, target, least(floor(target + 0.5)::BIGINT, cap) AS take, (2.0::DOUBLE - weight) / 2 AS slope FROM t),
q AS (SELECT *, CASE WHEN source_size > 0 THEN take // source_size ELSE 0 END AS passes, CASE WHEN source_size > 0 THEN take % source_size ELSE 0 END AS rest FROM p),
o AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.passes, q.rest, q.take, q.slope,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.size), d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, (size * passes + greatest(0, least(size, rest - before)))::BIGINT AS taken, before::DOUBLE / greatest(take, 1) AS y,
    ((CASE WHEN rest > before THEN passes ELSE passes - 1 END) * source_size + before)::DOUBLE / greatest(take, 1) AS z, 1 + slope AS b FROM o)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN 2 * y / (b + sqrt(greatest(b * b - 4 * slope * y, 0.0::DOUBLE))) END AS first_position,
  CASE WHEN taken > 0 THEN 2 * z / (b + sqrt(greatest(b * b - 4 * slope * z, 0.0::DOUBLE))) END AS last_position FROM c"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d"""
