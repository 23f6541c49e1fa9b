"""DuckDB SQL for the queries that SQL can express. Licences and tokens have none."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_HAS_WORD = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"

ORACLE: dict[str, str] = {}

ORACLE["op1_topk"] = """
WITH good AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM good q JOIN good r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

ORACLE["op2_line_dedup"] = f"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS h, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT DISTINCT doc_id, h, l, pos FROM (SELECT doc_id, h, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM split)),
worded AS (
  SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY doc_id, h) AS m, ('0x' || substr(md5(l), 1, 7))::BIGINT AS code
  FROM line WHERE {_HAS_WORD.format('l')} WINDOW w AS (PARTITION BY doc_id, h ORDER BY pos)),
phase AS (SELECT doc_id, h, k, m, (lag(code) OVER w * 1000003 + code) % 2147483647 % 2 AS p FROM worded WINDOW w AS (PARTITION BY doc_id, h ORDER BY k)),
ends AS (
  SELECT doc_id, h, k - 1 AS i, k AS j FROM phase WHERE k > 0
  UNION SELECT a.doc_id, a.h, a.k - 1, coalesce(min(b.k), least(a.k + 6, a.m - 1))
  FROM phase a LEFT JOIN phase b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.h = b.h AND b.k > a.k AND b.k <= a.k + 6 AND b.p <> a.p
  WHERE a.k > 0 GROUP BY a.doc_id, a.h, a.k, a.m),
chunk AS (
  SELECT e.doc_id, e.h, i, j, min(pos) AS place, max(pos) AS upto, string_agg(l, chr(10) ORDER BY k) AS c
  FROM ends e JOIN worded w ON e.doc_id IS NOT DISTINCT FROM w.doc_id AND e.h = w.h AND k BETWEEN i AND j GROUP BY ALL),
marked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY doc_id NULLS LAST, h, place, upto) > 1 AS gone FROM chunk),
removed AS (
  SELECT DISTINCT m.doc_id, m.h, pos FROM marked m JOIN line n ON m.doc_id IS NOT DISTINCT FROM n.doc_id AND m.h = n.h AND pos BETWEEN place AND upto WHERE gone),
stays AS (
  SELECT n.doc_id, n.h, string_agg(l, chr(10) ORDER BY n.pos) FILTER (r.pos IS NULL) AS clean, count(r.pos) AS n_removed_lines, count(*) AS n_lines
  FROM line n LEFT JOIN removed r ON n.doc_id IS NOT DISTINCT FROM r.doc_id AND n.h = r.h AND n.pos = r.pos GROUP BY n.doc_id, n.h),
counted AS (SELECT doc_id, h, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks FROM marked GROUP BY ALL)
SELECT s.doc_id, n_lines, n_removed_lines, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed_chunks, 0) AS n_removed_chunks,
  sha256(coalesce(clean, '')) AS clean_sha256
FROM split s JOIN stays t ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.h = t.h
LEFT JOIN counted c ON s.doc_id IS NOT DISTINCT FROM c.doc_id AND s.h = c.h
"""

ORACLE["op3_suffix_dedup"] = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
place AS (SELECT doc_id, x, unnest(range(greatest(length(x) // 2 - 99, 0))) AS i FROM bytes),
windowed AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS w FROM place),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM windowed) WHERE r > 1),
reach AS (SELECT doc_id, i, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM again),
run AS (SELECT doc_id, i, sum((upto IS NULL OR i > upto)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM reach),
span AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY doc_id, k),
gap AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b, FALSE AS head FROM span
  UNION ALL SELECT doc_id, 0, min(a), TRUE FROM span GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN g.b IS NULL THEN substr(x, 2 * g.a + 1) ELSE substr(x, 2 * g.a + 1, 2 * (g.b - g.a)) END, '' ORDER BY g.a, g.head DESC) AS x
  FROM gap g JOIN bytes USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT doc_id, length(d.x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256
FROM bytes d LEFT JOIN kept k USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

ORACLE["op5_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS holder FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM f
"""

ORACLE["op6_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    greatest(0.1::DOUBLE, 1.0::DOUBLE - 10.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')))::DOUBLE
      / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS quality,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':0'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT *, -ln(u) / quality AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM w),
q AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM r WINDOW o AS (ORDER BY ratio, nth ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM q),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
o AS (
  SELECT k.doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + (rest > 0 AND upto - size / 2 <= rest)::INT))::BIGINT AS taken FROM o
"""

ORACLE["op8_url_filter"] = r"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS address,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split),
listed AS (SELECT DISTINCT address FROM ruled WHERE address <> '' AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN address IN (SELECT address FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLE["op9_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform({_WORDS}, lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END)) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, (SELECT count(*) FROM link WHERE link.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

_NORMAL = r"trim(regexp_replace(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))"

ORACLE["op10_quality"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
line AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS l FROM d),
normal AS (SELECT *, {_NORMAL} AS nl, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS nw FROM line WHERE {_HAS_WORD.format('l')}),
seen AS (SELECT source, nl, count(DISTINCT text) AS docs FROM normal GROUP BY source, nl),
total AS (SELECT source, count(DISTINCT text) AS total FROM d GROUP BY source),
common AS (SELECT seen.source, nl FROM seen JOIN total ON seen.source IS NOT DISTINCT FROM total.source WHERE docs > 10),
gone AS (SELECT doc_id, sum(nw)::BIGINT AS n FROM normal n JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.nl = c.nl GROUP BY doc_id),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT l))::BIGINT AS n FROM normal GROUP BY doc_id),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM d WHERE len(ws) >= 3),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(3) t(j) WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_common_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT 100 * (n_words - n_common_words) < 30 * n_words AS kept FROM b
"""

# crc32 byte by byte, over a table made from its polynomial
ORACLE["op11_spelling"] = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b::UBIGINT] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END)) AS steps),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM documents),
bytes AS (SELECT r, list_transform(range(strlen(doc_id || ':' || r)), lambda i: ('0x' || substr(hex(encode(doc_id || ':' || r)), 2 * i + 1, 2))::UBIGINT) AS bs FROM run),
hashed AS (
  SELECT r, xor(list_reduce([4294967295::UBIGINT] || bs, lambda a, b: xor(a // 256, steps[(xor(a, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) AS h FROM bytes, t),
word AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word FROM hashed),
w AS (SELECT word, count(*) AS n FROM word WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
pair AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.v = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pair GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON up.root = f.word WHERE f.form IS NOT NULL)
SELECT word, form, last.root, n, n_near, form_n
FROM f JOIN (SELECT up.word, up.root FROM up JOIN f ON up.root = f.word WHERE f.form IS NULL) last USING (word)
"""
