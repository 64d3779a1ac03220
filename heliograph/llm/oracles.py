"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RECORD = """'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || url || e || 'WARC-Record-ID: <urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' ||
substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>' || e || 'Content-Type: text/html' || e || 'Content-Length: ' || CAST(octet_length(encode(html)) AS VARCHAR) || e || e || html"""

WARC_FIXITY = f"""WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, chr(13) || chr(10) AS e FROM pages),
r AS (SELECT *, md5(url || chr(10) || html) AS h FROM p)
SELECT page_id, CAST(floor(page_id / 64) AS BIGINT) AS range_id, sha256({_RECORD}) AS sha256,
  CASE WHEN page_id % 89 = 21 THEN 'missing' WHEN page_id % 97 = 13 THEN 'corrupt' ELSE 'intact' END AS status FROM r"""

_CLASS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_CLASS}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_CLASS}') AS w FROM benchmark),
b1 AS (SELECT item, w, least(10, len(w)) AS k, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM b1),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(generate_series(1, len(w) - k + 1)) AS i, w FROM d JOIN ks ON len(w) >= k),
dg AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM dw),
hit AS (SELECT doc_id, dg.k, i, item FROM dg JOIN win ON win.k = dg.k AND win.s = dg.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""

MIXING = r"""WITH q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END) AS weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT documents.doc_id, source, md5(coalesce(text, '')) AS h, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, CAST(coalesce(weight, 1.0) AS DOUBLE) AS weight
  FROM documents LEFT JOIN q ON q.doc_id = documents.doc_id),
k AS (SELECT *, -ln((CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || h || ':17'), 1, 13)) AS BIGINT) + 0.5) / CAST(4503599627370496 AS DOUBLE)) / weight AS k FROM d),
s AS (SELECT source, sum(size) AS source_size, list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS w FROM d GROUP BY source),
t AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(source_size) OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(w) OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM s),
f AS (SELECT *, (1.5 * total - 2 * before) * w >= 2 * source_size * w_left AS full_up FROM t),
g AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, CASE WHEN full_up THEN CAST(2 * source_size AS DOUBLE) ELSE CAST((1.5 * total - 2 * coalesce(sum(source_size) FILTER (WHERE full_up) OVER (), 0)) AS DOUBLE) * w /
  sum(w) FILTER (WHERE NOT full_up) OVER () END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END AS epochs FROM g),
c AS (SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS budget,
  sum(size) OVER (PARTITION BY k.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS middle FROM k JOIN e ON e.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + CASE WHEN budget > 0 AND middle <= budget THEN size ELSE 0 END AS BIGINT) AS taken FROM c"""

NEAR_DEDUP = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.a = d.doc_id"""


_HASH = lambda k: f"CAST(('0x' || substr(s, {8 * k + 1}, 8)) AS BIGINT)"

FILL_IN_MIDDLE = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
r AS (SELECT *, CAST(len(u) AS BIGINT) AS n, {_HASH(0)} % (len(u) + 1) AS a, {_HASH(1)} % (len(u) + 1) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_HASH(2)} % 100 >= 50 THEN 'plain' WHEN {_HASH(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, n, form, array_to_string(list_slice(u, 1, least(a, b)), '') AS x, array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') AS y,
  array_to_string(list_slice(u, greatest(a, b) + 1, n), '') AS z FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || z || '<P>' || x || '<M>' || y ELSE '<P>' || x || '<S>' || z || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

SUBSTRING_DEDUP = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS v FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT v FROM s GROUP BY v HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS p FROM s JOIN again USING (v)),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0)),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

# SQL has no crc32 here, so its table is made by the rule: eight shifts of each byte.
_CRC = lambda s: f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({s}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: xor(a >> 8, list_extract(t, CAST(xor(a & 255, b) AS INTEGER) + 1))), 4294967295)"

LATE_SESSIONS = rf"""WITH RECURSIVE shifted AS (SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS x, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, xor(x >> 1, 3988292384 * (x & 1)), k + 1 FROM shifted WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS t FROM shifted WHERE k = 8),
q AS (SELECT conv_id, turn, {_CRC("CAST(conv_id AS VARCHAR)")} AS c, {_CRC("CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)")} AS h FROM conversations, tab WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
e0 AS (SELECT CAST(2 * floor(conv_id / 8) + c % 2 AS BIGINT) AS u, CAST(floor(c / 2) AS BIGINT) % 7200 + 300 * turn + h % 600 AS s, CAST(floor(h / 600) AS BIGINT) AS g, h FROM q),
e AS (SELECT u, s, h, CAST(floor(s / 1800) AS BIGINT) + CASE WHEN g % 3 = 0 THEN g % 4 ELSE 0 END AS b FROM e0),
at_b AS (SELECT x.u, x.b, e.s, e.h, e.b AS own FROM (SELECT DISTINCT u, b FROM e) x JOIN e ON e.u = x.u AND e.b <= x.b),
cut AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY u, b ORDER BY s) <= 240 THEN 0 ELSE 1 END AS c FROM at_b),
num AS (SELECT *, sum(c) OVER (PARTITION BY u, b ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM cut),
v AS (SELECT u, b, min(s) AS s0, max(s) AS s1, count(*) AS n, count(*) FILTER (WHERE own = b) AS fresh, sum(h) AS hs FROM num GROUP BY u, b, k HAVING count(*) FILTER (WHERE own = b) > 0),
r AS (SELECT x.u, x.b, x.s0, min(y.b) AS rb, arg_min(y.s0, y.b) AS rs FROM v x JOIN v y ON y.u = x.u AND y.b > x.b AND y.s0 <= x.s0 AND y.s1 >= x.s1 GROUP BY x.u, x.b, x.s0),
m AS (SELECT u, rb, rs, count(*) AS k FROM r GROUP BY u, rb, rs)
SELECT v.u AS "user", v.b AS batch, v.s0 AS start_s, v.s1 AS end_s, n AS n_events, fresh AS n_new, coalesce(k, 0) AS n_retracted, CAST(hs AS BIGINT) AS h_sum, r.rb AS retracted_batch, r.rs AS retracted_start_s
FROM v LEFT JOIN r ON r.u = v.u AND r.b = v.b AND r.s0 = v.s0 LEFT JOIN m ON m.u = v.u AND m.rb = v.b AND m.rs = v.s0"""


def url_filters(rules: list[tuple[str, str, str]], support: float, confidence: float, lift: float, rows: int) -> str:
    """Rules of up to three tokens by enumeration, where the operator mines them by FP-growth."""
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    listed = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in listed) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in listed) + " END"
    return rf"""WITH u AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t0 AS (SELECT DISTINCT url, host, path FROM u WHERE contains(url, '://')),
tok AS (SELECT url, 'scheme=' || lower(split_part(url, '://', 1)) AS token FROM t0
  UNION SELECT url, 'host=' || x FROM (SELECT url, unnest(string_split(host, '.')) AS x FROM t0) WHERE x <> ''
  UNION SELECT url, 'end=' || coalesce(list_extract(string_split(host, '.'), -1), '') || CASE WHEN contains(host, '.') THEN '.' || list_extract(string_split(host, '.'), -2) ELSE '' END FROM t0
  UNION SELECT url, 'path=' || x FROM (SELECT url, unnest(regexp_split_to_array(lower(path), '[^a-z0-9]+')) AS x FROM t0) WHERE x <> '' AND NOT regexp_matches(x, '[0-9]')
  UNION SELECT url, 'query=' || x FROM (SELECT url, unnest(string_split(regexp_extract(url, '\?([^#]*)', 1), '&')) AS x FROM t0) WHERE x <> ''
  UNION SELECT url, CASE WHEN contains(url, '#') THEN 'fragment' ELSE 'no fragment' END FROM t0),
lab AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
tr AS (SELECT page_id AS id, url, bad FROM pages JOIN lab ON doc_id = TRY_CAST(regexp_extract(url, '://[^/?#]*/[^?#]*?(\d{{1,18}})(?:\.html)?/?(?:[?#]|$)', 1) AS BIGINT)),
n AS (SELECT count(*) AS n, greatest({support}, least(1.0, CAST({rows} AS DOUBLE) / count(*))) AS s, avg(bad) AS share FROM tr),
often AS (SELECT token, count(*) AS c FROM tr JOIN tok USING (url) GROUP BY token HAVING count(*) >= (SELECT s * n FROM n)),
kept AS (SELECT id, bad, token FROM tr JOIN tok USING (url) JOIN often USING (token)),
sets AS (SELECT [token] AS a, bad FROM kept UNION ALL SELECT [x.token, y.token], x.bad FROM kept x JOIN kept y ON x.id = y.id AND x.token < y.token
  UNION ALL SELECT [x.token, y.token, z.token], x.bad FROM kept x JOIN kept y ON x.id = y.id AND x.token < y.token JOIN kept z ON z.id = x.id AND y.token < z.token),
counted AS (SELECT a, sum(bad) AS b, sum(bad) / CAST(count(*) AS DOUBLE) AS conf FROM sets GROUP BY a),
found AS (SELECT row_number() OVER () AS rule, a, conf FROM counted, n WHERE b >= ceil(n.s * n.n) AND conf >= {confidence} AND conf / n.share >= {lift}),
stands AS (SELECT rule, a FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g WHERE len(g.a) < len(f.a) AND list_has_all(f.a, g.a) AND g.conf >= f.conf)),
need AS (SELECT rule, len(a) AS parts, unnest(a) AS token FROM stands),
hit AS (SELECT DISTINCT url FROM (SELECT url, rule FROM need JOIN tok USING (token) GROUP BY url, rule, parts HAVING count(*) = parts))
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN url IN (SELECT url FROM hit) THEN 'block' ELSE 'allow' END) AS verdict FROM u"""
