"""DuckDB SQL for the operators that SQL can express, over the whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d),
win AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS k FROM p),
dup AS (SELECT doc_id, pos FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos + o AS i FROM dup, range(20) AS t(o)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, count(g.i) AS n, string_agg(word, ' ' ORDER BY i) FILTER (WHERE g.i IS NULL) AS k
         FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, 5 * (k // 4) + 1, 5))::INT >> (15 - 5 * (k % 4))) & 31) + 1, 1) for k in range(32)], '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM q
"""

_NORMAL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL} AS w FROM benchmark),
pat AS (SELECT item, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM b WHERE len(w) > 0),
pk AS (SELECT DISTINCT item, n, array_to_string(w[pos:pos + n - 1], ' ') AS k FROM pat),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM pk)),
hits AS (SELECT doc_id, pos, n, item FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS k FROM spots)
         JOIN pk USING (n, k)),
places AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS i FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hits)
          GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 - 399 AS BIGINT))) AS pos FROM d),
win AS (SELECT doc_id, pos, hash(substr(h, 2 * pos + 1, 800)) AS k FROM p),
dup AS (SELECT doc_id, pos FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
step AS (SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER w <= 400 THEN 0 ELSE 1 END AS new FROM dup
         WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
isle AS (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM step),
span AS (SELECT doc_id, min(pos) AS s, max(pos) + 400 AS e FROM isle GROUP BY doc_id, g),
gap AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b, e FROM span),
kept AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
                string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY b) AS k
         FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op9(notices: dict[str, str], least: float) -> str:
    """The scan with the given templates."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(notices.items()))
    words = rf"regexp_extract_all(translate(t, '{UPPER}', '{LOWER}'), '[a-z0-9\x80-\x{{10FFFF}}]+')"
    grams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    return f"""
WITH tpl AS (SELECT name, {grams} AS s FROM (SELECT name, {words} AS w FROM (VALUES {rows}) AS v(name, t))),
lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text <> ''),
seg AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS segment, unnest(l) AS t FROM lines
        UNION ALL SELECT doc_id, CAST(-1 AS INTEGER), text FROM lines WHERE len(l) > 1),
sets AS (SELECT doc_id, segment, {grams} AS s FROM (SELECT doc_id, segment, {words} AS w FROM seg)),
cmp AS (SELECT doc_id, segment, name, len(list_intersect(x.s, tpl.s)) AS shared, len(x.s) AS size, len(tpl.s) AS template_size
        FROM sets x JOIN tpl ON least(len(x.s), len(tpl.s)) * {2 - least} >= {least} * greatest(len(x.s), len(tpl.s)) AND len(x.s) > 0),
scored AS (SELECT *, 2 * CAST(shared AS DOUBLE) / (size + template_size) AS dice FROM cmp)
SELECT doc_id, segment, name AS license, CAST(shared AS BIGINT) AS shared, CAST(size AS BIGINT) AS size,
  CAST(template_size AS BIGINT) AS template_size, dice FROM scored WHERE dice >= {least}
QUALIFY row_number() OVER (PARTITION BY doc_id, segment ORDER BY dice DESC, name) = 1
"""


OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s
         FROM d),
u AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
pairs AS (SELECT a.doc_id AS p, b.doc_id AS q, a.n AS an, b.n AS bn, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
         AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT p, q FROM pairs WHERE 100 * c >= 80 * (an + bn - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.q FROM reach r JOIN link l ON r.b = l.p),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN comp USING (doc_id)
"""


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
       FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
sc AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
       FROM q JOIN tf USING (term) JOIN wt USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM sc WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
"""

# crc32 bit by bit; a node's key is the run of its turns' hashes, and a node's
# subtree is found through the path of each node's smallest member.
OP13 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, k, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM (
        SELECT conv_id, turn, md5(length(r) || ':' || r || x) AS k, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM t)),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
        [CAST(ascii(z) AS BIGINT) for z in string_split(CAST(conv_id AS VARCHAR), '')]),
        lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])),
          lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)),
        CAST(4294967295 AS BIGINT)) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
size AS (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id),
built AS (SELECT c.conv_id, k, o.n, pos FROM c JOIN o ON o.conv_id = c.base AND pos <= h
          UNION ALL SELECT c.conv_id, k, o.n, least(h, coalesce(size.n, 0)) + pos - h FROM c JOIN o USING (conv_id)
          LEFT JOIN size ON size.conv_id = c.base WHERE pos > h),
m AS (SELECT conv_id, pos AS depth, n, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY pos) AS key FROM built
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n, left(key, length(key) - 32) AS up FROM m GROUP BY depth, key),
kids AS (SELECT up AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY up),
last AS (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id),
ends AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM m JOIN last USING (conv_id, depth) GROUP BY key),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (key)),
below AS (SELECT m.key, sum((y.n_convs - 1) * y.n) AS saved, count(*) FILTER (y.n_children = 0) AS leaves
          FROM full_node y JOIN m ON m.conv_id = y.conv_id AND m.depth <= y.depth GROUP BY m.key)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_node x LEFT JOIN node p ON x.depth > 0 AND p.key = x.up JOIN below b ON b.key = x.key LEFT JOIN ends e ON e.key = x.key
"""
