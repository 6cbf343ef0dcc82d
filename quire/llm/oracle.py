"""DuckDB SQL for the queries whose results SQL can state, written on its own:
windows as strings, sets as lists, trees level by level."""

from __future__ import annotations

#: Words: maximal runs outside blank and \x09-\x0D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: crc32 of the decimal form of every id of ``ids(id)``: bytes, then eight steps for each.
_CRC = """
digits AS (SELECT DISTINCT id, CAST(id AS VARCHAR) AS s FROM ids),
crc_steps(id, s, k, c) AS (
  SELECT id, s, 0, 4294967295::BIGINT FROM digits
  UNION ALL
  SELECT id, s, k + 1,
         CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
  FROM (SELECT id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE c END AS x
        FROM crc_steps WHERE k < 8 * length(s))),
crc AS (SELECT id, xor(c, 4294967295::BIGINT) AS crc FROM crc_steps WHERE k = 8 * length(s))
"""

PHRASES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
win AS (SELECT r, doc_id, p, md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS k,
               count(*) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS c FROM words QUALIFY c = 50),
least AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS p FROM win JOIN least USING (k) WHERE least < doc_id),
kept AS (SELECT r, count(*) AS c, string_agg(word, ' ' ORDER BY p) AS text
         FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(c, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
blocks AS (SELECT r, b, substr(x, 512 * b + 1, 1310) AS y FROM (SELECT r, x, unnest(range(0, length(x) // 512 + 1)) AS b FROM d)),
places AS (SELECT r, b, y, unnest(range(0, least(256, length(y) // 2 - 399))) AS q FROM blocks WHERE length(y) >= 800),
win AS (SELECT r, 256 * b + q AS p, md5(substr(y, 2 * q + 1, 800)) AS k FROM places),
twice AS (SELECT r, p FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM twice),
runs AS (SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + 400 THEN 1 ELSE 0 END)
                OVER (PARTITION BY r ORDER BY p) AS g FROM marked),
spans AS (SELECT r, g, min(p) AS a, max(p) + 400 AS z FROM runs GROUP BY r, g),
edges AS (SELECT r, g, a, z, coalesce(lag(z) OVER w, 0) AS last, lead(a) OVER w IS NULL AS final
          FROM spans WINDOW w AS (PARTITION BY r ORDER BY g)),
kept AS (SELECT r, sum(z - a) AS n, count(*) AS c,
                string_agg(substr(x, 2 * last + 1, 2 * (a - last)) ||
                           CASE WHEN final THEN substr(x, 2 * z + 1) ELSE '' END, '' ORDER BY g) AS x
         FROM edges JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(c, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

LINKS = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS c, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
gram AS (SELECT doc_id, c, p, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g FROM words),
part AS (SELECT DISTINCT doc_id, g FROM gram WHERE p = 1 OR p <= c - 2),
item AS (SELECT doc_id, g, count(*) OVER (PARTITION BY doc_id) AS n FROM part),
few AS (SELECT g, count(*) AS c FROM item GROUP BY g),
-- Of n shingles, n - ceil(0.9 n) + 1 of the rarest hold a shared one if 0.9 n or more are shared.
ranked AS (SELECT doc_id, g, n, row_number() OVER (PARTITION BY doc_id ORDER BY c, g) AS k FROM item JOIN few USING (g)),
prefix AS (SELECT doc_id, g, n FROM ranked WHERE k <= n - (9 * n + 9) // 10 + 1),
pairs AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM prefix a JOIN prefix b ON a.g = b.g
          AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
shared AS (SELECT x, y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS i
           FROM pairs JOIN item a ON a.doc_id = x JOIN item b ON b.doc_id = y AND b.g = a.g GROUP BY x, y),
link AS (SELECT x, y FROM shared WHERE 100 * i >= 90 * (n + m - i)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d
                         UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON edge.x = reach.other)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN (SELECT DISTINCT doc_id, n FROM item) USING (doc_id) GROUP BY doc_id
"""

LINES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
kept AS (SELECT r, count(*) AS c, string_agg(line, chr(10) ORDER BY p) AS text FROM keyed ANTI JOIN common USING (k) GROUP BY r)
SELECT doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(c, 0))::BIGINT AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _field(value: str) -> str:
    s = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({s}) || ':' || {s}, '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

MANIFEST = f"""
WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents), {_CRC},
leaf AS (SELECT doc_id, source, sha256({_HEAD} || {_field("text")}) AS leaf,
                CASE WHEN crc % 2 = 0 THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")}) END AS changed
         FROM documents LEFT JOIN crc ON id = doc_id),
placed AS (SELECT *, coalesce('=' || source, '') AS g,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY source) AS n FROM leaf),
up(g, lvl, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1
  GROUP BY g, lvl, i // 3, n),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top(lvl, i, n, h) AS (
  SELECT 0, i, n, h FROM sub
  UNION ALL
  SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 3, n),
root AS (SELECT h AS root FROM top WHERE n = 1),
side AS (SELECT a.g, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
                coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
         FROM up a JOIN up b ON a.g = b.g AND a.lvl = b.lvl AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.g, a.lvl, a.i),
side2 AS (SELECT a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
                 coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
          FROM top a JOIN top b ON a.lvl = b.lvl AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.lvl, a.i),
fold(g, i0, lvl, i, acc, proof) AS (
  SELECT g, i, 0, i, coalesce(changed, leaf), '' FROM placed
  UNION ALL
  SELECT f.g, i0, f.lvl + 1, f.i // 3, sha256(l || acc || r), proof || l || r
  FROM fold f JOIN side s ON s.g = f.g AND s.lvl = f.lvl AND s.i = f.i),
folded AS (SELECT g, i0, max_by(acc, lvl) AS acc, max_by(proof, lvl) AS proof FROM fold GROUP BY g, i0),
fold2(g, i0, lvl, i, acc, proof) AS (
  SELECT g, i0, 0, sub.i, acc, proof FROM folded JOIN sub USING (g)
  UNION ALL
  SELECT g, i0, f.lvl + 1, f.i // 3, sha256(l || acc || r), proof || l || r
  FROM fold2 f JOIN side2 s ON s.lvl = f.lvl AND s.i = f.i),
done AS (SELECT g, i0, max_by(acc, lvl) AS acc, max_by(proof, lvl) AS proof FROM fold2 GROUP BY g, i0)
SELECT doc_id, leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM placed JOIN done ON done.g = placed.g AND i0 = placed.i JOIN sub ON sub.g = placed.g CROSS JOIN root
"""

TRIE = f"""
WITH RECURSIVE ids AS (SELECT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL), {_CRC},
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
        FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT id AS conv_id, id - id % 100 AS base, crc % 6 AS h FROM crc),
parts AS (SELECT c.conv_id, 0 AS part, i, role, text FROM conv c JOIN own o ON o.conv_id = c.base AND i < h
          UNION ALL SELECT c.conv_id, 1, i, role, text FROM conv c JOIN own o ON o.conv_id = c.conv_id AND i >= h),
turns AS (SELECT conv_id, length(text) AS len, sha256(strlen(role) || ':' || role || text) AS t,
                 row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d FROM parts),
size AS (SELECT conv.conv_id, count(t) AS n FROM conv LEFT JOIN turns USING (conv_id) GROUP BY conv.conv_id),
path(conv_id, d, k, len) AS (
  SELECT conv_id, 0::BIGINT, '', 0::BIGINT FROM conv
  UNION ALL
  SELECT t.conv_id, t.d, sha256(k || t.t), t.len FROM path JOIN turns t ON t.conv_id = path.conv_id AND t.d = path.d + 1),
node AS (SELECT k, any_value(d) AS d, any_value(len) AS len, min(conv_id) AS first, count(*) AS n,
                coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = size.n), '') AS ends
         FROM path JOIN size USING (conv_id) GROUP BY k),
tie AS (SELECT c.k, p.k AS up, p.first AS parent FROM node c JOIN path x ON x.conv_id = c.first AND x.d = c.d - 1
        JOIN node p ON p.k = x.k),
kids AS (SELECT up AS k, count(*) AS kids FROM tie GROUP BY up),
below AS (SELECT a.k, sum(CASE WHEN kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((u.n - 1) * u.len) AS saved
          FROM node u LEFT JOIN kids USING (k) JOIN path a ON a.conv_id = u.first AND a.d <= u.d GROUP BY a.k)
SELECT first AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM node LEFT JOIN tie USING (k) LEFT JOIN kids USING (k) JOIN below USING (k)
"""

#: Kind, form, least characters and what counts for them.
_SECRETS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 8, 1),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]+", 32, 0),
    ("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 1, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 1, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 1, 0),
]


def _secrets() -> str:
    each = []
    for rank, (kind, form, least, group) in enumerate(_SECRETS):
        rx = form.replace("'", "''")
        each.append(f"SELECT r, {rank} AS rank, '{kind}' AS kind, {least} AS least, "
                    f"regexp_extract_all(text, '{rx}') AS m, regexp_extract_all(text, '{rx}', {group}) AS part, "
                    f"string_split_regex(text, '{rx}') AS gap FROM d WHERE regexp_matches(text, '{rx}')")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in _SECRETS[:3])
    text = "string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank)"
    names = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k, *_ in _SECRETS[:3])
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hit AS ({" UNION ALL ".join(each)}),
one AS (SELECT r, rank, kind, least, unnest(m) AS m, unnest(part) AS part, unnest(gap[1:len(m)]) AS gap,
               unnest(range(1, len(m) + 1)) AS k FROM hit),
sums AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY k) AS z FROM one),
span AS (SELECT r, rank, kind, (z - length(m))::BIGINT AS a, z::BIGINT AS z FROM sums WHERE length(part) >= least),
every AS (SELECT r, {counts}, {text} AS spans, {text} FILTER (rank < 3) AS base FROM span GROUP BY r)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN every USING (r)
"""


SECRETS = _secrets()

ORACLE = {
    "op1_secret_scan": SECRETS,
    "op2_phrase_dedup": PHRASES,
    "op6_jaccard_join": LINKS,
    "op10_suffix_dedup": REPEATS,
    "op11_prefix_trie": TRIE,
    "op12_line_dedup": LINES,
    "op13_merkle_manifest": MANIFEST,
}
