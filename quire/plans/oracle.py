"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle sees only the driver's tables, so every derived view is restated
here as a CTE. Nothing in this module runs on Spark.
"""

from __future__ import annotations

from quire.functions.constants import PY_WHITESPACE
from quire.functions.constants import SEGMENT_PATTERNS
from quire.plans.fixtures import PAGE_REWRITES, TOC_ROWS, TRANSLATE_INSTRUCTION, TRANSLATE_SYSTEM

NL = "chr(10)"
NL2 = "(chr(10) || chr(10))"
# Python's whitespace set spelled with chr() so the SQL text stays ASCII.
WS_CHARS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def rfind(x: str, p: str) -> str:
    """0-based last index of literal ``p`` in ``x`` (or -1)."""
    return (f"(CASE WHEN strpos({x}, {p}) = 0 THEN -1 ELSE "
            f"length({x}) - strpos(reverse({x}), reverse({p})) + 1 - length({p}) END)")


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


VIEWS: dict[str, str] = {}
VIEW_DEPS: dict[str, list[str]] = {}


RAW: set[str] = set()


def view(name: str, sql: str, deps: list[str] | None = None, raw: bool = False) -> None:
    """Register a CTE; ``raw`` ones are given whole (``name(cols) AS (...)``)."""
    VIEWS[name] = sql
    VIEW_DEPS[name] = deps or []
    if raw:
        RAW.add(name)


view("book_pages", f"""
SELECT CAST(floor(doc_id / 50.0) AS BIGINT) AS book_id,
       CAST(doc_id % 50 AS INTEGER) AS page_no,
       CASE WHEN doc_id % 50 >= 10 AND (doc_id % 50 - 10) % 7 = 0
            THEN CAST(CAST(floor((doc_id % 50 - 10) / 7.0) + 1 AS BIGINT)
                      + CASE WHEN CAST(floor(doc_id / 50.0) AS BIGINT) % 4 = 3 THEN 17 ELSE 0 END AS VARCHAR) || {NL}
                 || upper(replace(substring(split_part(text, {NL}, 1), 1, 60), 'ß', 'ss')) || {NL} || text
            ELSE text END AS text
FROM documents""")

view("book_toc", """
SELECT b.book_id, CAST(t.chapter_no + CASE WHEN b.book_id % 4 = 3 THEN 17 ELSE 0 END AS INTEGER) AS chapter_no,
       t.title || ', volume ' || b.book_id AS title
FROM (SELECT DISTINCT CAST(floor(doc_id / 50.0) AS BIGINT) AS book_id FROM documents) b,
     (SELECT * FROM toc UNION ALL SELECT 7, 'Afterword') t""", ["toc"])

view("toc", "SELECT CAST(chapter_no AS INTEGER) AS chapter_no, title FROM (VALUES "
     + ", ".join(f"({n}, {sql_str(t)})" for n, t in TOC_ROWS) + ") AS t(chapter_no, title)")

_FORMS = {
    "raw": "text",
    "para": f"replace(text, {NL}, {NL2})",
    "space": f"translate(text, '.!?' || {NL}, '    ')",
    "hard": f"translate(text, ' .!?' || {NL}, '_____')",
}

view("chapter_docs", " UNION ALL ".join(
    f"SELECT CAST(floor(doc_id / 50.0) AS BIGINT) AS book_id, "
    f"CAST(doc_id % 50 + 1 AS INTEGER) AS chapter_no, '{f}' AS form, {e} AS text FROM documents"
    for f, e in _FORMS.items()))

view("raw_chapters", "SELECT book_id, chapter_no, text FROM chapter_docs WHERE form = 'raw'",
     ["chapter_docs"])

view("zh_docs", f"""
SELECT CAST(floor(doc_id / 50.0) AS BIGINT) AS book_id,
       CAST(doc_id % 50 + 1 AS INTEGER) AS chapter_no,
       translate(replace(text, {NL}, {NL2}), 'etaoin.,!?', '的一是不了人。，！？') AS text
FROM documents""")

# --- step 1: pages -> chapters ------------------------------------------------

view("chapter_starts", f"""
SELECT s.book_id, s.chapter_no, min(page_no) AS start_page FROM (
  SELECT book_id, page_no, first_line, TRY_CAST(first_line AS INTEGER) AS chapter_no,
         length(regexp_replace(title, '[^\\p{{Lu}}]', '', 'g')) AS n_upper,
         length(regexp_replace(title, '[^\\p{{L}}]', '', 'g')) AS n_letters
  FROM (
    SELECT book_id, page_no, {strip('lines[1]')} AS first_line,
           array_to_string(lines[2:3], ' ') AS title
    FROM (SELECT book_id, page_no, string_split(text, {NL})[1:10] AS lines
          FROM book_pages WHERE page_no >= 10 AND text IS NOT NULL AND text <> ''))) s
JOIN (SELECT book_id, max(chapter_no) AS most FROM book_toc GROUP BY book_id) m ON m.book_id = s.book_id
WHERE regexp_matches(first_line, '^[0-9]{{1,2}}$') AND chapter_no BETWEEN 1 AND m.most
  AND n_letters > 0 AND n_upper::DOUBLE / n_letters > 0.25
GROUP BY s.book_id, s.chapter_no""", ["book_pages", "book_toc"])

view("chapter_ranges", """
SELECT s.book_id, s.chapter_no, s.start_page,
       coalesce(lead(s.start_page) OVER (PARTITION BY s.book_id ORDER BY s.chapter_no), c.n_pages) AS end_page
FROM chapter_starts s JOIN (SELECT book_id, max(page_no) + 1 AS n_pages FROM book_pages GROUP BY book_id) c
  ON s.book_id = c.book_id""", ["chapter_starts", "book_pages"])

view("chapter_pages", """
SELECT r.book_id, r.chapter_no, p.page_no, p.text
FROM book_pages p JOIN chapter_ranges r
  ON p.book_id = r.book_id AND p.page_no >= r.start_page AND p.page_no < r.end_page
WHERE p.text IS NOT NULL AND p.text <> ''""", ["book_pages", "chapter_ranges"])

view("chapter_text", f"""
SELECT r.book_id, r.chapter_no, coalesce(t.title, 'Unknown') AS title, r.start_page, r.end_page,
       r.end_page - r.start_page AS page_span,
       coalesce(a.n_text_pages, 0) AS n_text_pages,
       CAST(length(coalesce(a.body, '')) AS INTEGER) AS n_chars,
       printf('%d. %s', r.chapter_no, coalesce(t.title, 'Unknown')) || {NL2} || coalesce(a.body, '') AS file_text
FROM chapter_ranges r
LEFT JOIN (SELECT book_id, chapter_no, string_agg(text, {NL2} ORDER BY page_no) AS body,
                  count(*) AS n_text_pages
           FROM chapter_pages GROUP BY book_id, chapter_no) a
  ON r.book_id = a.book_id AND r.chapter_no = a.chapter_no
LEFT JOIN book_toc t ON r.chapter_no = t.chapter_no AND r.book_id = t.book_id""", ["chapter_ranges", "chapter_pages", "book_toc"])


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEW_DEPS[n]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str, extra: str = "") -> str:
    """``WITH RECURSIVE <views + dependencies>, <extra CTEs> <body>``."""
    order = _closure(names)
    parts = [VIEWS[n] if n in RAW else f"{n} AS ({VIEWS[n]})" for n in order] + ([extra] if extra else [])
    return f"WITH RECURSIVE {',\n'.join(parts)}\n{body}" if parts else body


ORACLE: dict[str, str] = {}


def oracle(name: str, views: list[str], body: str, extra: str = "") -> None:
    ORACLE[name] = with_views(views, body, extra)


oracle("chapter_starts", ["chapter_starts"], "SELECT * FROM chapter_starts")
oracle("chapter_ranges", ["chapter_ranges"], "SELECT * FROM chapter_ranges")
oracle("chapter_pages", ["chapter_pages"],
       "SELECT book_id, chapter_no, page_no, CAST(length(text) AS INTEGER) AS n_chars FROM chapter_pages")
oracle("chapter_pages_sweep", ["chapter_pages"],
       "SELECT book_id, chapter_no, page_no, CAST(length(text) AS INTEGER) AS n_chars FROM chapter_pages")
oracle("chapter_text", ["chapter_text"], "SELECT * FROM chapter_text")


# --- step 3/4: chunkers as recursive CTEs ----------------------------------------

def _cut_cte(name: str, src: str, keys: str, next_end: str) -> str:
    """A recursive CTE walking each text window by window: one row per chunk."""
    return f"""{name}(__KEYS__, text, n, part_no, s, e) AS (
  SELECT {keys}, text, length(text), 0, 0, 0 FROM {src}
  UNION ALL
  SELECT {keys}, text, n, part_no + 1, e,
         CASE WHEN e + 3000 >= n THEN n ELSE {next_end} END
  FROM (SELECT *, substring(text, e + 1, 3000) AS w FROM {name} WHERE e < n) q
)""".replace("__KEYS__", keys)


def fixed_chunks_sql(src: str, keys: str) -> tuple[str, str]:
    nxt = f"CASE WHEN {rfind('w', NL2)} > 2100 THEN e + {rfind('w', NL2)} ELSE e + 3000 END"
    cte = _cut_cte("fx", src, keys, nxt)
    return cte, f"""SELECT {keys}, CAST(part_no AS INTEGER) AS part_no,
       CAST(count(*) OVER (PARTITION BY {keys}) AS INTEGER) AS n_parts,
       substring(text, s + 1, e - s) AS text
FROM fx WHERE part_no > 0"""


def boundary_chunks_sql(src: str, keys: str) -> tuple[str, str]:
    lp = rfind("w", NL2)
    ls = "greatest(" + ", ".join([rfind("w", "'. '"), rfind("w", "'! '"), rfind("w", "'? '"),
                                  rfind("w", f"'.' || {NL}")]) + ")"
    lw = rfind("w", "' '")
    nxt = (f"CASE WHEN {lp} > 1800 THEN e + {lp} WHEN {ls} > 1500 THEN e + {ls} + 1 "
           f"WHEN {lw} > 2100 THEN e + {lw} ELSE e + 3000 END")
    cte = _cut_cte("bx", src, keys, nxt)
    return cte, f"""SELECT {keys}, CAST(part_no AS INTEGER) AS part_no,
       CAST(count(*) OVER (PARTITION BY {keys}) AS INTEGER) AS n_parts,
       {strip('substring(text, s + 1, e - s)')} AS text
FROM bx WHERE part_no > 0"""


def pack_sql(src: str, keys: str, max_size: int) -> str:
    """Paragraph packer with sentence fallback: recursion over sentences of
    oversize paragraphs, then recursion over paragraphs."""
    k_eq = " AND ".join(f"g.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    delim = ("CASE " + " ".join(f"WHEN strpos(para, '{d}') > 0 THEN '{d}'" for d in
                                ["。", "！", "？", ".", "!", "?"]) + " END")
    return f"""pk_paras AS (
  SELECT {keys}, list_filter(list_transform(string_split(text, {NL2}), lambda x: {strip('x')}), lambda x: x <> '') AS ps
  FROM {src}),
pk_one AS (
  SELECT {keys}, CAST(i AS INTEGER) AS pi, ps[i] AS para FROM pk_paras, range(1, len(ps) + 1) r(i)),
pk_big AS (
  SELECT {keys}, pi, para, d,
         CASE WHEN d IS NULL THEN [para]
              ELSE list_transform(string_split(para, d),
                     lambda x, j: CASE WHEN j < len(string_split(para, d)) THEN x || d ELSE x END) END AS sents
  FROM (SELECT *, {delim} AS d FROM pk_one WHERE length(para) > {max_size})),
pk_sg({keys}, pi, sents, j, groups, temp, tsize) AS (
  SELECT {keys}, pi, sents, 0, []::VARCHAR[], []::VARCHAR[], 0 FROM pk_big
  UNION ALL
  SELECT {keys}, pi, sents, j + 1,
         CASE WHEN tsize + length(sents[j + 1]) > {max_size} AND len(temp) > 0
              THEN list_append(groups, array_to_string(temp, '')) ELSE groups END,
         CASE WHEN tsize + length(sents[j + 1]) > {max_size} AND len(temp) > 0
              THEN [sents[j + 1]] ELSE list_append(temp, sents[j + 1]) END,
         CASE WHEN tsize + length(sents[j + 1]) > {max_size} AND len(temp) > 0
              THEN length(sents[j + 1]) ELSE tsize + length(sents[j + 1]) END
  FROM pk_sg WHERE j < len(sents)),
pk_groups AS (
  SELECT {keys}, pi,
         CASE WHEN len(temp) > 0 THEN list_append(groups, array_to_string(temp, '')) ELSE groups END AS g
  FROM pk_sg WHERE j = len(sents)),
pk({keys}, ps, i, chunks, cur, sz) AS (
  SELECT {keys}, ps, 0, []::VARCHAR[], []::VARCHAR[], 0 FROM pk_paras
  UNION ALL
  SELECT p.{keys.replace(',', ', p.').replace('p. ', 'p.')}, p.ps, p.i + 1,
         CASE WHEN length(p.ps[p.i + 1]) > {max_size}
                THEN list_concat(CASE WHEN len(p.cur) > 0 THEN list_append(p.chunks, array_to_string(p.cur, {NL2})) ELSE p.chunks END, g.g)
              WHEN p.sz + length(p.ps[p.i + 1]) + 2 > {max_size}
                THEN CASE WHEN len(p.cur) > 0 THEN list_append(p.chunks, array_to_string(p.cur, {NL2})) ELSE p.chunks END
              ELSE p.chunks END,
         CASE WHEN length(p.ps[p.i + 1]) > {max_size} THEN []::VARCHAR[]
              WHEN p.sz + length(p.ps[p.i + 1]) + 2 > {max_size} THEN [p.ps[p.i + 1]]
              ELSE list_append(p.cur, p.ps[p.i + 1]) END,
         CASE WHEN length(p.ps[p.i + 1]) > {max_size} THEN 0
              WHEN p.sz + length(p.ps[p.i + 1]) + 2 > {max_size} THEN length(p.ps[p.i + 1])
              ELSE p.sz + length(p.ps[p.i + 1]) + 2 END
  FROM pk p LEFT JOIN pk_groups g ON {k_eq} AND g.pi = p.i + 1
  WHERE p.i < len(p.ps)),
pk_final AS (
  SELECT {keys},
         CASE WHEN len(cur) > 0 THEN list_append(chunks, array_to_string(cur, {NL2})) ELSE chunks END AS cs
  FROM pk WHERE i = len(ps)),
pk_rows AS (
  SELECT {keys}, CAST(k AS INTEGER) AS part_no, CAST(len(cs) AS INTEGER) AS n_parts, cs[k] AS text
  FROM pk_final, range(1, len(cs) + 1) r(k))"""


_K3 = "book_id, chapter_no, form"
oracle("chunk_fixed", ["chapter_docs"], fixed_chunks_sql("chapter_docs", _K3)[1],
       fixed_chunks_sql("chapter_docs", _K3)[0])
oracle("chunk_boundary", ["chapter_docs"], boundary_chunks_sql("chapter_docs", _K3)[1],
       boundary_chunks_sql("chapter_docs", _K3)[0])

view("para_docs", "SELECT book_id, chapter_no, text FROM chapter_docs WHERE form = 'para'",
     ["chapter_docs"])
oracle("pack_paragraphs", ["para_docs"], "SELECT * FROM pk_rows",
       pack_sql("para_docs", "book_id, chapter_no", 4000))
oracle("pack_sentences", ["para_docs"], "SELECT * FROM pk_rows",
       pack_sql("para_docs", "book_id, chapter_no", 400))
view("speech_docs", f"""SELECT book_id, chapter_no, {strip("translate(text, '#*', '')")} AS text FROM zh_docs""",
     ["zh_docs"])
oracle("part_names", ["speech_docs"], """
SELECT book_id, chapter_no, part_no, n_parts, CAST(length(text) AS INTEGER) AS n_chars,
       CASE WHEN n_parts = 1 THEN printf('chapter_%02d.mp3', chapter_no)
            ELSE printf('chapter_%02d_part%02d.mp3', chapter_no, part_no) END AS file_name,
       printf('chapter_%02d_part%02d.mp3', chapter_no, part_no) AS file_name_numbered
FROM pk_rows""", pack_sql("speech_docs", "book_id, chapter_no", 4000))


# --- step 2: projections and filters ------------------------------------------

oracle("title_body_split", ["raw_chapters"], f"""
SELECT book_id, chapter_no, split_part(text, {NL}, 1) AS title,
       CASE WHEN strpos(text, {NL}) > 0 THEN substring(text, strpos(text, {NL}) + 1) ELSE text END AS body
FROM raw_chapters""")

oracle("strip_markdown", ["raw_chapters"], f"""
SELECT book_id, chapter_no, CAST(length(text) AS INTEGER) AS n_before,
       CAST(length({strip("replace(replace(text, '#', ''), '*', '')")}) AS INTEGER) AS n_after,
       {strip("replace(replace(text, '#', ''), '*', '')")} AS text
FROM raw_chapters""")

oracle("head_truncate", ["raw_chapters"], """
SELECT book_id, chapter_no, substring(text, 1, 3000) AS summary_input,
       substring(text, 1, 4000) AS speech_input,
       substring(text, 1, 500) || '...' AS export_original,
       substring(text, 1, 3000) || '...' AS prompt_head
FROM raw_chapters""")

oracle("file_names", ["raw_chapters"], """
SELECT book_id, chapter_no, seq_no,
       printf('chapter_%02d.txt', seq_no) AS chapter_file,
       printf('chapter_%02d_cn.md', seq_no) AS translation_file,
       printf('chapter_%02d_summary.txt', seq_no) AS summary_file,
       printf('chapter_%02d_full.mp3', seq_no) AS audio_full_file,
       printf('chapter_%02d.html', seq_no) AS page_file,
       printf('chapter_%02d_cn_formatted.md', seq_no) AS formatted_file,
       printf('%02d', chapter_no) AS chapter_tag
FROM (SELECT book_id, chapter_no, book_id * 50 + chapter_no AS seq_no FROM raw_chapters)""")

_rw = "html"
for _a, _b in PAGE_REWRITES:
    _rw = f"replace({_rw}, {sql_str(_a)}, {sql_str(_b)})"
oracle("path_rewrite", [], f"""
SELECT page_id, {_rw} AS html, CAST(length({_rw}) - length(html) AS INTEGER) AS grown_by FROM pages""")

oracle("first_n_chapters", ["raw_chapters"], """
SELECT book_id, chapter_no, n_chars, chapter_file FROM (
  SELECT book_id, chapter_no, CAST(length(text) AS INTEGER) AS n_chars,
         printf('chapter_%02d.txt', chapter_no) AS chapter_file,
         row_number() OVER (PARTITION BY book_id ORDER BY printf('chapter_%02d.txt', chapter_no), chapter_no) AS rn
  FROM raw_chapters) WHERE rn <= 2""")

oracle("chapter_range_filter", ["raw_chapters"], """
SELECT book_id, chapter_no, CAST(length(text) AS INTEGER) AS n_chars FROM raw_chapters
WHERE chapter_no BETWEEN 3 AND 7""")


# --- step 5: regex segmentation ----------------------------------------------------

view("marked_docs", f"""
SELECT book_id, 'Book ' || CAST(book_id AS VARCHAR) AS title,
       string_agg(piece, {NL2} ORDER BY page_no) AS text
FROM (
  SELECT book_id, page_no,
         CASE WHEN k IS NOT NULL AND book_id % 4 <> 3 AND (book_id % 4 <> 2 OR k <= 4)
              THEN {NL} || CAST(k AS VARCHAR) || ': THE ' || CASE WHEN k = 4 THEN 'HTTP ' ELSE '' END
                   || 'CHAPTER ABOUT TOPIC ' || chr(65 + k) || {NL}
              ELSE '' END
         || text AS piece
  FROM (SELECT CAST(floor(doc_id / 50.0) AS BIGINT) AS book_id, CAST(doc_id % 50 AS INTEGER) AS page_no, text,
               CASE WHEN doc_id % 50 % 7 = 3 THEN CAST(floor((doc_id % 50 - 3) / 7.0) + 1 AS INTEGER)
                    WHEN doc_id % 50 = 49 THEN 8 END AS k
        FROM documents))
GROUP BY book_id""")


def _re2(p: str) -> str:
    from quire.operators.segment import portable_pattern
    return portable_pattern(p)


_PATS = ", ".join(f"({i + 1}, {sql_str(_re2(p))})" for i, p in enumerate(SEGMENT_PATTERNS))
view("seg_pieces", f"""
SELECT book_id, pattern_no, idx, full_text, title, body,
       (lower(title) NOT LIKE '%http%' AND lower(title) NOT LIKE '%www%'
        AND length(title) > 20 AND NOT starts_with(title, 'Zone ')) AS kept
FROM (
  SELECT book_id, pattern_no, i - 1 AS idx,
         split_part(lst[i], chr(57345), 1) AS full_text,
         {strip("split_part(split_part(lst[i], chr(57345), 2), chr(57346), 1)")} AS title,
         split_part(split_part(lst[i], chr(57345), 2), chr(57346), 2) AS body
  FROM (SELECT m.book_id, p.pattern_no,
               string_split(regexp_replace(m.text, p.pat, chr(57344) || '\\0' || chr(57345) || '\\1' || chr(57346), 'gi'),
                            chr(57344)) AS lst
        FROM marked_docs m, (VALUES {_PATS}) AS p(pattern_no, pat)) s,
       range(2, len(lst) + 1) r(i))""", ["marked_docs"])

view("seg_winner", """
SELECT d.book_id, min(c.pattern_no) FILTER (WHERE c.n_kept > 3) AS pattern_no
FROM marked_docs d LEFT JOIN (
  SELECT book_id, pattern_no, count(*) FILTER (WHERE kept) AS n_kept FROM seg_pieces GROUP BY 1, 2) c
  ON d.book_id = c.book_id
GROUP BY d.book_id""", ["seg_pieces", "marked_docs"])

view("seg_chapters", f"""
SELECT i.book_id, CAST(i.pattern_no AS INTEGER) AS pattern_no, CAST(i.grp AS INTEGER) AS chapter_no,
       max(CASE WHEN i.kept THEN i.title END) AS title,
       {strip("string_agg(CASE WHEN i.kept THEN i.body ELSE i.full_text || i.body END, '' ORDER BY i.idx)")} AS text
FROM (SELECT *, sum(CAST(kept AS INTEGER)) OVER (PARTITION BY book_id, pattern_no ORDER BY idx
                                                ROWS UNBOUNDED PRECEDING) AS grp
      FROM seg_pieces) i
JOIN seg_winner w ON i.book_id = w.book_id AND i.pattern_no = w.pattern_no
WHERE i.grp > 0
GROUP BY 1, 2, 3
UNION ALL
SELECT d.book_id, 0, 1, d.title, d.text FROM marked_docs d JOIN seg_winner w
  ON d.book_id = w.book_id WHERE w.pattern_no IS NULL""", ["seg_pieces", "seg_winner", "marked_docs"])

oracle("segment_regex", ["seg_chapters"], """
SELECT book_id, pattern_no, chapter_no, title, CAST(length(text) AS INTEGER) AS n_chars, text
FROM seg_chapters WHERE pattern_no = 0 OR length(text) >= 500""")

oracle("segment_fallback", ["seg_chapters"], """
SELECT d.book_id,
""" + ",\n".join(f"  CAST(count(*) FILTER (WHERE p.pattern_no = {i} AND p.kept) AS INTEGER) AS kept_{i}"
                 for i in range(1, 6)) + """,
  CAST(coalesce(max(w.pattern_no), 0) AS INTEGER) AS pattern_no,
  CAST((SELECT count(*) FROM seg_chapters c WHERE c.book_id = d.book_id
        AND (c.pattern_no = 0 OR length(c.text) >= 500)) AS INTEGER) AS n_chapters
FROM marked_docs d LEFT JOIN seg_pieces p ON d.book_id = p.book_id
LEFT JOIN seg_winner w ON d.book_id = w.book_id
GROUP BY d.book_id""")


# --- step 6: lines and blocks --------------------------------------------------------

def _ends(x: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"suffix({x}, '{m}')" for m in marks) + ")"


view("zh_files", f"""
SELECT z.book_id, z.chapter_no,
       printf('%d. %s', z.chapter_no, coalesce(t.title, printf('Chapter %d', z.chapter_no))) || {NL2} || z.text AS text
FROM zh_docs z LEFT JOIN toc t ON z.chapter_no = t.chapter_no""", ["zh_docs", "toc"])

view("fmt_lines", f"""
SELECT *, lag(s) OVER w AS prev_s, lead(s) OVER w AS next_s FROM (
  SELECT book_id, chapter_no, i - 1 AS i, lst[i] AS line, {strip('lst[i]')} AS s, len(lst) AS n
  FROM (SELECT book_id, chapter_no, string_split(text, {NL}) AS lst FROM zh_files), range(1, len(lst) + 1) r(i))
WINDOW w AS (PARTITION BY book_id, chapter_no ORDER BY i)""", ["zh_files"])

view("line_format", f"""
SELECT book_id, chapter_no, string_agg(out, {NL} ORDER BY i) AS text FROM (
  SELECT *, CASE
    WHEN s = '' THEN line
    WHEN i = 0 AND regexp_matches(s, '^\\p{{Nd}}+\\.[\\x{{9}}-\\x{{d}}\\x{{1c}}-\\x{{20}}\\x{{85}}\\p{{Z}}]+.+') THEN '# ' || s
    WHEN i < 3 AND regexp_matches(s, '^\\p{{Nd}}+$') THEN line
    WHEN i < 5 AND length(s) < 30 AND NOT {_ends('s', ['。', '！', '？', '，', '；'])} THEN '## ' || s
    WHEN i < 10 AND length(s) < 50 AND ({_ends('s', ['。', '！', '？'])} OR strpos(s, '，') > 0)
      THEN '*' || s || '*' || {NL}
    WHEN length(s) < 20 AND NOT {_ends('s', ['。', '！', '？', '，', '；', '：', '、'])} AND i > 10
         AND (i = 0 OR coalesce(prev_s, '') = '' OR i = n - 1 OR coalesce(next_s, '') = '')
      THEN {NL} || '## ' || s || {NL}
    ELSE line END AS out
  FROM fmt_lines) GROUP BY book_id, chapter_no""", ["fmt_lines"])

oracle("line_format", ["line_format"],
       "SELECT book_id, chapter_no, CAST(length(text) AS INTEGER) AS n_chars, text FROM line_format")

_H = "'^(#{1,6}) (.*)$'"
_EM = "'\\*([^*\\n]+)\\*'"
view("md_blocks", f"""
SELECT book_id, chapter_no, CAST(block_no AS INTEGER) AS block_no,
       CASE WHEN cnt = 1 AND regexp_matches(first_s, {_H}) THEN 'heading'
            WHEN cnt = 1 AND regexp_matches(first_s, '^[0-9]+\\. (.*)$') THEN 'list'
            ELSE 'paragraph' END AS kind,
       CASE WHEN cnt = 1 AND regexp_matches(first_s, {_H})
              THEN printf('<h%d>%s</h%d>', length(regexp_extract(first_s, {_H}, 1)),
                          regexp_replace(regexp_extract(first_s, {_H}, 2), {_EM}, '<em>\\1</em>', 'g'),
                          length(regexp_extract(first_s, {_H}, 1)))
            WHEN cnt = 1 AND regexp_matches(first_s, '^[0-9]+\\. (.*)$')
              THEN '<ol>' || {NL} || '<li>' || regexp_replace(regexp_extract(first_s, '^[0-9]+\\. (.*)$', 1), {_EM}, '<em>\\1</em>', 'g')
                   || '</li>' || {NL} || '</ol>'
            ELSE '<p>' || regexp_replace(body, {_EM}, '<em>\\1</em>', 'g') || '</p>' END AS html
FROM (
  SELECT book_id, chapter_no, block_no, count(*) AS cnt, arg_min(s, i) AS first_s,
         string_agg(s, {NL} ORDER BY i) AS body
  FROM (
    SELECT *, sum(CASE WHEN s <> '' AND (is_head OR i = 0 OR prev_blank OR prev_head) THEN 1 ELSE 0 END)
                OVER (PARTITION BY book_id, chapter_no ORDER BY i ROWS UNBOUNDED PRECEDING) AS block_no
    FROM (
      SELECT *, coalesce(lag(s = '') OVER w, true) AS prev_blank, coalesce(lag(is_head) OVER w, false) AS prev_head
      FROM (SELECT book_id, chapter_no, i - 1 AS i, {strip('lst[i]')} AS s,
                   regexp_matches({strip('lst[i]')}, {_H}) AS is_head
            FROM (SELECT book_id, chapter_no, string_split(text, {NL}) AS lst FROM line_format),
                 range(1, len(lst) + 1) r(i))
      WINDOW w AS (PARTITION BY book_id, chapter_no ORDER BY i)))
  WHERE s <> ''
  GROUP BY book_id, chapter_no, block_no)""", ["line_format"])

oracle("markdown_blocks", ["md_blocks"], "SELECT * FROM md_blocks")

view("broken_docs", f"""
SELECT book_id, chapter_no,
       replace(replace(text, 'tion ', 'ti-' || {NL} || 'on '), ', ', ',' || {NL2}) AS text, text AS original
FROM raw_chapters""", ["raw_chapters"])

def repaired_sql(source: str, keys: str) -> str:
    """The repaired text of each row of ``source``, as ``fixed``."""
    return f"""
SELECT {keys}, string_agg(g, {NL2} ORDER BY grp) AS fixed FROM (
  SELECT {keys}, grp, string_agg(para, ' ' ORDER BY i) AS g FROM (
    SELECT *, sum(CASE WHEN i > 1 AND NOT regexp_matches(prev_para, '[.!?:]\\z')
                            AND regexp_matches(para, '^\\p{{Ll}}') THEN 0 ELSE 1 END)
                OVER (PARTITION BY {keys} ORDER BY i ROWS UNBOUNDED PRECEDING) AS grp
    FROM (SELECT *, lag(para) OVER (PARTITION BY {keys} ORDER BY i) AS prev_para FROM (
      SELECT {keys}, i, lst[i] AS para FROM (
        SELECT {keys},
               string_split(regexp_replace(text, '(\\p{{L}})-' || {NL} || '(\\p{{Ll}})', '\\1\\2', 'g'), {NL2}) AS lst
        FROM {source}), range(1, len(lst) + 1) r(i))))
  GROUP BY {keys}, grp)
GROUP BY {keys}"""


view("repaired", repaired_sql("broken_docs", "book_id, chapter_no"), ["broken_docs"])

view("cut_pages", """
SELECT book_id, CAST(chapter_no * 100000 + i AS INTEGER) AS page_no,
       substring(text, i * 997 + 1, 997)
       || CASE WHEN regexp_matches(substring(text, i * 997 + 1, 997), '\\p{L}\\z')
                AND regexp_matches(substring(text, (i + 1) * 997 + 1, 1), '^\\p{L}') THEN '-' ELSE '' END AS text
FROM (SELECT book_id, chapter_no, text, unnest(range(0, CAST(floor(length(text) / 997.0) AS BIGINT) + 1)) AS i
      FROM broken_docs)""", ["broken_docs"])

view("page_ends", f"""
SELECT book_id, page_no, text, lag(text) OVER w AS before, lead(text) OVER w AS after
FROM (SELECT book_id, page_no, {strip('text')} AS text FROM cut_pages)
WHERE text <> '' WINDOW w AS (PARTITION BY book_id ORDER BY page_no)""", ["cut_pages"])

view("page_glue", """
SELECT book_id, page_no,
       CASE WHEN before IS NULL THEN '' WHEN NOT regexp_matches(text, '^\\p{Ll}') THEN chr(10) || chr(10)
            WHEN regexp_matches(before, '\\p{L}-\\z') THEN '' WHEN regexp_matches(before, '[.!?:]\\z') THEN chr(10) || chr(10)
            ELSE ' ' END AS glue,
       CASE WHEN regexp_matches(text, '\\p{L}-\\z') AND regexp_matches(coalesce(after, ''), '^\\p{Ll}')
            THEN substring(text, 1, length(text) - 1) ELSE text END AS text
FROM page_ends""", ["page_ends"])

view("page_repaired", repaired_sql("page_glue", "book_id, page_no"), ["page_glue"])

oracle("repair_pages", ["page_glue", "page_repaired"], """
SELECT g.book_id, g.page_no, g.glue, CAST(length(r.fixed) AS INTEGER) AS n_chars, md5(r.fixed) AS md5
FROM page_glue g JOIN page_repaired r ON g.book_id = r.book_id AND g.page_no = r.page_no""")

oracle("repair_breaks", ["repaired", "broken_docs"], """
SELECT b.book_id, b.chapter_no, CAST(length(b.text) AS INTEGER) AS n_before,
       CAST(length(r.fixed) AS INTEGER) AS n_after, length(r.fixed) / length(b.text) AS ratio,
       r.fixed = b.original AS restored, r.fixed AS text
FROM broken_docs b JOIN repaired r ON b.book_id = r.book_id AND b.chapter_no = r.chapter_no""")

_KEY = "regexp_replace({x}, '[#*\\x{{9}}-\\x{{d}}\\x{{1c}}-\\x{{20}}\\x{{85}}\\p{{Z}}]', '', 'g')"
oracle("content_preserved", ["zh_files", "line_format", "repaired", "broken_docs"], f"""
SELECT z.book_id, z.chapter_no, {_KEY.format(x='z.text')} = {_KEY.format(x='f.text')} AS format_ok,
       CAST(length({_KEY.format(x='z.text')}) AS INTEGER) AS n_content,
       {_KEY.format(x='b.text')} = {_KEY.format(x='r.fixed')} AS repair_ok
FROM zh_files z
JOIN line_format f ON z.book_id = f.book_id AND z.chapter_no = f.chapter_no
JOIN broken_docs b ON z.book_id = b.book_id AND z.chapter_no = b.chapter_no
JOIN repaired r ON z.book_id = r.book_id AND z.chapter_no = r.chapter_no""")


# --- step 7: model step ----------------------------------------------------------------

_bx_cte, _bx_sel = boundary_chunks_sql("raw_chapters", "book_id, chapter_no")
view("bx", _bx_cte, ["raw_chapters"], raw=True)
view("chunk_requests", _bx_sel.replace("AS text", "AS input"), ["bx"])
_UP = "translate({x}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _model_cols(need: str, x: str, fail: str) -> str:
    ans = _UP.format(x=x)
    return f"""CASE WHEN {need} <= 3 THEN {ans} ELSE {fail} END AS output,
       CASE WHEN {need} <= 3 THEN 'ok' ELSE 'failed' END AS status,
       CAST(least({need}, 3) AS INTEGER) AS attempts,
       CAST((1 << (least({need}, 3) - 1)) - 1 AS INTEGER) AS backoff_s,
       CASE WHEN {need} <= 3 THEN NULL ELSE 'attempt 3 failed' END AS error,
       CAST(least({need}, 3) * length({x}) * 100 AS BIGINT) AS service_us"""


oracle("prompts", ["chunk_requests"], f"""
SELECT book_id, chapter_no, part_no, n_parts,
       {sql_str(TRANSLATE_SYSTEM)} AS system,
       {sql_str(TRANSLATE_INSTRUCTION)} || {NL2} || printf('Text (part %d of %d):', part_no, n_parts) || {NL2} || input AS "user",
       CAST(0.3 AS DOUBLE) AS temperature, 16000 AS max_tokens
FROM chunk_requests""")

# --- request and answer turns ---------------------------------------------------------

view("turns", """
SELECT conv_id, turn, role, text, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (
         PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS INTEGER) AS part_no
FROM conversations WHERE conv_id IS NOT NULL""")

view("answers", """
SELECT conv_id, part_no, text AS answer FROM turns WHERE role = 'assistant' AND part_no > 0 AND text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY conv_id, part_no ORDER BY turn, text) = 1""", ["turns"])

view("pairs", """
SELECT r.conv_id, r.part_no, r.text AS input, answer,
       CAST(count(*) OVER (PARTITION BY r.conv_id) AS INTEGER) AS n_parts
FROM turns r LEFT JOIN answers a ON a.conv_id = r.conv_id AND a.part_no = r.part_no WHERE r.role = 'user'""", ["turns", "answers"])

_LOST = "printf('[Translation failed for chunk %d]', part_no)"

oracle("turn_pairs", ["pairs"], f"""
SELECT conv_id, part_no, n_parts, input, coalesce(answer, {_LOST}) AS output,
       CASE WHEN answer IS NULL THEN 'failed' ELSE 'ok' END AS status FROM pairs""")

oracle("reassemble", ["pairs"], f"""
SELECT conv_id, n_parts, n_ok, n_failed, text AS translation, printf('Conversation %d', conv_id) || {NL2} || text AS file_text
FROM (SELECT conv_id, count(*) AS n_parts, count(answer) AS n_ok, count(*) - count(answer) AS n_failed,
             string_agg(coalesce(answer, {_LOST}), {NL2} ORDER BY part_no) AS text FROM pairs GROUP BY conv_id)""")

view("given_summaries", """
SELECT CAST(floor(conv_id / 50.0) AS BIGINT) AS book_id, CAST(conv_id % 50 + 1 AS INTEGER) AS chapter_no, text
FROM conversations WHERE role = 'assistant' AND text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) = 1""")

view("turn_texts", f"""
SELECT CAST(floor(conv_id / 50.0) AS BIGINT) AS book_id, CAST(conv_id % 50 + 1 AS INTEGER) AS chapter_no,
       string_agg(coalesce(answer, ''), {NL2} ORDER BY part_no) AS text FROM pairs GROUP BY conv_id""", ["pairs"])

oracle("summaries", ["given_summaries", "turn_texts", "raw_chapters"], f"""
SELECT r.book_id, r.chapter_no, 'ok' AS status, coalesce(t.text, '') <> '' AS from_translation,
       CAST(length(substring(coalesce(nullif(t.text, ''), r.text), 1, 3000)) AS INTEGER) AS n_input, {strip('s.text')} AS text
FROM raw_chapters r JOIN given_summaries s ON s.book_id = r.book_id AND s.chapter_no = r.chapter_no
LEFT JOIN turn_texts t ON t.book_id = r.book_id AND t.chapter_no = r.chapter_no WHERE {strip('s.text')} <> ''""")

oracle("redo_chapter", ["pairs"], f"""
SELECT conv_id, CAST(conv_id % 50 + 1 AS INTEGER) AS chapter_no, n_parts, n_ok, n_parts - n_ok AS n_failed,
       CAST(length(text) AS INTEGER) AS n_chars, text
FROM (SELECT conv_id, count(*) AS n_parts, count(answer) AS n_ok,
             string_agg(coalesce(answer, CASE WHEN conv_id % 50 = 2 THEN input ELSE {_LOST} END), {NL2} ORDER BY part_no) AS text
      FROM pairs GROUP BY conv_id)""")

oracle("clean_passthrough", ["broken_docs"], f"""
SELECT book_id, chapter_no, status, attempts, output = input AS unchanged,
       CAST(length(input) AS INTEGER) AS n_before, CAST(length(output) AS INTEGER) AS n_after,
       output AS text
FROM (SELECT book_id, chapter_no, text AS input,
             {_model_cols("((3 * chapter_no) % 5 + 1)", "text", "text")}
      FROM broken_docs)""")


# --- step 8: audit of request rates ------------------------------------

view("arrivals", """
SELECT user_id, event_id, epoch_us(ts) AS at_us,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
FROM events""")

view("open_rec", """open_rec(user_id, i, send_us) AS (
  SELECT user_id, i, at_us FROM arrivals WHERE i = 1
  UNION ALL
  SELECT a.user_id, a.i, greatest(a.at_us, r.send_us + 3600000000)
  FROM open_rec r JOIN arrivals a ON a.user_id IS NOT DISTINCT FROM r.user_id AND a.i = r.i + 1)""", ["arrivals"], raw=True)

view("open_loop", """
SELECT a.user_id, a.event_id, a.i, a.at_us, r.send_us, r.send_us - a.at_us AS delay_us
FROM arrivals a JOIN open_rec r ON a.user_id IS NOT DISTINCT FROM r.user_id AND a.i = r.i""", ["open_rec", "arrivals"])

oracle("rate_audit", ["open_loop"], """
SELECT user_id, count(*) AS n_requests,
       count(*) FILTER (WHERE at_us - a1 < 3600000000) AS raw_gap_violations,
       count(*) FILTER (WHERE at_us - a5 < 60000000) AS raw_window_violations,
       count(*) FILTER (WHERE send_us - s1 < 3600000000) AS sched_gap_violations,
       count(*) FILTER (WHERE send_us - s5 < 60000000) AS sched_window_violations,
       count(*) FILTER (WHERE delay_us > 0) AS n_delayed, max(delay_us) AS max_delay_us,
       min(at_us - a1) AS least_gap_us, min(at_us - a5) AS least_span_us
FROM (SELECT *, lag(at_us) OVER w AS a1, lag(at_us, 5) OVER w AS a5,
             lag(send_us) OVER w AS s1, lag(send_us, 5) OVER w AS s5
      FROM open_loop WINDOW w AS (PARTITION BY user_id ORDER BY i))
GROUP BY user_id""")


# --- step 9: speech parts -------------------------------------------------------------------

view("pk_all", pack_sql("speech_docs", "book_id, chapter_no", 4000), ["speech_docs"], raw=True)
view("speech_chunks", "SELECT book_id, chapter_no, part_no, n_parts, text FROM pk_rows", ["pk_all"])
view("audio_parts", """
SELECT book_id, chapter_no, part_no, n_parts, text FROM speech_chunks
WHERE (chapter_no * 7 + part_no) % 11 <> 0""", ["speech_chunks"])

oracle("skip_existing", ["speech_chunks", "audio_parts"], """
SELECT book_id, chapter_no, part_no, 'existing' AS source, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes
FROM audio_parts WHERE part_no % 2 = 0
UNION ALL
SELECT book_id, chapter_no, part_no,
       CASE WHEN (chapter_no + 2 * part_no) % 4 + 1 <= 3 THEN 'ok' ELSE 'failed' END,
       CASE WHEN (chapter_no + 2 * part_no) % 4 + 1 <= 3 THEN CAST(octet_length(encode(text)) AS INTEGER) END
FROM speech_chunks e
WHERE NOT EXISTS (SELECT 1 FROM audio_parts d WHERE d.part_no % 2 = 0 AND d.book_id = e.book_id
                  AND d.chapter_no = e.chapter_no AND d.part_no = e.part_no)""")

view("merged", """
SELECT s.book_id, s.chapter_no, s.n_parts, coalesce(p.n_present, 0) AS n_present,
       coalesce(p.n_present, 0) = s.n_parts AS complete,
       CASE WHEN coalesce(p.n_present, 0) = s.n_parts AND s.n_parts > 1 THEN p.body END AS body
FROM (SELECT DISTINCT book_id, chapter_no, n_parts FROM speech_chunks) s
LEFT JOIN (SELECT book_id, chapter_no, count(*) AS n_present, string_agg(text, '' ORDER BY part_no) AS body
           FROM audio_parts GROUP BY book_id, chapter_no) p
  ON s.book_id = p.book_id AND s.chapter_no = p.chapter_no""", ["speech_chunks", "audio_parts"])

oracle("merge_complete", ["merged"], """
SELECT book_id, chapter_no, n_parts, n_present, complete, body IS NOT NULL AS merged,
       CAST(octet_length(encode(body)) AS INTEGER) AS merged_bytes, md5(body) AS merged_md5,
       CASE WHEN body IS NOT NULL THEN printf('chapter_%02d_full.mp3', chapter_no) END AS full_file
FROM merged""")

oracle("merge_size", ["merged"], """
SELECT book_id, chapter_no, CAST(octet_length(encode(body)) AS INTEGER) AS n_bytes,
       octet_length(encode(body)) / (1024.0 * 1024.0) AS mb,
       (octet_length(encode(body)) / (1024.0 * 1024.0) * 8 * 1024) / 11520.0 AS minutes
FROM merged WHERE body IS NOT NULL""")

oracle("run_summary", ["merged"], """
SELECT book_id, count(*) AS n_chapters, CAST(sum(n_parts) AS BIGINT) AS n_parts,
       CAST(sum(n_present) AS BIGINT) AS n_present, count(*) FILTER (WHERE complete) AS n_complete,
       count(body) AS n_merged, CAST(coalesce(sum(octet_length(encode(body))), 0) AS BIGINT) AS merged_bytes,
       bool_and(complete) AS all_ok
FROM merged GROUP BY book_id""")


# --- step 10: catalogue ------------------------------------------------------------------

view("cat_translations", "SELECT * FROM zh_files", ["zh_files"])
view("cat_summaries", f"SELECT book_id, chapter_no, {strip('text')} AS text FROM given_summaries WHERE {strip('text')} <> ''",
     ["given_summaries"])
view("cat_merged", "SELECT book_id, chapter_no FROM merged WHERE body IS NOT NULL", ["merged"])
_PREVIEW = (f"CASE WHEN s.text IS NULL THEN '暂无摘要' WHEN length({strip('s.text')}) > 200 "
            f"THEN substring({strip('s.text')}, 1, 200) || '...' ELSE {strip('s.text')} END")
view("cat", f"""
SELECT t.book_id, t.chapter_no, t.chapter_no AS number,
       coalesce(c.title, printf('Chapter %d', t.chapter_no)) AS title,
       {_PREVIEW} AS summary,
       m.chapter_no IS NOT NULL AS hasAudio,
       CAST(length(regexp_replace(t.text, '[^一-鿿]', '', 'g')) AS INTEGER) AS wordCount,
       printf('chapter_%02d.html', t.chapter_no) AS file
FROM cat_translations t
LEFT JOIN cat_summaries s ON t.book_id = s.book_id AND t.chapter_no = s.chapter_no
LEFT JOIN cat_merged m ON t.book_id = m.book_id AND t.chapter_no = m.chapter_no
LEFT JOIN toc c ON t.chapter_no = c.chapter_no""", ["cat_translations", "cat_summaries", "cat_merged", "toc"])

oracle("cjk_count", ["cat_translations"], """
SELECT book_id, chapter_no, CAST(length(regexp_replace(text, '[^一-鿿]', '', 'g')) AS INTEGER) AS wordCount,
       CAST(length(text) AS INTEGER) AS n_chars FROM cat_translations""")

oracle("catalogue", ["cat"], "SELECT * FROM cat")

oracle("catalogue_json", ["cat"], """
SELECT book_id, CAST(to_json(list(struct_pack(number := number, title := title, summary := summary,
       hasAudio := hasAudio, wordCount := wordCount, file := file) ORDER BY number)) AS VARCHAR) AS json,
       count(*) AS n_chapters
FROM cat GROUP BY book_id""")

view("export_chapters", """
SELECT t.book_id, CAST(t.chapter_no AS INTEGER) AS number, coalesce(c.title, printf('Chapter %d', t.chapter_no)) AS title,
       substring(r.text, 1, 500) || '...' AS original, t.text AS translation,
       coalesce(s.text, '') AS summary,
       CASE WHEN m.chapter_no IS NOT NULL THEN printf('audio/chapter_%02d_full.mp3', t.chapter_no) ELSE '' END AS audio
FROM cat_translations t
JOIN raw_chapters r ON t.book_id = r.book_id AND t.chapter_no = r.chapter_no
LEFT JOIN cat_summaries s ON t.book_id = s.book_id AND t.chapter_no = s.chapter_no
LEFT JOIN cat_merged m ON t.book_id = m.book_id AND t.chapter_no = m.chapter_no
LEFT JOIN toc c ON t.chapter_no = c.chapter_no""", ["cat_translations", "cat_summaries", "cat_merged", "raw_chapters", "toc"])

oracle("book_export", ["export_chapters"], """
SELECT book_id, CAST(to_json(struct_pack(book_title := printf('Book %d', book_id),
       total_chapters := CAST(count(*) AS INTEGER),
       chapters := list(struct_pack(number := number, title := title, original := original,
                                    translation := translation, summary := summary, audio := audio)
                        ORDER BY number))) AS VARCHAR) AS json
FROM export_chapters GROUP BY book_id""")

oracle("book_stream", ["export_chapters"], """
SELECT *, CAST(count(*) OVER (PARTITION BY book_id) AS INTEGER) AS total_chapters FROM export_chapters""")

oracle("paged_files", ["book_pages"], """
SELECT book_id, CAST(n AS INTEGER) AS page_no, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS md5
FROM (SELECT book_id, replace(coalesce(text, ''), chr(12), ' ') AS text,
             row_number() OVER (PARTITION BY book_id ORDER BY page_no) AS n FROM book_pages)
WHERE text <> ''""")

oracle("book_cards", ["cat", "raw_chapters"], """
SELECT c.book_id, c.number, printf('chapters/chapter_%02d.html', c.number) AS href,
       printf('Chapter %d · %s', c.number, c.title) AS heading, c.summary, c.hasAudio,
       coalesce(CAST(nullif(c.wordCount, 0) AS VARCHAR), 'N/A') AS count_text,
       CASE WHEN b.n = r.n THEN 'completed' ELSE 'in-progress' END AS status_class
FROM cat c JOIN (SELECT book_id, count(*) AS n FROM cat GROUP BY book_id) b ON c.book_id = b.book_id
JOIN (SELECT book_id, count(*) AS n FROM raw_chapters GROUP BY book_id) r ON c.book_id = r.book_id""")

oracle("chapter_page", ["md_blocks", "cat_translations", "cat_summaries", "cat_merged", "toc"], """
SELECT t.book_id, t.chapter_no, printf('chapter_%02d.html', t.chapter_no) AS file,
       concat_ws(chr(10),
         printf('<header><h1>Chapter %d: %s</h1></header>', t.chapter_no, coalesce(c.title, '')),
         CASE WHEN s.text IS NOT NULL THEN '<section class="summary"><h3>Summary</h3><p>' || s.text || '</p></section>' ELSE '' END,
         CASE WHEN m.chapter_no IS NOT NULL
              THEN printf('<section class="audio"><audio controls src="../audio/chapter_%02d_full.mp3"></audio></section>', t.chapter_no)
              ELSE '' END,
         '<article>' || chr(10) || coalesce(b.body, '') || chr(10) || '</article>') AS html
FROM cat_translations t
LEFT JOIN (SELECT book_id, chapter_no, string_agg(html, chr(10) ORDER BY block_no) AS body
           FROM md_blocks GROUP BY book_id, chapter_no) b ON t.book_id = b.book_id AND t.chapter_no = b.chapter_no
LEFT JOIN cat_summaries s ON t.book_id = s.book_id AND t.chapter_no = s.chapter_no
LEFT JOIN cat_merged m ON t.book_id = m.book_id AND t.chapter_no = m.chapter_no
LEFT JOIN toc c ON t.chapter_no = c.chapter_no""")


# --- step 11: round trips ---------------------------------------------------------------------

oracle("text_file_roundtrip", ["chapter_text"], """
SELECT book_id, chapter_no, CAST(length(file_text) AS INTEGER) AS n_chars, file_text FROM chapter_text""")

oracle("json_roundtrip", ["cat"],
       "SELECT book_id, number, title, summary, hasAudio, wordCount, file FROM cat")

oracle("incremental_run", ["audio_parts"], """
SELECT book_id, chapter_no, part_no, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes FROM audio_parts""")


# --- additions -------------------------------------------------------------------------------

oracle("line_neighbours", ["fmt_lines"], """
SELECT book_id, chapter_no, CAST(i AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS n_chars,
       coalesce(prev_s = '', true) AS prev_blank, coalesce(next_s = '', true) AS next_blank
FROM fmt_lines""")

oracle("clean_audit", ["broken_docs", "repaired"], """
SELECT b.book_id, CAST(sum(length(b.text)) AS BIGINT) AS chars_before, CAST(sum(length(r.fixed)) AS BIGINT) AS chars_after,
       min(length(r.fixed) / length(b.text)) AS min_ratio, max(length(r.fixed) / length(b.text)) AS max_ratio,
       count(*) FILTER (WHERE r.fixed = b.original) AS n_restored, count(*) AS n_chapters
FROM broken_docs b JOIN repaired r ON b.book_id = r.book_id AND b.chapter_no = r.chapter_no
GROUP BY b.book_id""")

oracle("binary_roundtrip", ["merged"], """
SELECT book_id, chapter_no, CAST(octet_length(encode(body)) AS BIGINT) AS n_bytes, md5(body) AS md5,
       min(printf('chapter_%02d_full.mp3', chapter_no)) OVER (PARTITION BY book_id) AS first_file
FROM merged WHERE body IS NOT NULL""")

view("book_texts", f"""
SELECT book_id, string_agg(text, {NL2} ORDER BY page_no) AS text FROM book_pages
WHERE text IS NOT NULL AND text <> '' GROUP BY book_id""", ["book_pages"])
_dx_cte, _dx_sel = boundary_chunks_sql("book_texts", "book_id")
view("dx", _dx_cte.replace("bx", "dx"), ["book_texts"], raw=True)
oracle("chunk_distributed", ["dx"], _dx_sel.replace("bx", "dx"))

oracle("incremental_arrivals", ["speech_chunks"], """
SELECT book_id, chapter_no, part_no, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes FROM speech_chunks""")

oracle("binary_committed", ["merged"], """
SELECT book_id, chapter_no, CAST(octet_length(encode(body)) AS BIGINT) AS n_bytes, md5(body) AS md5
FROM merged WHERE body IS NOT NULL""")

oracle("segment_pages", ["seg_chapters"], """
SELECT book_id, pattern_no, chapter_no, title, CAST(length(text) AS INTEGER) AS n_chars,
       CAST(k + 1 AS INTEGER) AS piece_no, substring(text, 10000 * k + 1, 10000) AS text
FROM (SELECT *, unnest(range(0, (length(text) - 1) // 10000 + 1)) AS k FROM seg_chapters
      WHERE pattern_no = 0 OR length(text) >= 500)""")

oracle("summary_files", ["cat_summaries", "raw_chapters"], """
SELECT s.book_id, s.chapter_no, s.text, printf('chapter_%02d_summary_formatted.md', s.chapter_no) AS formatted_file
FROM cat_summaries s JOIN raw_chapters r ON r.book_id = s.book_id AND r.chapter_no = s.chapter_no""")
