"""DuckDB SQL oracles, one per registered query.

Each oracle is a single SQL statement over the driver's tables (pre-registered
as views). The fixture views of FIXTURES.md are inlined as CTEs; the logic is
written again relationally (range joins, ``string_agg``, windows), so the
Spark plans are checked against an independent formulation. Card oracles use
the fixture's reply ``variant`` (which fixes the expected cards) instead of
parsing JSON, an independent check of the Spark parser.
"""

from __future__ import annotations

import re

from quire.functions.text import DIGIT, DIGITLIKE, HEADING_RULES, HEADING_WORDS, WS, WS_CHARS
from quire.operators.suitability import LEGAL_PATTERNS, SKIP_CONTENT_PATTERNS, SKIP_TITLE_PATTERNS

WSL = "'" + WS_CHARS + "'"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"trim({x}, {WSL})"


def wc(x: str) -> str:
    return f"CAST(len(list_filter(string_split_regex({x}, '{WS}+'), lambda s: s <> '')) AS BIGINT)"


def decode(x: str) -> str:
    # Named references present in the data; '&amp;' last.
    out = x
    for name, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"),
                     ("&nbsp;", "\xa0"), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return out


def preview(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '...' ELSE {x} END"


def heading_like(t: str) -> str:
    words = " OR ".join(f"contains(lower({t}), '{w}')" for w in HEADING_WORDS)
    title_case = (
        f"(regexp_matches({t}, '[\\p{{Lu}}\\p{{Lt}}\\p{{Ll}}]') "
        f"AND NOT regexp_matches({t}, '(?:^|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}])\\p{{Ll}}') "
        f"AND NOT regexp_matches({t}, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}][\\p{{Lu}}\\p{{Lt}}]') "
        f"AND length({t}) BETWEEN 10 AND 100 AND {wc(t)} <= 8)"
    )
    return f"({words} OR regexp_matches({t}, '^{DIGIT}+\\.?{WS}+[A-Z]') OR {title_case})"


def heading_rule(line: str) -> str:
    low = f"lower({strip(line)})"
    whens = " ".join(f"WHEN regexp_matches({low}, '{p}') THEN '{rid}'" for rid, p in HEADING_RULES)
    return f"CASE {whens} END"


NON_TEXT = (r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
            r"|<template\b[^>]*>.*?</template\s*>")


def html_text(h: str) -> str:
    parts = f"string_split_regex(regexp_replace({h}, '{NON_TEXT}', '<x>', 'g'), '<[^>]*>')"
    return (f"array_to_string(list_filter(list_transform({parts}, lambda s: {strip(decode('s'))}), "
            f"lambda s: s <> ''), ' ')")


def first_el(h: str, tag: str) -> str:
    return f"regexp_extract({h}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)"


def has_el(h: str, tag: str) -> str:
    return f"regexp_matches({h}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>')"


def heading_text(h: str, tag: str) -> str:
    return strip(decode(f"regexp_replace({first_el(h, tag)}, '<[^>]*>', '', 'g')"))


def title_case_sql(h: str, n: str) -> tuple[str, str]:
    t_in = first_el(h, "title")
    t_ok = f"({has_el(h, 'title')} AND {t_in} <> '' AND strpos({t_in}, '<') = 0)"
    title = f"CASE WHEN {t_ok} THEN {strip(decode(t_in))}"
    src = f"CASE WHEN {t_ok} THEN (CASE WHEN {strip(decode(t_in))} = '' THEN 'title_blank' ELSE 'title' END)"
    for tag in ("h1", "h2", "h3"):
        ok = f"({has_el(h, tag)} AND {heading_text(h, tag)} <> '')"
        title += f" WHEN {ok} THEN {heading_text(h, tag)}"
        src += f" WHEN {ok} THEN '{tag}'"
    return title + f" ELSE 'Chapter ' || {n} END", src + " ELSE 'fallback' END"


def safe_name(x: str) -> str:
    tr = f"translate({x}, '<>:\"/\\|?*', '_________')"
    return f"substr(replace({strip(tr)}, ' ', '_'), 1, 100)"


# ---------------------------------------------------------------------------
# CTEs: fixture views (FIXTURES.md section B) and shared derived tables
# ---------------------------------------------------------------------------

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("fx_raw_lines", """SELECT doc_id AS book_id, CAST(i - 1 AS BIGINT) AS line_no, a[i] AS raw
FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
     LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)""")
cte("fx_lines", """SELECT book_id, line_no, CAST(floor(line_no / 4) AS BIGINT) AS page_num,
  CASE WHEN book_id % 5 = 4 THEN raw
       WHEN line_no % 14 = 0 THEN concat('Chapter ', CAST(CAST(floor(line_no / 14) AS BIGINT) + 1 AS VARCHAR))
       WHEN line_no % 14 = 7 THEN concat('PART ', CAST(CAST(floor(line_no / 14) AS BIGINT) + 1 AS VARCHAR))
       WHEN line_no % 14 = 9 THEN concat('  3. Uber   ', raw, ' ')
       WHEN line_no % 14 = 10 THEN concat('12 apples ', raw)
       WHEN line_no % 14 = 5 THEN concat('Page ', CAST(CAST(floor(line_no / 4) AS BIGINT) AS VARCHAR), ' of 9')
       WHEN line_no % 14 = 11 THEN '12345'
       ELSE raw END AS line
FROM fx_raw_lines""", "fx_raw_lines")
cte("fx_page_counts", "SELECT book_id, max(page_num) + 1 AS page_count FROM fx_lines GROUP BY book_id", "fx_lines")
cte("fx_toc", """SELECT book_id, line_no AS entry_no,
  CAST(CASE WHEN book_id % 10 = 5 THEN 3 WHEN line_no % 28 = 21 THEN 3 WHEN line_no % 14 = 7 THEN 2 ELSE 1 END AS INT) AS level,
  line AS title, page_num + 1 AS page
FROM fx_lines WHERE book_id % 5 = 0 AND line_no % 14 IN (0, 4, 7)""", "fx_lines")
cte("fx_spans", """SELECT book_id, page_num, line_no AS span_no, line AS text,
  CAST(CASE WHEN line_no % 14 = 0 THEN 18.0 WHEN line_no % 14 = 7 THEN 16.0 ELSE 10.0 END AS DOUBLE) AS font_size,
  CASE WHEN line_no % 14 IN (0, 7) THEN 'Serif-Bold' ELSE 'Serif' END AS font_name,
  CAST(line_no % 4 * 20.0 AS DOUBLE) AS y_position
FROM fx_lines WHERE book_id % 5 = 1""", "fx_lines")
cte("fx_spine", """SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS book_id, page_id AS spine_pos,
       concat('item', CAST(page_id AS VARCHAR)) AS item_id FROM pages""")
cte("fx_items", """SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS book_id, concat('item', CAST(page_id AS VARCHAR)) AS item_id,
  CASE WHEN page_id % 7 = 5 THEN 'image' ELSE 'document' END AS item_type,
  concat('text/p', CAST(page_id AS VARCHAR), '.xhtml') AS file_name,
  CASE WHEN page_id % 13 = 6 THEN '<html><body><script>var x = 1;</script> <!-- none --></body></html>'
       WHEN page_id % 6 = 1 THEN replace(replace(html, '<title>', '<meta name="t"><i>'), '</title>', '</i>')
       WHEN page_id % 6 = 2 THEN replace(html, '<title>', '<title> </title><title>')
       WHEN page_id % 6 = 3 THEN replace(replace(replace(replace(html, '<title>', '<i>'), '</title>', '</i>'), '<h1>', '<h2 class="c"> '), '</h1>', '</h2>')
       WHEN page_id % 6 = 4 THEN replace(replace(replace(replace(html, '<title>', '<i>'), '</title>', '</i>'), '<h1>', '<h1> </h1><h3>'), '</h1><p>', '</h3><p>')
       WHEN page_id % 6 = 5 THEN replace(replace(replace(replace(html, '<title>', '<i>'), '</title>', '</i>'), '<h1>', '<p>'), '</h1>', '</p>')
       ELSE html END AS html
FROM pages WHERE page_id % 11 <> 3""")
cte("fx_books", """SELECT source AS book_id, min(CAST(substr(source, 4) AS BIGINT)) AS discovery_no,
  concat('Vol/', CAST(min(CAST(substr(source, 4) AS BIGINT)) % 15 AS VARCHAR), ': "Notes"? ') AS title,
  CASE WHEN min(CAST(substr(source, 4) AS BIGINT)) % 4 = 0 THEN '' ELSE concat('Author ', source) END AS author,
  concat('/books/my_', source, '-vol.pdf') AS file_path
FROM documents GROUP BY source""")
cte("fx_chapters", """SELECT source AS book_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INT) AS chapter_number,
  CASE WHEN doc_id % 9 = 1 THEN 'Discover the Market' WHEN doc_id % 9 = 2 THEN 'About this book'
       WHEN doc_id % 9 = 3 THEN 'Title Page' ELSE concat('Lesson ', CAST(doc_id AS VARCHAR)) END AS title,
  CASE WHEN doc_id % 7 = 1 THEN concat(text, ' All Rights Reserved. ISBN 1. www.example.com')
       WHEN doc_id % 7 = 2 THEN concat(text, ' Copyright. Index.')
       WHEN doc_id % 7 = 3 THEN concat('  ', text, '          ')
       WHEN doc_id % 7 = 4 THEN concat(text, ' Disclaimer: © liability, see https://example.com')
       WHEN doc_id % 97 = 5 THEN '  '
       ELSE text END AS content,
  concat('doc', CAST(doc_id AS VARCHAR), '.xhtml') AS file_name
FROM documents""")
cte("fx_reply_base", """SELECT conv_id, turn, concat('src', CAST(conv_id % 20 AS VARCHAR)) AS book_id, conv_id * 100 + turn AS reply_id,
  concat('Lesson ', CAST(conv_id AS VARCHAR)) AS chapter_title, (conv_id * 3 + turn) % 14 AS variant,
  replace(replace(text, chr(10), ' '), '"', ' ') AS q, concat('A: ', replace(replace(text, chr(10), ' '), '"', ' ')) AS a
FROM conversations WHERE role = 'assistant'""")
cte("fx_cards_json", """SELECT conv_id, turn, reply_id, book_id, chapter_title, variant, q, a,
  concat('{"front":"', q, '","back":"', a, '","card_type":"basic","tags":["t::s","u"],"source":"S 1","difficulty":2}') AS g,
  concat('{"front":"', q, '","back":"', a, '","card_type":"cloze"}') AS d,
  concat('```', chr(10)) AS fence
FROM fx_reply_base""", "fx_reply_base")
cte("fx_responses", """SELECT conv_id, turn, reply_id, book_id, chapter_title, variant,
  CASE variant
    WHEN 0 THEN concat('Here you go:', chr(10), '```json', chr(10), '{"cards":[', g, ',', d, ']}', chr(10), fence, 'Bye {x}')
    WHEN 1 THEN concat(fence, '{"cards":[', g, ']}', chr(10), fence)
    WHEN 2 THEN concat('{"cards":[', d, ',', d, ']}')
    WHEN 3 THEN concat('Sure. {"cards":[', g, ']} Enjoy.')
    WHEN 4 THEN 'no json at all'
    WHEN 5 THEN '{"other":["no","cards"]}'
    WHEN 6 THEN concat('[', g, ']')
    WHEN 7 THEN concat('{"cards":[', g, ',{"front":"', q, '","card_type":"qa","difficulty":"hard"}]}')
    WHEN 8 THEN concat('{"cards":[', g, ',{"front":"', q, '","back":"x","card_type":"qa","difficulty":"hard"}]}')
    WHEN 9 THEN concat('{"cards":[{"front":"', q, '","back":"x","card_type":"qa","tags":null}]}')
    WHEN 10 THEN concat('```json', chr(10), '{bad}', chr(10), fence, '{"cards":[', g, ']}')
    WHEN 11 THEN concat('{"cards":["x",{"front":"', q, '","back":"x","card_type":"odd","difficulty":" 3 "}]} trailing')
    WHEN 12 THEN concat('{"cards":[{"front":"', q, '","back":"x","card_type":"definition","difficulty":0,"tags":[]}]}')
    ELSE '{"cards":null}' END AS response_text
FROM fx_cards_json""", "fx_cards_json")
cte("fx_files", """SELECT page_id AS file_no, concat('/books/a.b/f', CAST(page_id AS VARCHAR),
  CASE page_id % 5 WHEN 0 THEN '.epub' WHEN 1 THEN '.PDF' WHEN 2 THEN '.Epub' WHEN 3 THEN '.mobi' ELSE '.pdf' END) AS path,
  page_id % 17 <> 4 AS parse_ok
FROM pages""")

# --- paged books: lines, pages, boundaries ---------------------------------
cte("clean_all", f"""SELECT book_id, page_num, line_no, clean,
  CASE WHEN length(clean) < 5 THEN 'short'
       WHEN regexp_matches(clean, '^{DIGIT}+$') THEN 'digits'
       WHEN regexp_matches(lower(clean), '^page {DIGIT}+') THEN 'page_number'
       WHEN regexp_matches(clean, '^{DIGITLIKE}+$') THEN 'digit_like' END AS noise_rule
FROM (SELECT book_id, page_num, line_no, {strip("regexp_replace(line, ' +', ' ', 'g')")} AS clean FROM fx_lines)""", "fx_lines")
cte("kept", "SELECT book_id, page_num, line_no, clean FROM clean_all WHERE noise_rule IS NULL", "clean_all")
cte("ptext", f"SELECT book_id, page_num, string_agg(clean, {NL} ORDER BY line_no) AS ptext FROM kept GROUP BY book_id, page_num", "kept")
cte("heads", f"""SELECT book_id, page_num, line_no, rule, title FROM (
  SELECT book_id, page_num, line_no, {heading_rule('line')} AS rule, {strip('line')} AS title FROM fx_lines)
WHERE rule IS NOT NULL""", "fx_lines")
cte("b_toc", """SELECT t.book_id, 'toc' AS strategy, 1 AS priority, CAST(t.ordinal AS INTEGER) AS ordinal, t.title,
  t.start_page, coalesce(t.next_start, pc.page_count) AS end_page,
  'page_' || CAST(t.start_page + 1 AS VARCHAR) || '_to_' || CAST(coalesce(t.next_start, pc.page_count) AS VARCHAR) || '.pdf' AS file_name
FROM (SELECT book_id, title, greatest(page - 1, 0) AS start_page,
        row_number() OVER w AS ordinal, lead(greatest(page - 1, 0)) OVER w AS next_start
      FROM fx_toc WHERE level <= 2 WINDOW w AS (PARTITION BY book_id ORDER BY entry_no)) t
JOIN fx_page_counts pc ON pc.book_id = t.book_id""", "fx_toc", "fx_page_counts")
cte("cands", f"""SELECT book_id, page_num, span_no, font_size, text FROM (
  SELECT book_id, page_num, span_no, font_size, {strip('text')} AS text FROM fx_spans WHERE page_num < 10)
WHERE length(text) > 5 AND {heading_like('text')}""", "fx_spans")
cte("modal", """SELECT book_id, arg_max(font_size, (n, font_size)) AS heading_size
FROM (SELECT book_id, font_size, count(*) AS n FROM cands GROUP BY book_id, font_size) GROUP BY book_id""", "cands")
cte("b_font", """SELECT p.book_id, 'font' AS strategy, 2 AS priority, CAST(p.ordinal AS INTEGER) AS ordinal,
  coalesce(f.first_text, 'Chapter ' || CAST(p.ordinal AS VARCHAR)) AS title, p.page_num AS start_page,
  coalesce(p.next_start, pc.page_count) AS end_page, 'chapter_' || CAST(p.ordinal AS VARCHAR) || '.pdf' AS file_name
FROM (SELECT book_id, page_num, row_number() OVER w AS ordinal, lead(page_num) OVER w AS next_start
      FROM (SELECT DISTINCT c.book_id, c.page_num FROM cands c JOIN modal m ON m.book_id = c.book_id
            WHERE c.font_size >= m.heading_size - 1)
      WINDOW w AS (PARTITION BY book_id ORDER BY page_num)) p
JOIN fx_page_counts pc ON pc.book_id = p.book_id
LEFT JOIN (SELECT book_id, page_num, arg_min(text, span_no) AS first_text FROM cands GROUP BY book_id, page_num) f
  ON f.book_id = p.book_id AND f.page_num = p.page_num""", "cands", "modal", "fx_page_counts")
# The same with outline entries and spans of every book.
_EVERY = ("fx_toc", "fx_spans", "b_toc", "cands", "modal", "b_font")


def _every(name: str) -> str:
    return name + "_every" if name in _EVERY else name


for _name in _EVERY:
    _sql, _deps = CTES[_name]
    for _old in _EVERY:
        _sql = re.sub(rf"\b{_old}\b", _every(_old), _sql)
    _sql = _sql.replace("WHERE book_id % 5 = 0 AND ", "WHERE ").replace(" WHERE book_id % 5 = 1", "")
    cte(_every(_name), _sql, *map(_every, _deps))

cte("b_pattern", """SELECT h.book_id, 'pattern' AS strategy, 3 AS priority, CAST(h.ordinal AS INTEGER) AS ordinal, h.title,
  h.page_num AS start_page, coalesce(h.next_start, pc.page_count) AS end_page,
  'chapter_' || CAST(h.ordinal AS VARCHAR) || '.pdf' AS file_name
FROM (SELECT book_id, title, page_num, row_number() OVER w AS ordinal, lead(page_num) OVER w AS next_start
      FROM heads WINDOW w AS (PARTITION BY book_id ORDER BY line_no)) h
JOIN fx_page_counts pc ON pc.book_id = h.book_id""", "heads", "fx_page_counts")
cte("b_chunks", """SELECT book_id, 'chunks' AS strategy, 4 AS priority, CAST(s // 10 + 1 AS INTEGER) AS ordinal,
  CAST(NULL AS VARCHAR) AS title, s AS start_page, least(s + 10, page_count) AS end_page,
  'pages_' || CAST(s + 1 AS VARCHAR) || '_to_' || CAST(least(s + 10, page_count) AS VARCHAR) || '.pdf' AS file_name
FROM (SELECT book_id, page_count, unnest(range(0, page_count, 10)) AS s FROM fx_page_counts)""", "fx_page_counts")
cte("all_b", """SELECT * FROM b_toc UNION ALL SELECT * FROM b_font UNION ALL SELECT * FROM b_pattern
UNION ALL SELECT * FROM b_chunks""", "b_toc", "b_font", "b_pattern", "b_chunks")


def _content_cte(name: str, src: str) -> None:
    cte(name, f"""SELECT b.*, coalesce((SELECT string_agg(p.ptext, {NL} || {NL} ORDER BY p.page_num) FROM ptext p
    WHERE p.book_id = b.book_id AND p.page_num >= b.start_page AND p.page_num < b.end_page
      AND p.page_num < (SELECT page_count FROM fx_page_counts pc WHERE pc.book_id = b.book_id)), '') AS content
FROM {src} b""", src, "ptext", "fx_page_counts")


for _src in ("b_toc", "b_font", "b_pattern", "all_b", "b_toc_every", "b_font_every"):
    _content_cte(f"{_src}_text", _src)

cte("resolved", """SELECT book_id, strategy,
  CAST(CASE WHEN strategy = 'chunks' THEN row_number() OVER (PARTITION BY book_id ORDER BY start_page) ELSE ordinal END AS INTEGER) AS chapter_number,
  CASE WHEN strategy = 'chunks' THEN 'Section ' || CAST(row_number() OVER (PARTITION BY book_id ORDER BY start_page) AS VARCHAR) ELSE title END AS title,
  content, file_name, start_page, end_page
FROM (SELECT t.* FROM all_b_text t
      JOIN (SELECT book_id, min(priority) AS priority FROM all_b_text WHERE content <> '' GROUP BY book_id) w
        ON w.book_id = t.book_id AND w.priority = t.priority
      WHERE t.content <> '')""", "all_b_text")

# --- spine books -------------------------------------------------------------
cte("spine_docs", f"""SELECT book_id, item_id, file_name, html, {html_text('html')} AS content
FROM fx_items WHERE item_type = 'document'""", "fx_items")
_t, _src = title_case_sql("html", "CAST(chapter_number AS VARCHAR)")
cte("spine_ch", f"""SELECT book_id, chapter_number, {_t} AS title, content, file_name, {_src} AS title_from FROM (
  SELECT s.book_id, CAST(row_number() OVER (PARTITION BY s.book_id ORDER BY s.spine_pos) AS INTEGER) AS chapter_number,
         d.content, d.file_name, d.html
  FROM fx_spine s JOIN spine_docs d ON d.book_id = s.book_id AND d.item_id = s.item_id WHERE d.content <> '')""",
    "fx_spine", "spine_docs")

# --- chapters of fx_chapters: suitability -------------------------------------
_title_hit = " OR ".join(f"contains(lower(title), '{p}')" for p in SKIP_TITLE_PATTERNS)
_skip = " + ".join(f"CAST(contains(lower(content), '{p}') AS INTEGER)" for p in SKIP_CONTENT_PATTERNS)
_legal = " + ".join(f"(CASE WHEN contains(lower(content), '{p}') THEN {len(p)} ELSE 0 END)" for p in LEGAL_PATTERNS)
cte("suit", f"""SELECT *, CASE WHEN NOT long_enough THEN 'length' WHEN NOT title_ok THEN 'title'
    WHEN skip_count >= 3 THEN 'boilerplate' WHEN legal_ratio > 0.3 THEN 'legal_ratio' END AS first_reason
FROM (SELECT book_id, chapter_number, title, content, file_name,
  length({strip('content')}) >= 200 AS long_enough, NOT ({_title_hit}) AS title_ok,
  CAST({_skip} AS INTEGER) AS skip_count,
  coalesce(CAST({_legal} AS DOUBLE) / nullif(CAST(length(content) AS DOUBLE), 0), 0.0) AS legal_ratio
FROM fx_chapters)""", "fx_chapters")
cte("suitable", "SELECT book_id, chapter_number, title, content, file_name FROM suit WHERE first_reason IS NULL", "suit")

# --- replies: expected cards per fixture variant -----------------------------
cte("variant_spec", """SELECT * FROM (VALUES
  (0, 'fenced', 'cards_list', 2, 2, 0, 0, 2), (1, 'fenced', 'cards_list', 1, 1, 0, 0, 1),
  (2, 'direct', 'cards_list', 2, 2, 0, 0, 2), (3, 'greedy', 'cards_list', 1, 1, 0, 0, 1),
  (4, 'none', 'unparsed', 0, 0, 0, 0, 0), (5, 'direct', 'no_cards_key', 0, 0, 0, 0, 0),
  (6, 'direct', 'not_object', 0, 0, 0, 0, 0), (7, 'direct', 'cards_list', 2, 1, 1, 0, 1),
  (8, 'direct', 'cards_list', 2, 1, 0, 1, 0), (9, 'direct', 'cards_list', 1, 0, 0, 1, 0),
  (10, 'none', 'unparsed', 0, 0, 0, 0, 0), (11, 'greedy', 'cards_list', 2, 1, 1, 0, 1),
  (12, 'direct', 'cards_list', 1, 1, 0, 0, 1), (13, 'direct', 'cards_not_list', 0, 0, 0, 0, 0)
) t(variant, stage, shape, items, ok, skipped, fatal, cards)""")
cte("card_spec", """SELECT * FROM (VALUES
  (0, 1, 'ok', false), (0, 2, 'ok', false), (1, 1, 'ok', false), (2, 1, 'ok', false), (2, 2, 'ok', false),
  (3, 1, 'ok', false), (7, 1, 'ok', false), (7, 2, 'skip', false), (8, 1, 'ok', true), (8, 2, 'fatal', true),
  (9, 1, 'fatal', true), (11, 1, 'skip', false), (11, 2, 'ok', false), (12, 1, 'ok', false)
) t(variant, card_no, status, reply_fatal)""")
cte("vcards", """SELECT reply_id, book_id, CAST(1 AS INTEGER) AS card_no, q AS front, a AS back, 'basic' AS card_type,
  ['t::s', 'u'] AS tags, 'S 1' AS source, CAST(2 AS BIGINT) AS difficulty FROM fx_cards_json WHERE variant IN (0, 1, 3, 7)
UNION ALL SELECT reply_id, book_id, 2, q, a, 'cloze', CAST([] AS VARCHAR[]), chapter_title, NULL FROM fx_cards_json WHERE variant = 0
UNION ALL SELECT reply_id, book_id, 1, q, a, 'cloze', CAST([] AS VARCHAR[]), chapter_title, NULL FROM fx_cards_json WHERE variant = 2
UNION ALL SELECT reply_id, book_id, 2, q, a, 'cloze', CAST([] AS VARCHAR[]), chapter_title, NULL FROM fx_cards_json WHERE variant = 2
UNION ALL SELECT reply_id, book_id, 2, q, 'x', 'odd', CAST([] AS VARCHAR[]), chapter_title, 3 FROM fx_cards_json WHERE variant = 11
UNION ALL SELECT reply_id, book_id, 1, q, 'x', 'definition', CAST([] AS VARCHAR[]), chapter_title, 0 FROM fx_cards_json WHERE variant = 12""",
    "fx_cards_json")

# --- book totals over fx_books / fx_chapters ------------------------------------
cte("fx_totals", f"""SELECT b.book_id, CAST(coalesce(c.chapters, 0) AS BIGINT) AS chapters, CAST(coalesce(c.words, 0) AS BIGINT) AS words
FROM fx_books b LEFT JOIN (SELECT book_id, count(*) AS chapters, sum({wc('content')}) AS words FROM fx_chapters GROUP BY book_id) c
  ON c.book_id = b.book_id""", "fx_books", "fx_chapters")
cte("export_books", f"""SELECT book_id, file_stem, title, author FROM (
  SELECT b.*, {safe_name('b.title')} AS file_stem,
         row_number() OVER (PARTITION BY {safe_name('b.title')} ORDER BY b.discovery_no DESC) AS rn
  FROM fx_books b WHERE b.book_id IN (SELECT book_id FROM vcards)) WHERE rn = 1""", "fx_books", "vcards")
cte("export_cards", """SELECT c.*, e.file_stem, e.title AS book_title, e.author AS book_author
FROM vcards c JOIN export_books e ON e.book_id = c.book_id""", "vcards", "export_books")

# --- extractive cards --------------------------------------------------------
_DEF = r"(?s)^([A-Z][A-Za-z]*(?: [A-Za-z]+){0,3}) (?:is|are) (?:a|an|the) (.+)$"


def extractive_cte(name: str, src: str) -> None:
    cand = (f"list_filter(list_transform(list_transform(regexp_extract_all(content, '[^.!?]+[.!?]*'), "
            f"lambda s: {strip('s')}), lambda s: {{'s': s, 'k': CASE WHEN length(s) < 20 THEN NULL "
            f"WHEN regexp_matches(s, '[0-9]+') THEN 'cloze' WHEN regexp_matches(s, '{_DEF}') THEN 'definition' END}}), "
            f"lambda c: c.k IS NOT NULL)[1:5]")
    cte(name, f"""SELECT book_id, chapter_number, CAST(card_no AS INTEGER) AS card_no,
  CASE WHEN c.k = 'cloze' THEN regexp_replace(c.s, '(?s)^(.*?)([0-9]+)(.*)$', '\\1{{{{c1::\\2}}}}\\3')
       ELSE 'Define: ' || regexp_extract(c.s, '{_DEF}', 1) END AS front,
  CASE WHEN c.k = 'cloze' THEN regexp_extract(c.s, '[0-9]+', 0) ELSE c.s END AS back,
  c.k AS card_type, title AS source, CAST(CASE WHEN c.k = 'cloze' THEN 2 ELSE 1 END AS BIGINT) AS difficulty
FROM (SELECT book_id, chapter_number, title, unnest(cands) AS c, generate_subscripts(cands, 1) AS card_no
      FROM (SELECT book_id, chapter_number, title, {cand} AS cands FROM {src}))""", src)


extractive_cte("ex_cards", "suitable")
cte("resolved_suitable", f"""SELECT book_id, chapter_number, title, content FROM resolved
WHERE length({strip('content')}) >= 200 AND NOT ({_title_hit}) AND ({_skip}) < 3
  AND coalesce(CAST({_legal} AS DOUBLE) / nullif(CAST(length(content) AS DOUBLE), 0), 0.0) <= 0.3""", "resolved")
extractive_cte("corpus_ex", "resolved_suitable")


def _json_str(x: str) -> str:
    return f"CAST(to_json(CAST({x} AS VARCHAR)) AS VARCHAR)"


# ---------------------------------------------------------------------------
# Final statements
# ---------------------------------------------------------------------------

FINAL: dict[str, tuple[str, tuple[str, ...]]] = {}


def q(name: str, sql: str, *deps: str) -> None:
    FINAL[name] = (sql, deps)


_suffix = "regexp_extract(regexp_extract(path, '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1)"
_fmt = f"CASE lower({_suffix}) WHEN '.epub' THEN 'epub' WHEN '.pdf' THEN 'pdf' ELSE 'unsupported' END"
q("format_dispatch", f"SELECT file_no, path, {_suffix} AS suffix, {_fmt} AS format FROM fx_files", "fx_files")
q("run_accounting", """SELECT count(*) AS discovered,
  count(*) FILTER (WHERE fmt <> 'unsupported' AND parse_ok) AS processed,
  count(*) FILTER (WHERE fmt = 'unsupported' OR NOT parse_ok) AS skipped,
  count(*) FILTER (WHERE fmt = 'unsupported') AS unsupported,
  count(*) FILTER (WHERE fmt <> 'unsupported' AND NOT parse_ok) AS failed
FROM (SELECT parse_ok, """ + _fmt + " AS fmt FROM fx_files)", "fx_files")
cte("file_reasons", f"""SELECT file_no, path, CASE WHEN {_fmt} = 'unsupported' THEN 'unsupported_format'
  WHEN NOT parse_ok THEN 'unreadable' END AS reject_reason FROM fx_files""", "fx_files")
q("file_routing", "SELECT file_no, path, reject_reason FROM file_reasons", "file_reasons")
q("chapter_routing", "SELECT book_id, chapter_number, title, first_reason AS reject_reason FROM suit", "suit")
q("reject_accounting", """SELECT level, outcome, count(*) AS "rows" FROM (
  SELECT 'file' AS level, coalesce(reject_reason, 'accepted') AS outcome FROM file_reasons
  UNION ALL SELECT 'chapter', coalesce(first_reason, 'accepted') FROM suit) GROUP BY ALL""", "file_reasons", "suit")
q("html_text", f"SELECT page_id, {html_text('html')} AS text FROM pages")
q("chapter_title", "SELECT book_id, chapter_number, title, title_from FROM spine_ch", "spine_ch")
q("book_metadata", f"""SELECT book_id,
  CASE WHEN discovery_no % 3 = 0 THEN 'Unknown Title' ELSE title END AS spine_title,
  coalesce(nullif(CASE WHEN discovery_no % 2 = 1 THEN title ELSE '' END, ''),
           translate(regexp_replace(regexp_extract(file_path, '([^/]*)$', 1), '^(.+)\\.[^.]+$', '\\1'), '_-', '  ')) AS paged_title,
  coalesce(nullif(author, ''), 'Unknown Author') AS author
FROM fx_books""", "fx_books")
q("word_count", f"SELECT doc_id, {wc('text')} AS words FROM documents")
q("preview_text", f"""SELECT book_id, chapter_number, {preview('title', 60)} AS title_60, {preview('content', 80)} AS content_80,
  {preview('content', 100)} AS content_100 FROM fx_chapters""", "fx_chapters")
q("safe_filename", f"SELECT book_id, title, {safe_name('title')} AS file_stem FROM fx_books", "fx_books")
q("display_fields", """SELECT book_id, format('{:,}', words) AS words_display, format('{:,}', chapters) AS chapters_display,
  'ANKI' AS format_display FROM fx_totals""", "fx_totals")
q("page_lines", "SELECT book_id, line_no, page_num, line FROM fx_lines", "fx_lines")
q("clean_lines", "SELECT book_id, page_num, line_no, clean FROM kept", "kept")
q("line_noise_profile", """SELECT book_id, count(*) AS lines, count(*) FILTER (WHERE noise_rule IS NULL) AS kept,
  count(*) FILTER (WHERE noise_rule = 'short') AS short, count(*) FILTER (WHERE noise_rule = 'digits') AS digits,
  count(*) FILTER (WHERE noise_rule = 'page_number') AS page_number, count(*) FILTER (WHERE noise_rule = 'digit_like') AS digit_like
FROM clean_all GROUP BY book_id""", "clean_all")
q("page_text", "SELECT book_id, page_num, ptext FROM ptext", "ptext")
q("range_text", "SELECT book_id, ordinal, start_page, end_page, content FROM b_toc_text", "b_toc_text")
q("heading_like", f"SELECT book_id, span_no, {heading_like(strip('text'))} AS heading_like FROM fx_spans", "fx_spans")
q("heading_pattern", "SELECT book_id, line_no, rule, title FROM heads", "heads")
q("boundaries", "SELECT book_id, strategy, ordinal, title, start_page, end_page, file_name FROM all_b", "all_b")
for _n, _s in (("toc_chapters", "b_toc_text"), ("font_chapters", "b_font_text"), ("pattern_chapters", "b_pattern_text")):
    q(_n, f"SELECT book_id, ordinal AS chapter_number, title, content, file_name FROM {_s} WHERE content <> ''", _s)
q("font_candidates", "SELECT book_id, page_num, span_no, text, font_size FROM cands", "cands")
q("modal_font_size", "SELECT book_id, heading_size FROM modal", "modal")
q("range_text_every", "SELECT book_id, ordinal, start_page, end_page, content FROM b_toc_every_text", "b_toc_every_text")
q("heading_like_every", f"SELECT book_id, span_no, {heading_like(strip('text'))} AS heading_like FROM fx_spans_every", "fx_spans_every")
for _n, _s in (("toc_chapters_every", "b_toc_every_text"), ("font_chapters_every", "b_font_every_text")):
    q(_n, f"SELECT book_id, ordinal AS chapter_number, title, content, file_name FROM {_s} WHERE content <> ''", _s)
q("font_candidates_every", "SELECT book_id, page_num, span_no, text, font_size FROM cands_every", "cands_every")
q("modal_font_size_every", "SELECT book_id, heading_size FROM modal_every", "modal_every")
q("page_chunks", f"""SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY start_page) AS INTEGER) AS chapter_number,
  'Section ' || CAST(row_number() OVER (PARTITION BY book_id ORDER BY start_page) AS VARCHAR) AS title, content, file_name
FROM (SELECT * FROM all_b_text WHERE strategy = 'chunks' AND content <> '')""", "all_b_text")
q("chapters_resolved", "SELECT book_id, strategy, chapter_number, title, content, file_name FROM resolved", "resolved")
q("strategy_usage", "SELECT strategy, count(DISTINCT book_id) AS books, count(*) AS chapters FROM resolved GROUP BY strategy",
  "resolved")
q("chapter_cap", """SELECT book_id, chapter_number, title FROM (
  SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY chapter_number) AS rn FROM resolved) WHERE rn <= 2""", "resolved")
q("numbering_audit", """SELECT book_id, chapters, first_number, last_number, last_number - chapters AS gaps,
  first_number = 1 AND last_number - chapters = 0 AS dense
FROM (SELECT book_id, count(*) AS chapters, CAST(min(chapter_number) AS BIGINT) AS first_number,
        CAST(max(chapter_number) AS BIGINT) AS last_number FROM resolved GROUP BY book_id)""", "resolved")
q("book_totals", f"""SELECT p.book_id, CAST(coalesce(r.chapters, 0) AS BIGINT) AS chapters, CAST(coalesce(r.words, 0) AS BIGINT) AS words
FROM fx_page_counts p LEFT JOIN (SELECT book_id, count(*) AS chapters, sum({wc('content')}) AS words FROM resolved GROUP BY book_id) r
  ON r.book_id = p.book_id""", "fx_page_counts", "resolved")
q("spine_chapters", "SELECT book_id, chapter_number, title, content, file_name FROM spine_ch", "spine_ch")
q("spine_dangling", """SELECT s.book_id, s.item_id, s.spine_pos FROM fx_spine s
WHERE NOT EXISTS (SELECT 1 FROM fx_items i WHERE i.book_id = s.book_id AND i.item_id = s.item_id)""", "fx_spine", "fx_items")
q("all_chapters", f"""SELECT 'epub' AS format, book_id, chapter_number, title, {wc('content')} AS words FROM spine_ch
UNION ALL SELECT 'pdf', CAST(book_id AS VARCHAR), chapter_number, title, {wc('content')} FROM resolved""", "spine_ch", "resolved")
q("suit_length", "SELECT book_id, chapter_number, long_enough FROM suit", "suit")
q("suit_title", "SELECT book_id, chapter_number, title_ok FROM suit", "suit")
q("suit_boilerplate", "SELECT book_id, chapter_number, skip_count FROM suit", "suit")
q("suit_legal_ratio", "SELECT book_id, chapter_number, legal_ratio FROM suit", "suit")
q("suitable_chapters", "SELECT book_id, chapter_number, title FROM suitable", "suitable")
q("suit_funnel", "SELECT coalesce(first_reason, 'suitable') AS reason, count(*) AS chapters FROM suit GROUP BY 1", "suit")
q("suit_funnel_by_book", """SELECT book_id, reason, count(*) AS chapters
FROM (SELECT book_id, coalesce(first_reason, 'suitable') AS reason FROM suit) GROUP BY ROLLUP (book_id, reason)""", "suit")
q("card_requests", f"""SELECT book_id, chapter_number,
  {NL} || 'Chapter Title: ' || title || {NL} || {NL} || 'Chapter Content:' || {NL} || content || {NL} || {NL}
  || 'Please generate exactly 5 flashcards from this chapter content following the instructions provided.' || {NL}
  || 'Focus on the most important concepts, definitions, and key points.' || {NL} AS prompt
FROM suitable""", "suitable")
_FENCE = "(?s)```(?:json)?" + WS + "*\\n?(.*?)\\n?```"
q("reply_text", """SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 6 IN (0, 1, 3, 4) THEN nullif(text, '') END AS response_text
FROM conversations""")
q("reply_fenced", f"""SELECT reply_id, CASE WHEN regexp_matches(response_text, '{_FENCE}')
  THEN {strip(f"regexp_extract(response_text, '{_FENCE}', 1)")} END AS fenced FROM fx_responses""", "fx_responses")
q("reply_parse_stage", "SELECT r.reply_id, s.stage FROM fx_responses r JOIN variant_spec s ON s.variant = r.variant",
  "fx_responses", "variant_spec")
q("reply_shape", "SELECT r.reply_id, s.shape FROM fx_responses r JOIN variant_spec s ON s.variant = r.variant",
  "fx_responses", "variant_spec")
q("cards_exploded", """SELECT r.reply_id, CAST(c.card_no AS INTEGER) AS card_no, c.status, c.reply_fatal
FROM fx_responses r JOIN card_spec c ON c.variant = r.variant""", "fx_responses", "card_spec")
q("cards_valid", """SELECT reply_id, book_id, card_no, front, back, card_type, array_to_string(tags, ',') AS tags, source, difficulty
FROM vcards""", "vcards")
q("reply_report", """SELECT r.reply_id, r.book_id, s.stage, s.shape, CAST(s.items AS INTEGER) AS items, CAST(s.ok AS INTEGER) AS ok,
  CAST(s.skipped AS INTEGER) AS skipped, CAST(s.fatal AS INTEGER) AS fatal, CAST(s.cards AS INTEGER) AS cards
FROM fx_responses r JOIN variant_spec s ON s.variant = r.variant""", "fx_responses", "variant_spec")
# What each request and reply of the fixture comes to, from the rules that make them.
cte("fx_attempts", """SELECT r.conv_id, r.turn, r.book_id, s.* FROM fx_responses r JOIN variant_spec s ON s.variant = r.variant""",
    "fx_responses", "variant_spec")
cte("reconciled", """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations),
last AS (SELECT conv_id, count(*) AS attempts, max(turn) AS last_attempt FROM fx_attempts GROUP BY conv_id),
ended AS (SELECT l.conv_id, l.attempts, l.last_attempt, any_value(a.stage) AS stage, any_value(a.shape) AS shape, any_value(a.items) AS items,
    any_value(a.ok) AS ok, any_value(a.skipped) AS skipped, any_value(a.fatal) AS fatal, any_value(a.cards) AS cards
  FROM last l JOIN fx_attempts a ON a.conv_id = l.conv_id AND a.turn = l.last_attempt GROUP BY ALL),
results AS (
  SELECT i.conv_id AS request_id, CASE WHEN e.conv_id IS NULL THEN 'no_reply' WHEN e.cards > 0 THEN 'answered' ELSE 'empty' END AS status,
    CASE WHEN i.conv_id % 10 = 3 THEN 2 ELSE 1 END AS requests, coalesce(e.attempts, 0) AS attempts, e.* EXCLUDE (conv_id, attempts)
  FROM ids i LEFT JOIN ended e ON e.conv_id = i.conv_id
  UNION ALL
  SELECT conv_id + 1000000000000, 'unrequested', 0, attempts, ended.* EXCLUDE (conv_id, attempts) FROM ended WHERE conv_id % 8 = 1
  UNION ALL
  SELECT NULL, 'unidentified', 0, 1, turn, stage, shape, items, ok, skipped, fatal, cards FROM fx_attempts WHERE conv_id % 7 = 5
  UNION ALL
  SELECT CASE WHEN k = 1 THEN -1 - conv_id END, 'no_reply', 1, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM ids, (VALUES (1), (2)) t(k) WHERE k = 1 AND conv_id % 9 = 2 OR k = 2 AND conv_id % 11 = 4)
SELECT * FROM results""", "fx_attempts")
q("reply_reconciliation", """SELECT request_id, status, CAST(requests AS BIGINT) AS requests, CAST(attempts AS BIGINT) AS attempts,
  CAST(last_attempt AS BIGINT) AS last_attempt, stage, shape, CAST(items AS INTEGER) AS items, CAST(ok AS INTEGER) AS ok,
  CAST(skipped AS INTEGER) AS skipped, CAST(fatal AS INTEGER) AS fatal, CAST(cards AS INTEGER) AS cards FROM reconciled""", "reconciled")
q("reconciliation_summary", """SELECT status, count(*) AS keys, CAST(sum(requests) AS BIGINT) AS requests,
  CAST(sum(attempts) AS BIGINT) AS attempts, CAST(coalesce(sum(cards), 0) AS BIGINT) AS cards FROM reconciled GROUP BY status""", "reconciled")
q("card_audit", """SELECT book_id, count(*) AS cards,
  count(*) FILTER (WHERE card_type NOT IN ('basic', 'cloze', 'definition', 'qa')) AS unknown_type,
  count(*) FILTER (WHERE difficulty IS NULL) AS no_difficulty,
  count(*) FILTER (WHERE difficulty IS NOT NULL AND NOT (difficulty BETWEEN 1 AND 5)) AS difficulty_out_of_range,
  count(*) FILTER (WHERE card_type = 'cloze' AND NOT regexp_matches(front, '\\{\\{c1::.+?\\}\\}')) AS cloze_without_marker,
  count(*) FILTER (WHERE NOT list_bool_or(list_transform(tags, lambda t: contains(t, '::')))
                   OR len(tags) = 0) AS flat_tags
FROM vcards GROUP BY book_id""", "vcards")
q("card_mix", """SELECT t.book_id, t.card_type, t.cards, (t.cards * 10000) // b.n AS share_bp,
  CASE t.card_type WHEN 'basic' THEN 6000 WHEN 'cloze' THEN 2000 WHEN 'definition' THEN 1500 WHEN 'qa' THEN 500 END AS target_bp,
  (t.cards * 10000) // b.n - CASE t.card_type WHEN 'basic' THEN 6000 WHEN 'cloze' THEN 2000 WHEN 'definition' THEN 1500
                                               WHEN 'qa' THEN 500 END AS gap_bp
FROM (SELECT book_id, card_type, CAST(sum(n) AS BIGINT) AS cards FROM (
        SELECT book_id, card_type, 1 AS n FROM vcards
        UNION ALL SELECT v.book_id, k.card_type, 0 FROM (SELECT DISTINCT book_id FROM vcards) v,
          (VALUES ('basic'), ('cloze'), ('definition'), ('qa')) k(card_type)) GROUP BY 1, 2) t
JOIN (SELECT book_id, count(*) AS n FROM vcards GROUP BY 1) b ON b.book_id = t.book_id""", "vcards")
q("extractive_cards", "SELECT book_id, chapter_number, card_no, front, back, card_type, source, difficulty FROM ex_cards",
  "ex_cards")
q("card_preview", f"""SELECT book_id, CAST(rk AS INTEGER) AS rank, {preview('front', 60)} AS preview, greatest(n - 3, 0) AS more
FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY reply_id, card_no) AS rk,
             count(*) OVER (PARTITION BY book_id) AS n FROM vcards) WHERE rk <= 3""", "vcards")
q("corpus_summary", """SELECT count(*) AS total_books, CAST(coalesce(sum(chapters), 0) AS BIGINT) AS total_chapters,
  CAST(coalesce(sum(words), 0) AS BIGINT) AS total_words FROM fx_totals""", "fx_totals")
q("book_summary", """SELECT b.book_id, b.title, b.author, t.chapters, t.words FROM fx_books b JOIN fx_totals t ON t.book_id = b.book_id""",
  "fx_books", "fx_totals")
q("book_documents", f"""SELECT b.book_id, b.title, b.author, t.chapters AS total_chapters, t.words AS total_words, coalesce(p.part, 1) AS part,
  coalesce(p.parts, 1) AS parts, coalesce(p.chapters, '') AS chapters
FROM fx_books b JOIN fx_totals t ON t.book_id = b.book_id LEFT JOIN (
  SELECT *, count(*) OVER (PARTITION BY book_id) AS parts FROM (
    SELECT book_id, CAST((chapter_number - 1) // 8 + 1 AS BIGINT) AS part, string_agg(concat_ws('|', CAST(chapter_number AS VARCHAR),
      CAST({wc('content')} AS VARCHAR), title), {NL} ORDER BY chapter_number) AS chapters
    FROM fx_chapters GROUP BY 1, 2)) p ON p.book_id = b.book_id""", "fx_books", "fx_totals", "fx_chapters")
q("generation_summary", """SELECT total_books, total_chapters, total_flashcards,
  coalesce(CAST(total_flashcards AS DOUBLE) / nullif(CAST(total_books AS DOUBLE), 0), 0.0) AS average_flashcards_per_book
FROM (SELECT count(*) AS total_books, CAST(coalesce(sum(t.chapters), 0) AS BIGINT) AS total_chapters,
        CAST(coalesce(sum(coalesce(c.n, 0)), 0) AS BIGINT) AS total_flashcards
      FROM fx_totals t LEFT JOIN (SELECT book_id, count(*) AS n FROM vcards GROUP BY 1) c ON c.book_id = t.book_id)""",
  "fx_totals", "vcards")
q("cards_per_book", """SELECT b.book_id, CAST(coalesce(c.n, 0) AS BIGINT) AS flashcards FROM fx_books b
LEFT JOIN (SELECT book_id, count(*) AS n FROM vcards GROUP BY 1) c ON c.book_id = b.book_id""", "fx_books", "vcards")
q("books_without_cards", "SELECT book_id, title FROM fx_books WHERE book_id NOT IN (SELECT book_id FROM vcards)",
  "fx_books", "vcards")
q("avg_words_per_chapter", f"""SELECT chapters, words, coalesce(CAST(words AS DOUBLE) / nullif(CAST(chapters AS DOUBLE), 0), 0.0) AS avg_words
FROM (SELECT count(*) AS chapters, CAST(sum({wc('content')}) AS BIGINT) AS words FROM fx_chapters)""", "fx_chapters")
q("summary_rollup", f"""SELECT book_id, CAST(grouping(book_id) AS INTEGER) AS is_total, count(*) AS chapters,
  CAST(sum({wc('content')}) AS BIGINT) AS words FROM fx_chapters GROUP BY ROLLUP (book_id)""", "fx_chapters")
q("chapter_preview", f"""SELECT book_id, CAST(rk AS INTEGER) AS rank, chapter_number, title, CAST({wc('content')} AS INTEGER) AS words,
  greatest(n - 3, 0) AS more
FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY chapter_number) AS rk,
             count(*) OVER (PARTITION BY book_id) AS n FROM fx_chapters) WHERE rk <= 3""", "fx_chapters")
q("latest_by_title", """SELECT title, arg_max(book_id, discovery_no) AS book_id, count(*) AS books_with_title
FROM fx_books GROUP BY title""", "fx_books")
q("latest_across_runs", """SELECT title, book_id, discovery_no FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY discovery_no DESC, book_id DESC) AS rk FROM fx_books) WHERE rk = 1""", "fx_books")
q("name_collisions", f"""SELECT file_stem, count(*) AS books, min(book_id) AS first_book, max(book_id) AS last_book
FROM (SELECT book_id, {safe_name('title')} AS file_stem FROM fx_books) GROUP BY file_stem HAVING count(*) > 1""", "fx_books")

_tags_json = (f"CASE WHEN len(tags) = 0 THEN '[]' ELSE '[' || {NL} || array_to_string(list_transform(tags, "
              f"lambda t: '        ' || {_json_str('t')}), ',' || {NL}) || {NL} || '      ]' END")
q("export_json", f"""SELECT book_id, file_stem, 0 AS part, CAST(NULL AS BIGINT) AS reply_id, CAST(NULL AS INTEGER) AS card_no,
  '{{' || {NL} || '  "metadata": {{' || {NL}
  || '    "book_title": ' || {_json_str('book_title')} || ',' || {NL}
  || '    "book_author": ' || {_json_str('book_author')} || ',' || {NL}
  || '    "generated_at": "1970-01-01T00:00:00",' || {NL}
  || '    "total_flashcards": ' || CAST(n AS VARCHAR) || ',' || {NL}
  || '    "total_chapters": ' || CAST(coalesce(ch, 0) AS VARCHAR) || {NL}
  || '  }},' || {NL} || '  "flashcards": [' AS block
FROM (SELECT e.book_id, e.file_stem, e.book_title, e.book_author, count(*) AS n FROM export_cards e GROUP BY 1, 2, 3, 4) h
LEFT JOIN (SELECT book_id AS cb, count(*) AS ch FROM fx_chapters GROUP BY 1) c ON c.cb = h.book_id
UNION ALL
SELECT book_id, file_stem, 1, reply_id, card_no,
  '    {{' || {NL}
  || '      "front": ' || {_json_str('front')} || ',' || {NL}
  || '      "back": ' || {_json_str('back')} || ',' || {NL}
  || '      "card_type": ' || {_json_str('card_type')} || ',' || {NL}
  || '      "source": ' || {_json_str('source')} || ',' || {NL}
  || '      "difficulty": ' || coalesce(CAST(difficulty AS VARCHAR), 'null') || ',' || {NL}
  || '      "tags": ' || {_tags_json} || {NL}
  || '    }}' || CASE WHEN row_number() OVER (PARTITION BY book_id ORDER BY reply_id DESC, card_no DESC) = 1 THEN '' ELSE ',' END
FROM export_cards
UNION ALL
SELECT DISTINCT book_id, file_stem, 2, CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), '  ]' || {NL} || '}}' FROM export_cards""",
  "export_cards", "fx_chapters")


def _csv(x: str) -> str:
    v = f"coalesce({x}, '')"
    return (f"CASE WHEN regexp_matches({v}, '[,\"' || chr(13) || chr(10) || ']') "
            f"THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END")


q("export_csv_rows", f"""SELECT DISTINCT book_id, file_stem, 0 AS part, CAST(NULL AS BIGINT) AS reply_id, CAST(NULL AS INTEGER) AS card_no,
  'front,back,card_type,source,difficulty,tags' AS line FROM export_cards
UNION ALL
SELECT book_id, file_stem, 1, reply_id, card_no,
  {_csv('front')} || ',' || {_csv('back')} || ',' || {_csv('card_type')} || ',' || {_csv('source')} || ','
  || {_csv('CAST(difficulty AS VARCHAR)')} || ',' || {_csv("array_to_string(tags, ',')")}
FROM export_cards""", "export_cards")
q("export_deck_rows", f"""SELECT book_id, file_stem, 1 AS part, reply_id, card_no,
  front || chr(9) || back || chr(9) || array_to_string(list_concat(tags, ['Source:' || source,
    CASE WHEN difficulty IS NULL OR difficulty = 0 THEN 'Difficulty:Unknown' ELSE 'Difficulty:' || CAST(difficulty AS VARCHAR) END,
    'Type:' || card_type, 'Book:' || book_title]), ' ') AS line
FROM export_cards""", "export_cards")
q("corpus_cards", f"""SELECT p.book_id, CAST(coalesce(r.chapters, 0) AS BIGINT) AS chapters, CAST(coalesce(r.words, 0) AS BIGINT) AS words,
  CAST(coalesce(s.n, 0) AS BIGINT) AS suitable_chapters, CAST(coalesce(x.n, 0) AS BIGINT) AS flashcards
FROM fx_page_counts p
LEFT JOIN (SELECT book_id, count(*) AS chapters, sum({wc('content')}) AS words FROM resolved GROUP BY 1) r ON r.book_id = p.book_id
LEFT JOIN (SELECT book_id, count(*) AS n FROM resolved_suitable GROUP BY 1) s ON s.book_id = p.book_id
LEFT JOIN (SELECT book_id, count(*) AS n FROM corpus_ex GROUP BY 1) x ON x.book_id = p.book_id""",
  "fx_page_counts", "resolved", "resolved_suitable", "corpus_ex")


def _order(deps: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for d in deps:
        visit(d)
    return seen


def build(name: str) -> str:
    sql, deps = FINAL[name]
    names = _order(deps)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in names) + "\n" + sql


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in FINAL}
