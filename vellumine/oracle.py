r"""The SQL that says the same as the queries outside the llm subpackage, for DuckDB.

White space is matched by an explicit class, since its engine's \s is ASCII; lookarounds, which it lacks, are avoided.
"""

from __future__ import annotations

_P1_NODES = """
WITH p AS (SELECT rec_id, unnest(pdf_info) AS page, generate_subscripts(pdf_info, 1) - 1 AS page_no FROM middle_json),
b AS (SELECT rec_id, page_no, unnest(page.preproc_blocks) AS b, generate_subscripts(page.preproc_blocks, 1) - 1 AS block_no FROM p),
s AS (SELECT rec_id, page_no, block_no, unnest(b.blocks) AS s, generate_subscripts(b.blocks, 1) - 1 AS sub_no FROM b),
l AS (
  SELECT rec_id, page_no, block_no, -1 AS sub_no, unnest(b.lines) AS l, generate_subscripts(b.lines, 1) - 1 AS line_no FROM b
  UNION ALL SELECT rec_id, page_no, block_no, sub_no, unnest(s.lines), generate_subscripts(s.lines, 1) - 1 FROM s),
x AS (SELECT rec_id, page_no, block_no, sub_no, line_no, unnest(l.spans) AS x, generate_subscripts(l.spans, 1) - 1 AS span_no FROM l)
"""

_PLACES = "CAST(page_no AS INT) AS page_no, CAST({0} AS INT) AS block_no, CAST({1} AS INT) AS sub_no, CAST({2} AS INT) AS line_no, CAST({3} AS INT) AS span_no"

_PAGE = "'pdf_info[' || page_no || ']'"
_BLOCK = _PAGE + " || '.preproc_blocks[' || block_no || ']'"
_SUB = _BLOCK + " || CASE WHEN sub_no >= 0 THEN '.blocks[' || sub_no || ']' ELSE '' END"
_LINE = _SUB + " || '.lines[' || line_no || ']'"

P1 = {
    "p1_found": _P1_NODES
    + "SELECT DISTINCT * FROM ("
    + f"SELECT rec_id, {_PLACES.format(-1, -1, -1, -1)} FROM p WHERE page IS NOT NULL"
    + f" UNION ALL SELECT rec_id, {_PLACES.format('block_no', -1, -1, -1)} FROM b WHERE b IS NOT NULL"
    + f" UNION ALL SELECT rec_id, {_PLACES.format('block_no', 'sub_no', -1, -1)} FROM s WHERE s IS NOT NULL"
    + f" UNION ALL SELECT rec_id, {_PLACES.format('block_no', 'sub_no', 'line_no', -1)} FROM l WHERE l IS NOT NULL"
    + f" UNION ALL SELECT rec_id, {_PLACES.format('block_no', 'sub_no', 'line_no', 'span_no')} FROM x WHERE x IS NOT NULL)",
    "p1_spans": _P1_NODES
    + f"SELECT DISTINCT rec_id, {_PLACES.format('block_no', 'sub_no', 'line_no', 'span_no')}, {_LINE} || '.spans[' || span_no || ']' AS node, {_LINE} AS parent,"
    + " x.bbox[1] AS x0, x.bbox[2] AS y0, x.bbox[3] AS x1, x.bbox[4] AS y1, x.score AS score, x.content AS content, x.type AS type, x.image_path AS image_path FROM x WHERE x IS NOT NULL",
    "p1_lines": _P1_NODES
    + f"SELECT DISTINCT rec_id, {_PLACES.format('block_no', 'sub_no', 'line_no', -1)}, {_LINE} AS node, {_SUB} AS parent, l.bbox[1] AS x0, l.bbox[2] AS y0, l.bbox[3] AS x1, l.bbox[4] AS y1 FROM l WHERE l IS NOT NULL",
    "p1_blocks": _P1_NODES
    + f"SELECT DISTINCT rec_id, {_PLACES.format('block_no', -1, -1, -1)}, {_BLOCK} AS node, {_PAGE} AS parent, b.bbox[1] AS x0, b.bbox[2] AS y0, b.bbox[3] AS x1, b.bbox[4] AS y1, b.type AS type FROM b WHERE b IS NOT NULL"
    + f" UNION SELECT DISTINCT rec_id, {_PLACES.format('block_no', 'sub_no', -1, -1)}, {_SUB}, {_BLOCK}, s.bbox[1], s.bbox[2], s.bbox[3], s.bbox[4], s.type FROM s WHERE s IS NOT NULL",
    "p1_pages": _P1_NODES + f"SELECT DISTINCT rec_id, {_PLACES.format(-1, -1, -1, -1)}, {_PAGE} AS node, CAST(NULL AS VARCHAR) AS parent FROM p WHERE page IS NOT NULL",
}

WS = r"[\s\x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NWS = WS.replace("[", "[^", 1)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


_ROMAN = ", ".join(f"'{r}'" for r in "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX XXI XXII XXIII XXIV XXV XXVI XXVII XXVIII XXIX XXX XL L".split())

#: The items of content_list with their outline, stated set by set.
OUTLINE = rf"""
WITH items AS (
  SELECT DISTINCT paper_id AS doc_id, idx, type, text, text_level, page_idx, img_path, img_caption, table_caption, table_body,
    {strip("coalesce(text, '')")} AS stripped,
    coalesce(text_level = 1 AND contains(type, 'text'), false) AS is_header
  FROM content_list WHERE paper_id IS NOT NULL AND idx IS NOT NULL),
prefixed AS (SELECT *, regexp_extract(stripped, '^({NWS}+){WS}+', 1) AS prefix FROM items),
formed AS (
  SELECT *, CASE WHEN upper(regexp_replace(prefix, '[.)]+$', '')) IN ({_ROMAN}) THEN 'roman'
    WHEN regexp_matches(regexp_replace(prefix, '[.)]+$', ''), '^[0-9]+$') THEN 'arabic'
    WHEN regexp_matches(regexp_replace(prefix, '[.)]+$', ''), '^[A-Za-z]$') THEN 'alpha'
    WHEN regexp_matches(regexp_replace(prefix, '[.)]+$', ''), '^[0-9]+(\.[0-9]+)+$') THEN 'numeric' ELSE 'none' END AS format
  FROM prefixed),
intro AS (SELECT doc_id, min(idx) AS intro_idx FROM formed WHERE is_header AND regexp_matches(stripped, '(?i)introduction') GROUP BY 1),
ends AS (SELECT doc_id, coalesce(min(idx) FILTER (WHERE is_header AND regexp_matches(stripped, '(?i)references')), max(idx) + 1) AS body_end FROM formed GROUP BY 1),
docs AS (
  SELECT e.doc_id, i.intro_idx, f.format AS intro_format, e.body_end FROM ends e LEFT JOIN intro i USING (doc_id)
  LEFT JOIN formed f ON f.doc_id = i.doc_id AND f.idx = i.intro_idx),
nodes AS (
  SELECT f.doc_id, f.idx, f.prefix, f.stripped AS title, f.format, d.body_end, f.format = d.intro_format AS is_section
  FROM formed f JOIN docs d USING (doc_id) WHERE f.is_header AND f.idx >= d.intro_idx AND f.idx < d.body_end),
tops AS (SELECT doc_id, idx, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS sec_no, lead(idx) OVER (PARTITION BY doc_id ORDER BY idx) AS next_top, title AS section, prefix AS sec_prefix FROM nodes WHERE is_section),
placed AS (
  SELECT n.*, t.sec_no, t.idx AS top_idx, t.next_top, t.section, t.sec_prefix FROM nodes n JOIN tops t
  ON n.doc_id = t.doc_id AND n.idx >= t.idx AND (t.next_top IS NULL OR n.idx < t.next_top)),
secs AS (
  SELECT *, CASE WHEN is_section THEN 0 ELSE row_number() OVER (PARTITION BY doc_id, sec_no, is_section ORDER BY idx) END AS sub_no,
    lead(idx) OVER (PARTITION BY doc_id ORDER BY idx) AS next_node FROM placed),
sections AS (
  SELECT *, CASE WHEN sub_no > 0 THEN sec_no || '.' || sub_no ELSE CAST(sec_no AS VARCHAR) END AS sec_id,
    CASE WHEN is_section THEN coalesce(next_top, body_end) - 1 ELSE coalesce(next_node, body_end) - 1 END AS region_end,
    coalesce(next_node, body_end) - 1 AS own_end FROM secs),
stops AS (
  SELECT s.doc_id, s.idx AS node_idx, min(f.idx) AS stop FROM sections s JOIN formed f
  ON f.doc_id = s.doc_id AND f.idx > s.idx AND f.idx <= s.own_end AND f.text_level = 1 GROUP BY 1, 2),
own AS (
  SELECT f.*, s.sec_id, s.sec_no, s.sub_no, s.idx AS node_idx FROM sections s JOIN formed f ON f.doc_id = s.doc_id AND f.idx > s.idx AND f.idx <= s.own_end
  LEFT JOIN stops t ON t.doc_id = s.doc_id AND t.node_idx = s.idx WHERE t.stop IS NULL OR f.idx < t.stop),
paras AS (
  SELECT doc_id, sec_id, sec_no, sub_no, node_idx, idx, stripped AS text, row_number() OVER (PARTITION BY doc_id, node_idx ORDER BY idx) AS para_no
  FROM own WHERE starts_with(type, 'text') AND stripped <> ''),
named AS (SELECT *, sec_id || '_p' || para_no AS para_id FROM paras),
eq_rows AS (
  SELECT o.doc_id, o.sec_id, o.node_idx, o.idx, o.stripped, (SELECT max(p.idx) FROM named p WHERE p.doc_id = o.doc_id AND p.idx < o.idx) AS para_idx
  FROM own o WHERE starts_with(o.type, 'equation')),
eqs AS (
  SELECT e.doc_id, p.para_id || '_eq' || (row_number() OVER (PARTITION BY e.doc_id, e.node_idx ORDER BY e.idx) - 1) AS eq_id, p.para_id, e.idx, e.stripped AS raw_latex
  FROM eq_rows e LEFT JOIN named p ON p.doc_id = e.doc_id AND p.idx = e.para_idx WHERE e.stripped <> ''),
spoken AS (
  SELECT o.doc_id, o.sec_id, o.node_idx, o.idx, coalesce(starts_with(o.type, 'text'), false) AS is_text, o.stripped FROM own o),
compat AS (
  SELECT s.doc_id, s.sec_id, s.idx, (SELECT arg_max(t.stripped, t.idx) FROM spoken t WHERE t.is_text AND t.doc_id = s.doc_id AND t.node_idx = s.node_idx AND t.idx <= s.idx) AS text
  FROM spoken s WHERE NOT s.is_text OR s.stripped <> '')
"""


def _captioned(kind: str, captions: str, extra: str, name: str, bounded: bool) -> str:
    short = name[:3]
    return (
        OUTLINE
        + f"SELECT f.doc_id, '{name}' || row_number() OVER (PARTITION BY f.doc_id ORDER BY f.idx) AS {short}_id, row_number() OVER (PARTITION BY f.doc_id ORDER BY f.idx) AS {short}_num, f.idx,"
        + f" CASE WHEN len(f.{captions}) > 0 THEN f.{captions}[1] ELSE '' END AS caption, f.{extra} FROM formed f JOIN docs d USING (doc_id)"
        + f" WHERE f.type = '{kind}' AND d.intro_idx IS NOT NULL" + (" AND f.idx < d.body_end" if bounded else "")
    )


_BARE = r"regexp_replace(x, '\\[a-zA-Z]+|[{}]', '', 'g')"
_CLEANED = f"replace(regexp_replace({strip(_BARE)}, '{WS}+', ' ', 'g'), '__', '_')"
_FORMULA = (
    "SELECT doc_id, para_id, unnest(c) AS f, generate_subscripts(c, 1) - 1 AS n FROM (SELECT doc_id, para_id, list_filter("
    + rf"list_transform(regexp_extract_all(text, '\$([^$]+)\$', 1), lambda x: {{'cleaned': {_CLEANED}, 'raw': '$' || x || '$'}}), lambda y: y.cleaned <> '') AS c FROM named)"
)

_REFS = "WITH refs AS (SELECT DISTINCT ref_key, raw_text FROM ref_records WHERE raw_text IS NOT NULL)"
_NO_FORMULA = r"regexp_replace(regexp_replace(raw_text, '\\\$.*?\\\$', '', 'g'), '" + WS + "+', ' ', 'g')"
_AUTHORS = r"""string_split_regex(regexp_extract(raw_text, '^([^\n\r]*?),\s*"', 1), ',\s+and\s+| and |, ')"""



_EM = "regexp_extract(raw_text, '<em>(.*?)</em>', 1)"
_RAW = "coalesce(raw_text, '')"


def _fields(text: str, authors: str = _AUTHORS) -> str:
    return (
        f"array_to_string({authors.replace('raw_text', text)}, '; ') AS authors, nullif(regexp_extract({text}, '(?i)vol\\.\\s*(\\d+)', 1), '') AS volume, nullif(regexp_extract({text}, '(?i)no\\.\\s*(\\d+)', 1), '') AS issue_no,"
        f" coalesce(nullif(regexp_extract({text}, '(?i)pp\\.\\s*(\\d+-\\d+)', 1), ''), nullif(regexp_extract({text}, '(?i)pp\\.\\s*(\\d+)', 1), '')) AS pages, regexp_extract({text}, '\\b(19|20)\\d{{2}}\\b') AS publication_year"
    )


STRUCTURE = {
    "headers": OUTLINE + "SELECT doc_id, idx, stripped AS title, prefix, format FROM formed WHERE is_header",
    "format_histogram": OUTLINE + "SELECT format, count(*) AS n FROM formed WHERE is_header GROUP BY 1",
    "level_of_format": OUTLINE + "SELECT doc_id, idx, CASE WHEN format IN ('alpha', 'numeric') THEN 'subsection' ELSE 'section' END AS level FROM formed WHERE is_header",
    "document_bounds": OUTLINE + "SELECT doc_id, intro_idx, intro_format, body_end FROM docs",
    "docs_without_intro": OUTLINE + "SELECT doc_id FROM docs WHERE intro_idx IS NULL",
    "sections": OUTLINE + "SELECT doc_id, sec_id, sec_no, sub_no, idx, prefix, title, format, CASE WHEN is_section THEN 'section' ELSE 'subsection' END AS level, idx AS region_start, region_end FROM sections",
    "depth_labels": OUTLINE + "SELECT CAST(sub_no > 0 AS INT) AS depth, CASE WHEN sub_no > 0 THEN 'subsection' ELSE 'section' END AS label, count(*) AS n FROM sections GROUP BY 1, 2",
    "paragraphs": OUTLINE + "SELECT doc_id, para_id, sec_id, para_no, idx, text FROM named",
    "paragraphs_ordered": OUTLINE + "SELECT doc_id, para_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec_no, sub_no, para_no) AS rank FROM named",
    "para_per_section": OUTLINE + "SELECT doc_id, sec_id, count(*) AS n_paragraphs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM named GROUP BY 1, 2",
    "equations": OUTLINE + "SELECT doc_id, eq_id, para_id, idx, raw_latex FROM eqs",
    "equations_ordered": OUTLINE + "SELECT doc_id, eq_id, idx, row_number() OVER (PARTITION BY doc_id ORDER BY eq_id, idx) AS rank FROM eqs WHERE eq_id IS NOT NULL",
    "document_errors": OUTLINE
    + "SELECT doc_id, CASE WHEN intro_idx IS NULL THEN 'NO_INTRODUCTION' WHEN doc_id IN (SELECT doc_id FROM eq_rows WHERE para_idx IS NULL) THEN 'EQ_BEFORE_PARA' END AS error_code,"
    + " CASE WHEN intro_idx IS NULL THEN 'NO_INTRODUCTION' WHEN doc_id IN (SELECT doc_id FROM compat WHERE text IS NULL) THEN 'NONTEXT_BEFORE_TEXT' END AS tree_error_code FROM docs",
    "figures": _captioned("image", "img_caption", "img_path", "fig", True),
    "tables": _captioned("table", "table_caption", "table_body", "tab", True),
    "figures_unbounded": _captioned("image", "img_caption", "img_path", "fig", False),
    "tables_unbounded": _captioned("table", "table_caption", "table_body", "table", False),
    "formulae": OUTLINE + f"SELECT doc_id, para_id, CAST(n AS INT) AS n, f.cleaned AS cleaned, f.raw AS raw FROM ({_FORMULA})",
    "citations": OUTLINE + r"SELECT doc_id, number, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\[(\d+)\]', 1)) AS number FROM named) GROUP BY 1, 2",
    "region_content_compat": OUTLINE + "SELECT doc_id, sec_id, idx, text FROM compat",
    "region_content_text": OUTLINE + "SELECT doc_id, sec_id, idx, stripped AS text FROM spoken WHERE is_text AND stripped <> ''",
    "body_text_rows": OUTLINE
    + "SELECT k.doc_id, k.section, k.subsection, row_number() OVER (PARTITION BY c.doc_id, c.sec_id ORDER BY c.idx) - 1 AS n, c.text FROM compat c JOIN ("
    + "SELECT doc_id, sec_id, section, subsection FROM (SELECT doc_id, sec_id, sec_no, sub_no, section, CASE WHEN is_section THEN NULL ELSE sec_prefix || ' - ' || title END AS subsection,"
    + " max(sec_no) OVER (PARTITION BY doc_id, section) AS last_sec,"
    + " max(sub_no) OVER (PARTITION BY doc_id, sec_no, CASE WHEN is_section THEN NULL ELSE title END) AS last_sub FROM sections) WHERE sec_no = last_sec AND sub_no = last_sub) k USING (doc_id, sec_id)",
    "reference_details": _REFS
    + f" SELECT ref_key, array_to_string({_AUTHORS}, '; ') AS authors, nullif(regexp_extract(raw_text, '\"([^\"]+)\"', 1), '') AS title, regexp_extract(raw_text, '<em>(.*?)</em>', 1) AS source,"
    + r" regexp_extract(raw_text, '\b(19|20)\d{2}\b') AS year, nullif(regexp_extract(raw_text, '(?i)vol\.\s*(\d+)', 1), '') AS volume, nullif(regexp_extract(raw_text, '(?i)no\.\s*(\d+)', 1), '') AS issue,"
    + r" coalesce(nullif(regexp_extract(raw_text, '(?i)pp\.\s*(\d+-\d+)', 1), ''), nullif(regexp_extract(raw_text, '(?i)pp\.\s*(\d+)', 1), '')) AS pages FROM refs",
    "reference_authors": _REFS + f" SELECT ref_key, CAST(generate_subscripts(a, 1) - 1 AS INT) AS n, unnest(a) AS author FROM (SELECT ref_key, {_AUTHORS} AS a FROM refs)",
    "reference_text": _REFS + f" SELECT ref_key, {strip(_NO_FORMULA)} AS clean FROM refs",
}



def _flat(x: str) -> str:
    """Blanks collapsed and off both ends; an empty text is null."""
    return f"nullif({strip(f'regexp_replace({x}, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '')"


_LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY ingested_at DESC NULLS LAST) AS nth FROM papers WHERE paper_id IS NOT NULL) WHERE nth = 1)"


def _names(of: str, by: str) -> str:
    return f"array_to_string(list_filter(list_transform({of}, lambda a: {_flat('a')}), lambda b: b IS NOT NULL), '{by}')"


_HEADER = (
    "SELECT paper_id AS doc_id, nullif(" + _names("string_split(authors, ', ')", ", ") + f", '') AS authors, {strip('title')} AS title, {strip('doi')} AS doi,"
    f" {strip('publication_date')} AS \"displayPublicationDate\", {strip('publisher')} AS publisher,"
    " CASE WHEN conf_loc <> '' THEN 'Conferences' ELSE 'Journals' END AS \"contentTypeDisplay\", CASE WHEN conf_loc <> '' THEN 'IEEE Conference' ELSE 'IEEE Journal' END AS \"subType\","
    f" {strip('publication_title')} AS \"publicationTitle\", {strip('conf_loc')} AS \"confLoc\", volume, start_page AS \"startPage\", end_page AS \"endPage\", {strip('publication_date')} AS \"publicationDate\","
    f" CASE WHEN publication_date IS NOT NULL THEN left(coalesce(nullif(publication_year, ''), publication_date), 4) END AS \"publicationYear\", {strip('abstract_text')} AS abstract FROM latest"
)

_BLOCKS = """
pages AS (SELECT rec_id, unnest(pdf_info) AS page, generate_subscripts(pdf_info, 1) - 1 AS page_no FROM (SELECT DISTINCT rec_id, pdf_info FROM middle_json)),
every AS (SELECT rec_id, page_no, unnest(page.preproc_blocks) AS b, generate_subscripts(page.preproc_blocks, 1) - 1 AS block_no FROM pages),
subs AS (SELECT rec_id, page_no, block_no, unnest(b.blocks) AS s, generate_subscripts(b.blocks, 1) - 1 AS sub_no FROM every WHERE b.type = 'image'),
"""


def _whole(b: str) -> str:
    return f"len({b}.bbox) >= 4 AND {b}.bbox[1] IS NOT NULL AND {b}.bbox[2] IS NOT NULL AND {b}.bbox[3] IS NOT NULL AND {b}.bbox[4] IS NOT NULL"


def _said(b: str) -> str:
    return f"coalesce(array_to_string(flatten(list_transform(list_filter({b}.lines, lambda ln: ln IS NOT NULL AND ln.spans IS NOT NULL), lambda ln: list_transform(ln.spans, lambda sp: sp.content))), ' '), '')"


def _far(wx: int) -> str:
    dx = "((c.bbox[1] + c.bbox[3]) / 2 - (t.bbox[1] + t.bbox[3]) / 2)"
    dy = "((c.bbox[2] + c.bbox[4]) / 2 - (t.bbox[2] + t.bbox[4]) / 2)"
    return f"sqrt({wx} * {dx} * {dx} + {dy} * {dy})"


def _image_captions(begins: str) -> str:
    return (
        "WITH" + _BLOCKS
        + f"raw AS (SELECT rec_id, page_no, 0 AS kind, block_no, sub_no, s.bbox AS bbox, {_said('s')} AS caption FROM subs WHERE s.type = 'image_caption' AND {_whole('s')}"
        + f" UNION ALL SELECT rec_id, page_no, 1, block_no, 0, b.bbox, {_said('b')} FROM every WHERE b.type = 'image_caption' AND {_whole('b')}),"
        + f" c AS (SELECT *, row_number() OVER (PARTITION BY rec_id, page_no ORDER BY kind, block_no, sub_no) - 1 AS caption_no FROM raw WHERE starts_with(caption, '{begins}')),"
        + f" t AS (SELECT rec_id, page_no, block_no, sub_no, s.bbox AS bbox, s.lines[1].spans[1].image_path AS image_path FROM subs WHERE s.type = 'image_body' AND {_whole('s')})"
        + " SELECT DISTINCT rec_id, page_no, CAST(caption_no AS INT) AS caption_no, caption, image_path FROM (SELECT c.rec_id, c.page_no, c.caption_no, c.caption, t.image_path,"
        + f" row_number() OVER (PARTITION BY c.rec_id, c.page_no, c.caption_no ORDER BY {_far(5)}, t.block_no, t.sub_no) AS nth FROM c JOIN t ON c.rec_id = t.rec_id AND c.page_no = t.page_no AND t.bbox[1] < c.bbox[1]) WHERE nth = 1"
    )


_LINES = (
    "WITH" + _BLOCKS
    + f"blocks AS (SELECT rec_id, page_no, block_no, b.bbox[1] AS x0, b.bbox[2] AS y0, b.bbox[3] AS x1, b.bbox[4] AS y1, b.lines AS lines FROM every WHERE {_whole('b')}),"
    + " l AS (SELECT rec_id, page_no, block_no, unnest(lines) AS l, generate_subscripts(lines, 1) - 1 AS line_no FROM blocks),"
    + f" lines AS (SELECT rec_id, page_no, block_no, line_no, l.bbox[1] AS x0, l.bbox[2] AS y0, l.bbox[3] AS x1, l.bbox[4] AS y1 FROM l WHERE l IS NOT NULL AND {_whole('l')}),"
    + " moved AS (SELECT rec_id, page_no, block_no * 1000 + line_no AS pdf_line, x0, x1, y0 + d AS y0, y1 + d AS y1 FROM (SELECT *, CASE WHEN line_no % 3 = 2 THEN (y1 - y0) * CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS d FROM lines)),"
)


def _iou(a: str, b: str) -> str:
    common = f"greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"
    return f"(CASE WHEN {common} = 0 THEN 0 ELSE {common} / (({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0) + ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0) - {common}) END)"


_BEST = (
    _LINES
    + f" rated AS (SELECT m.rec_id, m.page_no, m.pdf_line, b.block_no, {_iou('m', 'b')} AS score FROM moved m JOIN blocks b USING (rec_id, page_no)),"
    + " best AS (SELECT rec_id, page_no, pdf_line, block_no, score FROM (SELECT *, row_number() OVER (PARTITION BY rec_id, page_no, pdf_line ORDER BY score DESC, block_no) AS nth FROM rated WHERE score >= CAST(0.5 AS DOUBLE)) WHERE nth = 1)"
)

_PUT = rf"""
WITH put AS (
  SELECT DISTINCT paper_id AS doc_id, idx, type, text_level, page_idx, img_path, img_caption, table_caption, table_body,
    CASE WHEN idx % 10 = 5 AND type = 'text' AND coalesce(text_level, 0) = 0 THEN '© 2011 IEEE. Manuscript received, no. ' || idx ELSE text END AS text FROM content_list),
marked AS (
  SELECT *, coalesce(regexp_matches(text, '(?i)Manuscript received|ieee copyright|digital object identifier|This material is based on research sponsored|the associate editor|Authorized licensed use')
    OR regexp_matches(text, 'ISBN\s+\d{{1,5}}-\d{{1,7}}-\d{{1,7}}-\d{{1,7}}-\d{{1}}') OR regexp_matches(text, '(?i)©\s*\d{{4}}\s*IEEE') OR regexp_matches(text, '(?i)\b\d{{4}}\b\s*IEEE'), false) AS bad FROM put)
"""
_ISOLATED = (
    _PUT
    + f", raw AS (SELECT doc_id, idx, bad, coalesce(text, '') AS raw, CASE WHEN contains(text, chr(10)) THEN regexp_replace(replace(text, chr(10), ''), '{WS}+', ' ', 'g') ELSE coalesce(text, '') END AS flat"
    + " FROM marked WHERE type = 'text' AND coalesce(text_level, 0) = 0),"
    + " seen AS (SELECT *, lag(bad) OVER w AS bad1, lag(flat, 2) OVER w AS flat2, lead(bad) OVER w AS next_bad, lead(raw, 2) OVER w AS raw2 FROM raw WINDOW w AS (PARTITION BY doc_id ORDER BY idx))"
    + " SELECT doc_id, idx, CASE WHEN next_bad AND NOT ends_with(flat, '.') AND raw2 IS NOT NULL THEN flat || ' ' || raw2 ELSE flat END AS text FROM seen"
    + " WHERE NOT bad AND NOT coalesce(bad1 AND flat2 IS NOT NULL AND NOT ends_with(flat2, '.'), false)"
)

_TEXTS = "WITH t AS (SELECT DISTINCT item_id, type, text FROM content_list WHERE text IS NOT NULL)"
_ANY_COMMAND = r"\\[a-zA-Z]+"
_SPELT = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\frac\s*\{(.*?)\}\s*\{(.*?)\}', '(\1) / (\2)', 'g'), '\\sqrt\s*\{(.*?)\}', 'sqrt(\1)', 'g'),"
    r" '\\text\{([^}]*)\}', '\1', 'g'), '\^\{(.*?)\}', '^\1', 'g'), '_\{(.*?)\}', '_\1', 'g')"
)
_BRACKETED = f"replace(replace({_SPELT}, '{{', '('), '}}', ')')"
_FINE = "fine AS (SELECT doc_id FROM docs WHERE intro_idx IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM eq_rows WHERE para_idx IS NULL))"
_WHOLE = (
    OUTLINE.rstrip() + ", " + _FINE + ", " + _LATEST
    + ", refs AS (SELECT paper_id AS doc_id, count(*) AS n FROM (SELECT DISTINCT * FROM ref_records) GROUP BY 1),"
    + " n_paras AS (SELECT doc_id, count(*) AS n FROM named GROUP BY 1),"
    + f" whole AS (SELECT l.paper_id AS doc_id, l.file_name, CASE WHEN f.doc_id IS NULL THEN 'failed' WHEN r.doc_id IS NOT NULL THEN 'ok' ELSE 'partial' END AS status,"
    + f" CASE WHEN r.doc_id IS NOT NULL THEN {strip('l.title')} END AS title, CASE WHEN r.doc_id IS NOT NULL THEN {strip('l.doi')} END AS doi, coalesce(r.n, 0) AS n_refs,"
    + " CASE WHEN f.doc_id IS NULL THEN 0 ELSE coalesce(p.n, 0) END AS n_paragraphs, intro_idx, d.doc_id IS NOT NULL AS has_items FROM latest l"
    + " LEFT JOIN fine f ON f.doc_id = l.paper_id LEFT JOIN refs r ON r.doc_id = l.paper_id LEFT JOIN n_paras p ON p.doc_id = l.paper_id LEFT JOIN docs d ON d.doc_id = l.paper_id),"
    + " report AS (SELECT doc_id, file_name, CASE WHEN status = 'failed' THEN 'parse' ELSE 'metadata' END AS stage,"
    + " CASE WHEN status = 'partial' THEN 'NO_METADATA' WHEN NOT has_items THEN 'NO_ITEMS' WHEN intro_idx IS NULL THEN 'NO_INTRODUCTION' ELSE 'EQ_BEFORE_PARA' END AS error_code FROM whole WHERE status <> 'ok')"
)


def _count(of: str, where: str = "") -> str:
    return f"(SELECT count(*) FROM {of} x WHERE x.doc_id = fine.doc_id{where})"


OTHER = {
    "tei_header": "WITH " + _LATEST + " " + _HEADER,
    "content_types": "WITH " + _LATEST + f', h AS ({_HEADER}) SELECT "contentTypeDisplay", "subType", count(*) AS n FROM h GROUP BY 1, 2',
    "tei_references": "WITH r AS (SELECT DISTINCT * FROM ref_records) SELECT paper_id AS doc_id, 'ref' || row_number() OVER (PARTITION BY paper_id ORDER BY ref_key) AS ref_id,"
    + f" row_number() OVER (PARTITION BY paper_id ORDER BY ref_key) AS n, nullif(title, '') AS title, nullif(" + _names("authors", "; ") + ", '') AS authors, nullif(source, '') AS source,"
    + " volume, issue_no, CASE WHEN split_part(pages, '-', 1) <> '' AND split_part(pages, '-', 2) <> '' THEN split_part(pages, '-', 1) || '-' || split_part(pages, '-', 2) END AS pages,"
    + " left(publication_year, 4) AS publication_year, nullif(raw_text, '') AS raw_text FROM r",
    "rest_references": "WITH r AS (SELECT DISTINCT * FROM ref_records) SELECT paper_id AS doc_id, row_number() OVER (PARTITION BY paper_id ORDER BY ref_key) - 1 AS n, ref_id, title,"
    + f" regexp_extract(coalesce(raw_text, ''), '<em>(.*?)</em>', 1) AS source, {_fields(_RAW)}, raw_text, nullif(article_number, '') AS article_number,"
    + " CASE WHEN article_number <> '' THEN document_link END AS document_link FROM r",
    "html_references": "WITH r AS (SELECT DISTINCT ref_key, paper_id, raw_text FROM ref_records WHERE raw_text IS NOT NULL),"
    + " p AS (SELECT *, array_to_string(list_filter(list_transform(string_split_regex(raw_text, '</?em>'), lambda x: " + strip("x") + "), lambda y: y <> ''), ' ') AS raw,"
    + f" CASE WHEN contains(raw_text, '<em>') THEN {strip(_EM)} END AS em FROM r),"
    + f" q AS (SELECT paper_id AS doc_id, 'ref' || ref_key AS ref_id, row_number() OVER (PARTITION BY paper_id ORDER BY ref_key) - 1 AS n, {strip(_NO_FORMULA.replace('raw_text', 'raw'))} AS t, em FROM p)"
    + f" SELECT doc_id, ref_id, n, nullif(regexp_extract(t, '\"([^\"]+)\"', 1), '') AS title, em AS source, {_fields('t')}, t AS raw_text FROM q",
    "caption_images": _image_captions("Fig"),
    "caption_images_any": _image_captions(""),
    "caption_images_the": _image_captions("The "),
    "caption_tables": "WITH" + _BLOCKS
    + f"c AS (SELECT rec_id, page_no, b.bbox AS bbox, {_said('b')} AS caption, row_number() OVER (PARTITION BY rec_id, page_no ORDER BY block_no) - 1 AS caption_no FROM every WHERE b.type = 'table_caption' AND {_whole('b')}),"
    + f" t AS (SELECT rec_id, page_no, block_no, b.bbox AS bbox FROM every WHERE b.type = 'table' AND {_whole('b')})"
    + " SELECT DISTINCT rec_id, page_no, CAST(caption_no AS INT) AS caption_no, caption, x0, y0, x1, y1 FROM (SELECT c.rec_id, c.page_no, c.caption_no, c.caption, t.bbox[1] AS x0, t.bbox[2] AS y0, t.bbox[3] AS x1, t.bbox[4] AS y1,"
    + f" row_number() OVER (PARTITION BY c.rec_id, c.page_no, c.caption_no ORDER BY {_far(3)}, t.block_no) AS nth FROM c JOIN t ON c.rec_id = t.rec_id AND c.page_no = t.page_no) WHERE nth = 1",
    "best_blocks": _BEST + " SELECT rec_id, page_no, CAST(pdf_line AS INT) AS pdf_line, block_no, round(score, 6) AS score FROM best",
    "line_actions": _BEST
    + f", hits AS (SELECT g.rec_id, g.page_no, g.pdf_line, g.block_no, CAST(sum(CASE WHEN l.rec_id IS NOT NULL AND {_iou('m', 'l')} >= CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END) AS BIGINT) AS n_lines FROM best g JOIN moved m USING (rec_id, page_no, pdf_line)"
    + " LEFT JOIN lines l ON l.rec_id = g.rec_id AND l.page_no = g.page_no AND l.block_no = g.block_no GROUP BY 1, 2, 3, 4)"
    + " SELECT *, CASE n_lines WHEN 0 THEN 'insert' WHEN 1 THEN 'overwrite' ELSE 'merge' END AS action FROM hits",
    "bad_entries": _PUT + " SELECT doc_id, idx FROM marked WHERE bad",
    "cleaned_isolated": _ISOLATED,
    "plain_blanks": _TEXTS + r" SELECT item_id, regexp_replace(text, '\p{Zs}', ' ', 'g') AS plain FROM t",
    "html_to_marks": _TEXTS
    + r""" SELECT item_id, regexp_replace(regexp_replace(regexp_replace('H<sub>2</sub>O <sup class=''x''>+</sup><b>' || replace(text, chr(10), ' ') || '</b>', '<sub[^>]*>(.*?)</sub>', '_\1', 'g'), '<sup[^>]*>(.*?)</sup>', '^\1', 'g'), '<[^>]+>', '', 'g') AS marked FROM t""",
    "unfold_malformed": _TEXTS
    + r" SELECT item_id, replace(replace(replace(replace(replace(replace(regexp_replace(replace('a \over b \tag{(3)} & ' || text, '\over', '/'), '\\(hbox|tag)\{\(\d+\)\}', '', 'g'), '\$', '$'), '\cr', chr(10)), '\ll', '<<'), '\eqalignno{', ''), '}&', ')'), '&', '') AS unfolded FROM t WHERE type = 'equation'",
    "math_to_text": _TEXTS
    + r" SELECT item_id, " + strip(f"regexp_replace(regexp_replace({_BRACKETED}, '{_ANY_COMMAND}', '', 'g'), '{WS}+', ' ', 'g')") + " AS plain FROM t WHERE type = 'equation'",
    "compact_latex": _TEXTS + rf" SELECT item_id, regexp_replace(replace(replace(text, '\\', '\'), '$$', '$'), '{WS}+', '', 'g') AS compact FROM t WHERE type = 'equation'",
    "flat_schema_counts": OUTLINE.rstrip() + ", " + _FINE
    + " SELECT doc_id, " + _count("sections") + " AS n_sections, " + _count("named") + " AS n_paragraphs, " + _count("eqs") + " AS n_equations,"
    + " (SELECT count(*) FROM formed x JOIN docs d USING (doc_id) WHERE x.doc_id = fine.doc_id AND x.type = 'image' AND x.idx < d.body_end) AS n_figures,"
    + " (SELECT count(*) FROM formed x JOIN docs d USING (doc_id) WHERE x.doc_id = fine.doc_id AND x.type = 'table' AND x.idx < d.body_end) AS n_tables FROM fine",
    "document_status": _WHOLE + " SELECT doc_id, status FROM whole",
    "merged_documents": _WHOLE + " SELECT doc_id, status, title, doi, n_refs, n_paragraphs FROM whole",
    "failure_report": _WHOLE + " SELECT doc_id, file_name, stage, error_code FROM report",
    "retry_list": _WHOLE + " SELECT doc_id, file_name FROM report WHERE stage = 'parse'",
    "figures_and_tables": "SELECT doc_id, fig_id AS name, caption, fig_num AS num, img_path AS content FROM (" + _captioned("image", "img_caption", "img_path", "fig", False) + ")"
    + " UNION ALL SELECT doc_id, tab_id, caption, tab_num, table_body FROM (" + _captioned("table", "table_caption", "table_body", "table", False) + ")",
}


def oracle_sql() -> dict[str, str]:
    from vellumine.oracle_folds import FOLDS  # which builds on the sets stated here

    return P1 | STRUCTURE | OTHER | FOLDS
