r"""The SQL, for DuckDB, of the queries that rewrite LaTeX, fold over rows one after another, or give whole records as JSON.

Folds are recursive sets over the rows of one document or block. Of LaTeX only what the test tables hold is stated:
\lambda is the one command there that stands for a character, \frac the one with arguments.
"""

from __future__ import annotations

from vellumine.oracle import _ANY_COMMAND, _BEST, _FINE, _HEADER, _LATEST, _PUT, _SPELT, _TEXTS, OUTLINE, WS, _iou, strip
from vellumine.oracle import _CLEANED as _CLEANED_INNER

_EQUATIONS = _TEXTS + ", e AS (SELECT item_id, text FROM t WHERE type = 'equation')"
_RESTORED = r"regexp_replace(text, '\\?(text|frac|sqrt|sum|int|lim|log|sin|cos|tan|hbox|mu|ohm|omega)', '\\\1', 'g')"
_UNFOLDED = (
    r"replace(replace(replace(replace(replace(replace(regexp_replace(replace(text, '\over', '/'), '\\(hbox|tag)\{\(\d+\)\}', '', 'g'),"
    r" '\$', '$'), '\cr', chr(10)), '\ll', '<<'), '\eqalignno{', ''), '}&', ')'), '&', '')"
)
_MARKED = r"regexp_replace(regexp_replace(regexp_replace(text, '<sub[^>]*>(.*?)</sub>', '_\1', 'g'), '<sup[^>]*>(.*?)</sup>', '^\1', 'g'), '<[^>]+>', '', 'g')"


def _spelt(x: str) -> str:
    """Commands as characters, unknown ones dropped."""
    fractions = rf"regexp_replace({x}, '\\frac\s*\{{([^{{}}]*)\}}\s*\{{([^{{}}]*)\}}', '\1/\2', 'g')"
    return rf"regexp_replace(regexp_replace({fractions}, '\\lambda\s*', 'λ', 'g'), '\\[a-zA-Z]+\*?\s*', '', 'g')"


_SQUEEZE = r"\\\\[a-zA-Z]+\*?\s*\{[^}]*\}"
_SIGN, _OTHER = r"[^\\+\-*/=\s]", r"[\\+\-*/=]"


def _tight(x: str) -> str:
    """Blanks that stand next to no operator taken out; two passes, since neighbours share a sign."""
    for _ in range(2):
        x = rf"regexp_replace({x}, '({_SIGN})\s+({_SIGN})', '\1\2', 'g')"
    return rf"regexp_replace(regexp_replace({x}, '^\s+({_SIGN}|$)', '\1'), '({_SIGN})\s+$', '\1')"


def _woven(text: str) -> str:
    """A text whose formulas between two dollars of one line are tidied, without the dollars; every space separator a blank."""
    inner = _tight(f"translate({_spelt('x')}, '{{}}', '')")
    parts = f"list_transform(string_split({text}, '$'), lambda x, i: CASE WHEN i % 2 = 1 THEN x WHEN contains(x, chr(10)) THEN '$' || x || '$' ELSE {inner} END)"
    return rf"regexp_replace(array_to_string({parts}, ''), '\p{{Zs}}', ' ', 'g')"


def _bad(text: str) -> str:
    """The boilerplate test, as it stands in the set of marked rows."""
    at = _PUT.index("coalesce(regexp_matches")
    return _PUT[at : _PUT.index(" AS bad")].replace("(text,", f"({text},")


_FLAT = f"CASE WHEN contains(text, chr(10)) THEN regexp_replace(replace(text, chr(10), ''), '{WS}+', ' ', 'g') ELSE coalesce(text, '') END"
_CLEANED = (
    _PUT.replace("WITH put", "WITH RECURSIVE put", 1)
    + f", m AS (SELECT doc_id, idx, type, text_level, bad, coalesce(text, '') AS raw, CASE WHEN type = 'text' THEN {_woven(_FLAT)} ELSE coalesce(text, '') END AS clean FROM marked WHERE doc_id IS NOT NULL AND idx IS NOT NULL),"
    + " r AS (SELECT *, row_number() OVER w AS i, lead(raw) OVER w AS next_raw FROM m WHERE type = 'text' AND coalesce(text_level, 0) = 0 WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),"
    + " fold AS (SELECT DISTINCT doc_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS kept, CAST(NULL AS VARCHAR) AS said, false AS skip, false AS failed FROM r UNION ALL"
    + " SELECT f.doc_id, r.i, CASE WHEN f.skip OR r.bad THEN f.kept ELSE r.i END,"
    + " CASE WHEN f.skip THEN f.said WHEN NOT r.bad THEN r.clean WHEN ends_with(f.said, '.') THEN f.said ELSE f.said || ' ' || r.next_raw END,"
    + " coalesce(NOT f.skip AND r.bad AND NOT ends_with(f.said, '.'), false), NOT f.skip AND r.bad AND (f.said IS NULL OR r.next_raw IS NULL) FROM fold f JOIN r ON r.doc_id = f.doc_id AND r.i = f.i + 1 WHERE NOT f.failed),"
    + " lost AS (SELECT doc_id FROM fold WHERE failed),"
    + " last AS (SELECT doc_id, kept, arg_max(said, i) AS said FROM fold WHERE kept > 0 GROUP BY 1, 2),"
    + " whole AS (SELECT r.doc_id, r.idx, r.type, l.said AS text, r.text_level FROM last l JOIN r ON r.doc_id = l.doc_id AND r.i = l.kept"
    + " UNION ALL SELECT doc_id, idx, type, clean, text_level FROM m WHERE NOT bad AND NOT coalesce(type = 'text' AND coalesce(text_level, 0) = 0, false))"
    + f" SELECT doc_id, idx, type, text, text_level, CAST(NULL AS VARCHAR) AS error_code FROM whole WHERE doc_id NOT IN (SELECT doc_id FROM lost) AND NOT {_bad('text')}"
    + " UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, 'BAD_ENTRY_NO_NEIGHBOUR' FROM lost"
)

_LINE_LIST = "list({'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'content': content} ORDER BY line_no)"
_RECONCILED = (
    _BEST.replace("WITH", "WITH RECURSIVE", 1)
    + ", told AS (SELECT rec_id, page_no, block_no, line_no, coalesce(array_to_string(list_transform(l.spans, lambda sp: sp.content), ' '), '') AS content FROM l WHERE l IS NOT NULL),"
    + " stored AS (SELECT * FROM lines JOIN told USING (rec_id, page_no, block_no, line_no)),"
    + " fresh AS (SELECT g.rec_id, g.page_no, g.block_no, m.x0, m.y0, m.x1, m.y1, t.content, row_number() OVER (PARTITION BY g.rec_id, g.page_no, g.block_no ORDER BY m.pdf_line) AS k"
    + " FROM best g JOIN moved m USING (rec_id, page_no, pdf_line) JOIN told t ON t.rec_id = m.rec_id AND t.page_no = m.page_no AND t.block_no * 1000 + t.line_no = m.pdf_line),"
    + f" start AS (SELECT rec_id, page_no, block_no, {_LINE_LIST} AS lines FROM stored GROUP BY 1, 2, 3),"
    + " begun AS (SELECT DISTINCT b.rec_id, b.page_no, b.block_no, coalesce(s.lines, []) AS lines FROM (SELECT rec_id, page_no, block_no FROM start UNION SELECT rec_id, page_no, block_no FROM fresh) b LEFT JOIN start s USING (rec_id, page_no, block_no)),"
    + " fold AS (SELECT rec_id, page_no, block_no, CAST(0 AS BIGINT) AS k, lines FROM begun UNION ALL SELECT rec_id, page_no, block_no, k,"
    + " CASE WHEN len(hits) > 0 THEN list_transform(list_filter(range(1, len(lines) + 1), lambda i: i = hits[1] OR NOT list_contains(hits, i)), lambda j: CASE WHEN j = hits[1] THEN fresh ELSE lines[j] END)"
    + " ELSE list_concat(list_concat(lines[: place - 1], [fresh]), lines[place :]) END FROM ("
    + " SELECT f.rec_id, f.page_no, f.block_no, n.k, f.lines, {'x0': n.x0, 'y0': n.y0, 'x1': n.x1, 'y1': n.y1, 'content': n.content} AS fresh,"
    + f" list_filter(range(1, len(f.lines) + 1), lambda i: {_iou('f.lines[i]', 'n')} >= CAST(0.5 AS DOUBLE)) AS hits,"
    + " coalesce(list_min(list_filter(range(1, len(f.lines) + 1), lambda i: f.lines[i].y0 > n.y0)), len(f.lines) + 1) AS place"
    + " FROM fold f JOIN fresh n ON n.rec_id = f.rec_id AND n.page_no = f.page_no AND n.block_no = f.block_no AND n.k = f.k + 1)),"
    + " ended AS (SELECT rec_id, page_no, block_no, arg_max(lines, k) AS lines FROM fold GROUP BY 1, 2, 3)"
    + " SELECT rec_id, page_no, block_no, line_no, x.x0 AS x0, x.y0 AS y0, x.x1 AS x1, x.y1 AS y1, x.content AS content FROM"
    + " (SELECT rec_id, page_no, block_no, unnest(lines) AS x, CAST(generate_subscripts(lines, 1) - 1 AS INT) AS line_no FROM ended)"
)


def _listed(of: str, fields: str, order: str) -> str:
    return f"(SELECT list({{{fields}}} ORDER BY {order}) FROM {of} WHERE doc_id = w.doc_id)"


_FIRST = "CASE WHEN len({0}) > 0 THEN {0}[1] ELSE '' END"
_FLAT_LISTS = (
    "coalesce(" + _listed("sections", "'sec_id': sec_id, 'title': title", "idx") + ", []) AS sections,"
    + " coalesce(" + _listed("named", "'para_id': para_id, 'sec_id': sec_id, 'text': text", "sec_no, sub_no, para_no") + ", []) AS paragraphs,"
    + " coalesce(" + _listed("eqs", "'eq_id': eq_id, 'para_id': para_id, 'raw_latex': raw_latex", "eq_id, idx") + ", []) AS equations,"
    + " coalesce(" + _listed("figs", "'fig_id': fig_id, 'caption': caption", "num") + ", []) AS figures,"
    + " coalesce(" + _listed("tabs", "'tab_id': tab_id, 'caption': caption", "num") + ", []) AS tables"
)


def _numbered(kind: str, captions: str, name: str) -> str:
    n = "row_number() OVER (PARTITION BY f.doc_id ORDER BY f.idx)"
    return f"(SELECT f.doc_id, {n} AS num, '{name}' || {n} AS {name}_id, {_FIRST.format('f.' + captions)} AS caption FROM formed f JOIN docs d USING (doc_id) WHERE f.type = '{kind}' AND d.intro_idx IS NOT NULL AND f.idx < d.body_end)"


_LISTS = OUTLINE.rstrip() + f", figs AS {_numbered('image', 'img_caption', 'fig')}, tabs AS {_numbered('table', 'table_caption', 'tab')}, {_FINE}"
_RECORD_REFS = (
    "refs AS (SELECT doc_id, list({'ref_id': 'ref' || n, 'title': title, 'authors': authors, 'source': source, 'volume': volume, 'issue no.': issue_no, 'pages': pages, 'publication year': publication_year, 'raw text': raw_text} ORDER BY n) AS refs FROM ("
    + "SELECT paper_id AS doc_id, row_number() OVER (PARTITION BY paper_id ORDER BY ref_key) AS n, nullif(title, '') AS title, CASE WHEN len(people) > 0 THEN people END AS authors, nullif(source, '') AS source, volume, issue_no,"
    + " CASE WHEN split_part(pages, '-', 1) <> '' AND split_part(pages, '-', 2) <> '' THEN split_part(pages, '-', 1) || '-' || split_part(pages, '-', 2) END AS pages, left(publication_year, 4) AS publication_year, nullif(raw_text, '') AS raw_text"
    + f" FROM (SELECT *, list_filter(list_transform(authors, lambda a: nullif({strip(f'regexp_replace(a, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '')), lambda b: b IS NOT NULL) AS people FROM (SELECT DISTINCT * FROM ref_records))) GROUP BY 1)"
)
_HEAD_FIELDS = ["authors", "title", "doi", "displayPublicationDate", "publisher", "contentTypeDisplay", "subType", "publicationTitle", "confLoc", "volume", "startPage", "endPage", "publicationDate", "publicationYear", "abstract"]
_PARTS = ["sections", "paragraphs", "equations", "figures", "tables"]


def _json(fields: dict[str, str]) -> str:
    return "CAST(to_json({" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}) AS VARCHAR)"


_MERGED = (
    _LISTS + ", " + _LATEST + f", head AS ({_HEADER}), {_RECORD_REFS},"
    + " every AS (SELECT l.paper_id AS doc_id, f.doc_id IS NOT NULL AS sound, r.refs FROM latest l LEFT JOIN fine f ON f.doc_id = l.paper_id LEFT JOIN refs r ON r.doc_id = l.paper_id),"
    + f" listed AS (SELECT w.doc_id, {_FLAT_LISTS} FROM every w WHERE sound)"
    + " SELECT e.doc_id, CASE WHEN NOT sound THEN 'failed' WHEN e.refs IS NOT NULL THEN 'ok' ELSE 'partial' END AS status, CASE WHEN NOT sound THEN NULL WHEN e.refs IS NOT NULL THEN "
    + _json({**{f: f'h."{f}"' for f in _HEAD_FIELDS}, **{p: f"l.{p}" for p in _PARTS}, "bibliographical references": "e.refs"})
    + " ELSE " + _json({p: f"l.{p}" for p in _PARTS}) + " END AS json FROM every e LEFT JOIN listed l USING (doc_id) LEFT JOIN head h USING (doc_id)"
)

_FORMULAE = rf"list_filter(list_transform(regexp_extract_all(text, '\$([^$]+)\$', 1), lambda x: {{'cleaned': {_CLEANED_INNER}, 'raw': '$' || x || '$'}}), lambda y: y.cleaned <> '')"
_TREE = (
    OUTLINE.rstrip()
    + ", fit AS (SELECT doc_id FROM docs WHERE intro_idx IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM compat WHERE text IS NULL)),"
    + " tops2 AS (SELECT doc_id, section, max(sec_no) AS sec_no, min(sec_no) AS first_no, arg_max(sec_prefix, sec_no) AS prefix FROM sections WHERE is_section GROUP BY 1, 2),"
    + " subs AS (SELECT s.doc_id, t.section, t.sec_no, t.prefix || ' - ' || s.title AS name, min(s.sub_no) AS first_no, max(s.sub_no) AS sub_no, arg_max(s.title, s.sub_no) AS title"
    + " FROM sections s JOIN tops2 t ON t.doc_id = s.doc_id AND t.sec_no = s.sec_no WHERE NOT s.is_section GROUP BY 1, 2, 3, 4),"
    + f" said AS (SELECT doc_id, sec_id, list({{'text': text, 'formulae': {_FORMULAE}}} ORDER BY idx) AS texts FROM compat GROUP BY 1, 2),"
    + " below AS (SELECT u.doc_id, u.section, '{' || string_agg(to_json(u.name) || ':' || json_object('heading', u.title, 'text', coalesce(x.texts, [])), ',' ORDER BY u.first_no) || '}' AS parts"
    + " FROM subs u LEFT JOIN said x ON x.doc_id = u.doc_id AND x.sec_id = u.sec_no || '.' || u.sub_no GROUP BY 1, 2)"
    + " SELECT t.doc_id, CAST('{' || string_agg(to_json(t.section) || ':{\"heading\":' || to_json(t.section) || ',\"text\":' || to_json(coalesce(x.texts, [])) || ',\"subsections\":' || coalesce(b.parts, '{}') || '}', ',' ORDER BY t.first_no) || '}' AS VARCHAR) AS body"
    + " FROM tops2 t JOIN fit USING (doc_id) LEFT JOIN said x ON x.doc_id = t.doc_id AND x.sec_id = CAST(t.sec_no AS VARCHAR) LEFT JOIN below b ON b.doc_id = t.doc_id AND b.section = t.section GROUP BY 1"
)

FOLDS = {
    "restore_commands": _TEXTS + f" SELECT item_id, {_RESTORED} AS restored FROM t",
    "squeeze_commands": _EQUATIONS
    + f" SELECT item_id, array_to_string(list_transform(list_zip(string_split_regex(text, '{_SQUEEZE}'), regexp_extract_all(text, '{_SQUEEZE}')), lambda p: replace(p[1], ' ', '') || coalesce(p[2], '')), '') AS squeezed FROM e",
    "latex_to_text": _EQUATIONS
    + f", a AS (SELECT item_id, {_UNFOLDED} AS text FROM e), b AS (SELECT item_id, {_RESTORED} AS text FROM a), c AS (SELECT item_id, {_MARKED} AS text FROM b), d AS (SELECT item_id, {_spelt('text')} AS text FROM c),"
    + r" f AS (SELECT item_id, regexp_replace(text, '\{([^{}]?)\}', '\1', 'g') AS text FROM d)," + f" g AS (SELECT item_id, replace(replace({_SPELT}, '{{', '('), '}}', ')') AS text FROM f)"
    + " SELECT item_id, " + strip(f"regexp_replace(regexp_replace(text, '{_ANY_COMMAND}', '', 'g'), '{WS}+', ' ', 'g')") + " AS plain FROM g",
    "cleaned_inline": _TEXTS + f" SELECT item_id, {_woven('text')} AS clean FROM t WHERE contains(text, '$')",
    "cleaned_documents": _CLEANED,
    "reconciled_lines": _RECONCILED,
    "merged_json": _MERGED,
    "body_tree": _TREE,
}
