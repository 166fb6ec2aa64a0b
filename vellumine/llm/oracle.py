"""The SQL that says the same as the queries of the llm subpackage, where SQL can."""

from __future__ import annotations

_P5 = r"""
WITH rows AS (
  SELECT DISTINCT item_id, paper_id, coalesce(source, '') AS source, text FROM content_list
  WHERE lower(type) = 'text' AND text_level IS NULL AND text IS NOT NULL AND paper_id IS NOT NULL AND item_id IS NOT NULL),
split AS (SELECT source, paper_id, item_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM rows),
lines AS (
  SELECT source, paper_id, item_id, line_no, regexp_replace(lower(line), '\p{Nd}+', '0', 'g') AS line_key FROM split
  WHERE regexp_matches(line, '(?:\p{L}+\P{L}+){3}\p{L}')),
totals AS (SELECT coalesce(source, '') AS source, count(DISTINCT paper_id) AS papers FROM content_list GROUP BY 1),
kept AS (
  SELECT source, line_key, count(DISTINCT paper_id) AS line_papers, any_value(papers) AS papers FROM lines JOIN totals USING (source)
  GROUP BY 1, 2 HAVING count(DISTINCT paper_id) >= 3 AND count(DISTINCT paper_id) >= any_value(papers) * CAST(0.15 AS DOUBLE))
"""

# Written down anew, so that a letter that the operator lacks shows: letters that look Latin, and their Latin look.
_FOREIGN, _LATIN = "асеорхуіјѕАВСЕНІКМОРТХЅЈοΟΑΒΕΖΗΙΚΜΝΡΤΥΧν", "aceopxyijsABCEHIKMOPTXSJoOABEZHIKMNPTYXv"
_FROM = "".join(chr(0xFF01 + i) for i in range(94)) + "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000" + "µ‐‑" + _FOREIGN
_TO = "".join(chr(0x21 + i) for i in range(94)) + " " * 15 + "μ--" + _LATIN


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _look(column: str) -> str:
    """The one form of a text in which every foreign letter with a Latin look-alike is meant as the Latin one."""
    out = rf"regexp_replace({column}, '[\x{{00AD}}\x{{200B}}-\x{{200F}}\x{{2060}}-\x{{2064}}\x{{FEFF}}]', '', 'g')"
    for i, plain in enumerate(("ff", "fi", "fl", "ffi", "ffl", "st", "st")):
        out = f"replace({out}, '{chr(0xFB00 + i)}', '{plain}')"
    return f"nfc_normalize(translate({out}, {_quoted(_FROM)}, {_quoted(_TO)}))"


def _alike(tbl: str, key: str, column: str) -> str:
    return f"""SELECT DISTINCT '{tbl}' AS tbl, a.k AS key_lo, b.k AS key_hi FROM {tbl}_looks a JOIN {tbl}_looks b ON a.look = b.look AND a.k < b.k AND a.t <> b.t"""


def _looks(tbl: str, key: str, column: str) -> str:
    return f"""{tbl}_looks AS (SELECT * FROM (SELECT *, count(DISTINCT t) OVER (PARTITION BY look) AS codings FROM (SELECT DISTINCT {key} AS k, {column} AS t, {_look(column)} AS look FROM {tbl} WHERE {column} IS NOT NULL))
  WHERE codings > 1 AND regexp_matches(look, '\\S'))"""


# Words of an item and a document, and the item's places that lie in a common stretch of twelve words.
_PLAIN = rf"regexp_extract_all(lower(regexp_replace(regexp_replace({{0}}, '[-¬‐\x{{{{AD}}}}][ \t]*\n\s*', '', 'g'), '[-¬‐]', '', 'g')), '[\p{{{{L}}}}\p{{{{N}}}}]+')"
_P6 = (
    "WITH i AS (SELECT item_id, " + _PLAIN.format(_look("item_text")) + " AS w FROM (SELECT DISTINCT item_id, item_text FROM eval_items WHERE item_id IS NOT NULL AND item_text IS NOT NULL)),"
    + " d AS (SELECT doc_id, " + _PLAIN.format(_look("text")) + " AS w FROM (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)),"
    + " ig AS (SELECT item_id, len(w) AS n, unnest(range(1, len(w) - 10)) AS first, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k : k + 11], ' '))) AS gram FROM i WHERE len(w) >= 12),"
    + " dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k : k + 11], ' '))) AS gram FROM d WHERE len(w) >= 12),"
    + " places AS (SELECT DISTINCT doc_id, item_id, n, first + unnest(range(0, 12)) AS place FROM dg JOIN ig USING (gram))"
    + " SELECT doc_id, item_id FROM places GROUP BY doc_id, item_id, n HAVING count(*) * 2 >= n"
)

# By characters instead of tokens: the test tables' sources are far from the bound by any measure of size.
_P7 = """
WITH sized AS (SELECT source, sum(length(text)) AS tokens FROM (SELECT DISTINCT doc_id, source, text FROM documents WHERE source IS NOT NULL AND text <> '') GROUP BY 1),
own AS (SELECT m.mix_id, m.source, m.target_share, m.max_repeats, coalesce(s.tokens, 0) AS tokens FROM (SELECT DISTINCT * FROM mix_targets WHERE mix_id IS NOT NULL) m LEFT JOIN sized s USING (source)),
mix AS (SELECT *, sum(tokens) OVER (PARTITION BY mix_id) AS mix_tokens FROM own)
SELECT DISTINCT mix_id, source FROM mix WHERE max_repeats * tokens < target_share * mix_tokens
"""

# A plainer measure than the operator's: three lines around each, by the common words of all languages together.
_P8 = r"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM docs),
words AS (SELECT doc_id, n, unnest(regexp_extract_all(lower(line), '\p{L}+|\p{N}+')) AS word FROM lines),
common AS (SELECT DISTINCT lower(word) AS word, true AS known FROM common_words WHERE word IS NOT NULL),
counted AS (SELECT doc_id, n, count(*) AS words, count(known) AS hits FROM words LEFT JOIN common USING (word) GROUP BY 1, 2),
near AS (
  SELECT doc_id, length(line) AS chars, sum(coalesce(words, 0)) OVER w AS words, sum(coalesce(hits, 0)) OVER w AS hits FROM lines LEFT JOIN counted USING (doc_id, n)
  WHERE regexp_matches(line, '\S') WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT doc_id FROM near GROUP BY doc_id HAVING sum(CASE WHEN words > 0 AND hits >= words * CAST(0.3 AS DOUBLE) THEN chars ELSE 0 END) < sum(chars) * CAST(0.5 AS DOUBLE)
"""

ORACLE = {
    "p6_found": _P6,
    "p7_found": _P7,
    "p8_found": _P8,
    "p5_clean": _P5
    + ", gone AS (SELECT DISTINCT item_id, line_no FROM lines JOIN kept USING (source, line_key)),"
    + " every AS (SELECT item_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM (SELECT DISTINCT item_id, text FROM content_list WHERE text IS NOT NULL)),"
    + " left_over AS (SELECT item_id, text, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE g.item_id IS NULL), '') AS clean_text, count(g.item_id) AS removed FROM every e LEFT JOIN gone g USING (item_id, line_no) GROUP BY 1, 2)"
    + " SELECT item_id, clean_text, removed FROM left_over UNION ALL SELECT DISTINCT item_id, CAST(NULL AS VARCHAR), 0 FROM content_list WHERE text IS NULL",
    "p4_one_form": f"SELECT 'content_list' AS tbl, item_id AS key, {_look('text')} AS look FROM content_list UNION ALL SELECT 'ref_records', ref_key, {_look('raw_text')} FROM ref_records",
    "p4_groups": f"WITH {_looks('content_list', 'item_id', 'text')}, {_looks('ref_records', 'ref_key', 'raw_text')} "
    + " UNION ALL ".join(f"SELECT DISTINCT '{tbl}' AS tbl, k AS key, min(k) OVER (PARTITION BY look) AS group_id, codings FROM {tbl}_looks" for tbl in ("content_list", "ref_records")),
    "p4_found": f"WITH {_looks('content_list', 'item_id', 'text')}, {_looks('ref_records', 'ref_key', 'raw_text')} {_alike('content_list', 'item_id', 'text')} UNION ALL {_alike('ref_records', 'ref_key', 'raw_text')}",
    "p5_found": _P5 + "SELECT DISTINCT item_id, CAST(line_no AS INT) AS line_no FROM lines JOIN kept USING (source, line_key)",
    "p5_report": _P5
    + "SELECT source, line_papers, papers, count(*) AS n_lines FROM kept JOIN (SELECT DISTINCT source, line_key, item_id, line_no FROM lines) USING (source, line_key)"
    + " GROUP BY source, line_key, line_papers, papers",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
