"""Hand-derived cases of the outline and of what hangs on it."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vellumine.functions import headings as H
from vellumine.functions import text as X
from vellumine.operators import structure as S
from vellumine.plans import pipeline, tree

SCHEMA = "paper_id long, idx int, type string, text string, text_level int, page_idx int, img_path string, img_caption array<string>, table_caption array<string>, table_body string"


def head(text):
    return ("text", text, 1, None, None)


def item(kind, text=None, images=None, tables=None):
    return (kind, text, None, images, tables)


D1 = [
    head("A Tiny Amplifier"), item("text", "Abstract words."), head("I. INTRODUCTION"), item("text", r"First para with $C_{\rm p}$ inside."), item("equation", "$$ a = b $$"),
    item("text", "  "), head("A. Background"), item("text", "Sub para."), item("image", images=["Fig. 1. Gain."]), head("B. Scope"), item("equation", "E=mc^2"),
    head("II. METHOD"), item("equation", "x=1"), item("text", "Method para."), item("text", "Second."), item("table", tables=[]), head("ACKNOWLEDGMENT"), item("text", "Thanks."),
    head("REFERENCES"), item("text", "[1] A. B"), item("image", images=["Fig. 2. Late."]),
]


def content(spark, *docs):
    data = [(d, i, t, x, level, 0, f"{i}.jpg" if t == "image" else None, images, tables, None) for d, its in docs for i, (t, x, level, images, tables) in enumerate(its)]
    return spark.createDataFrame(data, SCHEMA)


def outline(spark, *docs):
    return S.outlined(S.items(content(spark, *docs)))


def test_bounds_and_sections(spark):
    o = outline(spark, (1, D1))
    assert rows(S.bounds(o)) == [(1, 2, "roman", 18)]
    assert rows(S.sections(o), "sec_id", "title", "region_start", "region_end", "level") == [
        ("1", "I. INTRODUCTION", 2, 10, "section"), ("1.1", "A. Background", 6, 8, "subsection"), ("1.2", "B. Scope", 9, 10, "subsection"),
        ("2", "II. METHOD", 11, 17, "section"), ("2.1", "ACKNOWLEDGMENT", 16, 17, "subsection"),
    ]


def test_paragraphs_equations_captions(spark):
    o = outline(spark, (1, D1))
    ordered = S.paragraph_order(S.paragraphs(o)).orderBy("rank").collect()
    assert [(r["para_id"], r["idx"]) for r in ordered] == [("1_p1", 3), ("1.1_p1", 7), ("2_p1", 13), ("2_p2", 14), ("2.1_p1", 17)]
    eqs = S.equation_order(S.equations(o)).orderBy("rank").collect()
    assert [(r["eq_id"], r["para_id"], r["raw_latex"]) for r in eqs] == [("1.1_p1_eq0", "1.1_p1", "E=mc^2"), ("1.1_p1_eq0", "1.1_p1", "x=1"), ("1_p1_eq0", "1_p1", "$$ a = b $$")]
    assert rows(S.figures(o), "fig_id", "caption") == [("fig1", "Fig. 1. Gain.")]
    assert rows(S.tables(o), "tab_id", "caption") == [("tab1", "")]
    assert rows(S.figures(o, bounded=False), "fig_id", "caption") == [("fig1", "Fig. 1. Gain."), ("fig2", "Fig. 2. Late.")]
    assert rows(S.formulae(S.paragraphs(o)), "cleaned", "raw") == [("C_ p", r"$C_{\rm p}$")]


def test_tree_repeats_text_for_other_items_and_fails_without_any(spark):
    o = outline(spark, (1, D1))
    content_rows = rows(S.region_content(o), "sec_id", "idx", "text")
    assert content_rows == [("1", 3, r"First para with $C_{\rm p}$ inside."), ("1", 4, r"First para with $C_{\rm p}$ inside."), ("1.1", 7, "Sub para."), ("1.1", 8, "Sub para."), ("1.2", 10, None), ("2", 12, None), ("2", 13, "Method para."), ("2", 14, "Second."), ("2", 15, "Second."), ("2.1", 17, "Thanks.")]
    assert rows(S.errors(o)) == [(1, None, "NONTEXT_BEFORE_TEXT")]


def test_error_codes(spark):
    no_intro = [head("I. OVERVIEW") if x == D1[2] else x for x in D1]
    early = [x for i, x in enumerate(D1) if i not in (3, 5)]
    backwards = [head("REFERENCES"), *D1[:18]]
    o = outline(spark, (1, no_intro), (2, early), (3, backwards), (4, [item("text", None)]))
    assert rows(S.errors(o), "doc_id", "error_code") == [(1, "NO_INTRODUCTION"), (2, "EQ_BEFORE_PARA"), (3, None), (4, "NO_INTRODUCTION")]
    assert S.sections(o).filter("doc_id = 3").count() == 0


@pytest.mark.parametrize(
    "title, prefix, fmt",
    [
        ("I. INTRODUCTION", "I.", "roman"), ("INTRODUCTION", "", "none"), ("1 Introduction", "1", "arabic"), ("1. Introduction", "1.", "arabic"), ("2.3. Setup", "2.3.", "numeric"),
        ("I.INTRODUCTION", "", "none"), ("C. X", "C.", "alpha"), ("V. X", "V.", "roman"), ("a) X", "a)", "alpha"), ("A Study", "A", "alpha"), ("XL. X", "XL.", "roman"), ("XXXI. X", "XXXI.", "none"),
    ],
)
def test_prefix_format(spark, title, prefix, fmt):
    p = H.prefix(F.lit(title))
    assert tuple(spark.range(1).select(p, H.prefix_format(p)).first()) == (prefix, fmt)


def test_depth_and_level_names(spark):
    got = spark.range(7).select(H.depth_label(F.col("id"))).collect()
    assert [r[0] for r in got] == ["section", "subsection", "subsubsection", "paragraph", "subparagraph", "level5", "level6"]
    assert [r[0] for r in spark.createDataFrame([("roman",), ("alpha",), ("numeric",), ("none",)], "f string").select(H.level_of_format(F.col("f"))).collect()] == ["section", "subsection", "subsection", "section"]


def test_repeated_rows_and_order_of_input_make_no_difference(spark):
    base = content(spark, (1, D1), (2, D1))
    again = base.union(base.filter("idx % 3 = 0")).repartition(3).orderBy(F.rand(5))
    a, b = S.outlined(S.items(base)), S.outlined(S.items(again))
    for f in (S.sections, S.paragraphs, S.equations, S.figures):
        assert rows(f(a)) == rows(f(b))


def test_text_after_the_body_changes_nothing_but_unbounded_captions(spark):
    longer = [*D1, item("text", "more"), head("APPENDIX"), item("text", "x")]
    a, b = outline(spark, (1, D1)), outline(spark, (1, longer))
    for f in (S.sections, S.paragraphs, S.equations, S.figures, S.tables):
        assert rows(f(a)) == rows(f(b))


def test_stray_level_one_row_ends_a_section(spark):
    doc = [head("1 Introduction"), item("text", "a"), ("equation", "x", 1, None, None), item("text", "b"), head("2 Next"), item("text", "c")]
    assert rows(S.paragraphs(outline(spark, (1, doc))), "para_id", "text") == [("1_p1", "a"), ("2_p1", "c")]


def test_duplicate_titles_last_wins_in_tree(spark):
    doc = [head("I. INTRODUCTION"), item("text", "a"), head("II. X"), item("text", "b"), head("II. X"), item("text", "c"), head("A. S"), item("text", "d"), head("A. S"), item("text", "e")]
    o = outline(spark, (1, doc))
    assert rows(S.body_text(o), "section", "subsection", "text") == [("I. INTRODUCTION", None, "a"), ("II. X", None, "c"), ("II. X", "II. - A. S", "e")]
    body = json.loads(tree.body_tree(o).select(F.to_json("body")).first()[0])
    assert list(body) == ["I. INTRODUCTION", "II. X"] and [t["text"] for t in body["II. X"]["text"]] == ["c"]
    assert body["II. X"]["subsections"]["II. - A. S"]["heading"] == "A. S"


def test_one_shuffle_by_document_up_to_paragraphs(spark):
    plan = S.paragraphs(outline(spark, (1, D1)))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") + initial.count("REPARTITION") <= 2 and "SortMergeJoin" not in initial
    assert initial.count("Exchange") == 1


def test_empty_tables(spark):
    o = S.outlined(S.items(spark.createDataFrame([], SCHEMA)))
    for f in (S.sections, S.paragraphs, S.equations, S.figures, S.tables, S.errors, S.region_content, S.body_text):
        assert f(o).count() == 0


def test_status_routing(spark):
    items = S.items(content(spark, (1, D1), (2, D1), (3, D1[:2]), (4, D1)))
    good = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title level="a" type="main">T &amp; U</title></titleStmt></fileDesc></teiHeader></TEI>'
    refs = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><back><div><listBibl><biblStruct><monogr><title>J</title></monogr></biblStruct></listBibl></div></back></text></TEI>'
    docs = spark.createDataFrame([(1, good, refs), (2, "<a><b>", refs), (3, good, refs), (4, good, None), (5, good, refs)], "doc_id long, tei_header string, tei_references string")
    whole = pipeline.merged(docs, pipeline.flat_schema(items))
    assert rows(whole, "doc_id", "status") == [(1, "ok"), (2, "partial"), (3, "failed"), (4, "partial"), (5, "failed")]
    names = docs.select("doc_id", F.concat(F.lit("f"), "doc_id").alias("file_name"))
    report = pipeline.failures(whole, S.errors(S.outlined(items)), names)
    assert rows(report) == [(2, "f2", "metadata", "NO_METADATA"), (3, "f3", "parse", "NO_INTRODUCTION"), (4, "f4", "metadata", "NO_METADATA"), (5, "f5", "parse", "NO_ITEMS")]
    assert rows(pipeline.to_retry(names, report), "doc_id") == [(3,), (5,)]
    assert rows(pipeline.to_retry(names, report, True), "doc_id") == [(2,), (3,), (4,), (5,)]
    text = dict(rows(pipeline.as_json(whole), "doc_id", "json"))
    assert '"title":"T & U"' in text[1] and '"bibliographical references":[{"ref_id":"ref1"' in text[1] and text[3] is None and '"title":"T' not in text[2].split('"paragraphs"')[0].split("sections")[0]


def test_latest_delivery(spark):
    papers = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", None), (None, "d", 1)], "paper_id long, title string, ingested_at int")
    assert rows(pipeline.latest(papers), "paper_id", "title") == [(1, "b"), (2, "c")]


def test_citations(spark):
    assert spark.range(1).select(X.citations(F.lit("see [1], [23] and [x]"))).first()[0] == ["1", "23"]


def test_unlike_rows_at_one_place_keep_one_order(spark):
    base = content(spark, (1, D1))
    more = spark.createDataFrame([(1, 3, "text", x, None, 0, None, None, None, None) for x in ("Other words.", "More words.")] + [(1, 8, "image", None, None, 0, "z.jpg", ["Fig. 9."], None, None)], SCHEMA)
    got = []
    for df in (base.union(more), more.repartition(3).union(base.orderBy("idx", ascending=False))):
        o = S.outlined(S.items(df))
        got.append((rows(S.paragraphs(o)), rows(S.figures(o)), rows(pipeline.flat_schema(S.items(df)))))
    assert got[0] == got[1] and len(got[0][0]) == 7
