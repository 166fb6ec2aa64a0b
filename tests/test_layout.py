"""Shredding, captions and line reconciliation."""

import pytest

from tests.conftest import rows
from vellumine.operators import captions, layout_tree, reconcile
from vellumine.operators.shred import adjacency
from vellumine.sources.files import MIDDLE_SCHEMA

SCHEMA = "rec_id long, pdf_info " + MIDDLE_SCHEMA[len("struct<pdf_info:") : -1]


def span(content, box=(0.0, 0.0, 1.0, 1.0), path=None):
    return ([float(x) for x in box] if box else None, content, "text", 0.5, path)


def line(*spans, box=(0.0, 0.0, 1.0, 1.0)):
    return ([float(x) for x in box] if box else None, list(spans))


def block(kind, box, lines=None, blocks=None):
    return (kind, [float(x) for x in box] if box else None, lines, blocks)


def middle(spark, *records):
    return spark.createDataFrame([(i, pages) for i, pages in records], SCHEMA)


def brute(records):
    """The places by plain loops."""
    out = set()
    for rec, pages in records:
        for p, page in enumerate(pages or []):
            if page is None:
                continue
            out.add((rec, p, -1, -1, -1, -1))
            for b, blk in enumerate(page[0] or []):
                if blk is None:
                    continue
                out.add((rec, p, b, -1, -1, -1))
                groups = [(-1, blk[2])]
                for s, sub in enumerate(blk[3] or []):
                    if sub is not None:
                        out.add((rec, p, b, s, -1, -1))
                        groups.append((s, sub[2]))
                for s, lines in groups:
                    for li, ln in enumerate(lines or []):
                        if ln is not None:
                            out.add((rec, p, b, s, li, -1))
                            out |= {(rec, p, b, s, li, x) for x, sp in enumerate(ln[1] or []) if sp is not None}
    return sorted(out)


RECORDS = [
    (1, [([block("text", (0, 0, 1, 1), [line(span("a"), None, span(None)), None, line()]), None, block("image", None, None, [("image_body", None, [line(span("b", path="p.jpg"))]), None])],), None, (None,), ([],)]),
    (2, None), (3, []), (4, [([block(None, None, [(None, None)], [])],)]), (5, [([block("x", (1, 2, 3, 4), [line(*[span(str(i)) for i in range(50)])] * 20)],)]),
]


def test_places_match_brute_force(spark):
    df = middle(spark, *RECORDS)
    got = sorted(tuple(r) for r in layout_tree.layout_places(df.union(df)).collect())
    assert got == brute(RECORDS)


def test_nodes_keep_parents_ordinals_and_scalars(spark):
    nodes = {r["node"]: r for r in adjacency(middle(spark, RECORDS[0]), "rec_id", "pdf_info").collect()}
    (child,) = [n for n in nodes.values() if n["scalar"] == "p.jpg"]
    way = []
    while child["parent"] is not None:
        way.append((child["label"].split(".")[-1], child["ordinal"], child["kind"]))
        child = nodes[child["parent"]]
    assert way == [("image_path", None, "scalar"), ("spans[]", 0, "object"), ("spans", None, "array"), ("lines[]", 0, "object"), ("lines", None, "array"), ("blocks[]", 0, "object"), ("blocks", None, "array"), ("preproc_blocks[]", 2, "object"), ("preproc_blocks", None, "array"), ("[]", 0, "object")]
    assert child["kind"] == "array" and all(n["parent"] is None or n["parent"] in nodes for n in nodes.values())


def test_only_wanted_nodes_are_made(spark):
    df = middle(spark, *RECORDS)
    every = adjacency(df, "rec_id", "pdf_info")
    for labels in ({"[]"}, {"[].preproc_blocks[].lines[].spans[].content", "[].preproc_blocks"}, {"[].preproc_blocks[].bbox[]"}, {""}, {"none"}):
        wanted = every.filter(every["label"].isin(list(labels)))
        assert rows(adjacency(df, "rec_id", "pdf_info", labels), "rec_id", "node", "label", "scalar") == rows(wanted, "rec_id", "node", "label", "scalar")


def test_unlike_records_under_one_key_are_not_blended(spark):
    one, two = [([block("text", (0, 0, 1, 1), [line(span("z"))])],)], [([block("code", (5, 5, 6, 6), [line(span("a"), span("b"))])],)]
    df = middle(spark, (1, one), (1, two), (1, one))
    assert rows(layout_tree.layout_spans(df), "content", "span_no") == [("a", 0), ("b", 1), ("z", 0)]
    assert rows(layout_tree.layout_blocks(df), "type", "x0") == [("code", 5.0), ("text", 0.0)]
    assert layout_tree.layout_places(df).count() == 5


def test_rows_find_their_parents(spark):
    df = middle(spark, *RECORDS)
    pages, blocks, lines, spans = (rows(f(df), "rec_id", "node", "parent") for f in (layout_tree.layout_pages, layout_tree.layout_blocks, layout_tree.layout_lines, layout_tree.layout_spans))
    of = lambda table: {(r, n) for r, n, _ in table}
    assert all(p is None for *_, p in pages) and all((r, p) in of(pages) | of(blocks) for r, _, p in blocks)
    assert all((r, p) in of(blocks) for r, _, p in lines) and all((r, p) in of(lines) for r, _, p in spans)
    assert len(pages) + len(blocks) + len(lines) + len(spans) == len(brute(RECORDS))


def test_spans_round_trip(spark):
    got = rows(layout_tree.layout_spans(middle(spark, *RECORDS)), "rec_id", "page_no", "block_no", "sub_no", "line_no", "span_no", "content", "image_path", "x1")
    wanted = [(r, *p[1:], *v) for r, pages in RECORDS for p in brute([(r, pages)]) if p[5] >= 0 for v in [_span_at(pages, p)]]
    assert got == sorted(wanted, key=lambda r: tuple((x is not None, str(x)) for x in r))


def _span_at(pages, p):
    _, pg, b, s, li, x = p
    blk = pages[pg][0][b]
    lines = blk[2] if s < 0 else blk[3][s][2]
    sp = lines[li][1][x]
    return sp[1], sp[4], sp[0][2] if sp[0] else None


def test_extra_and_clashing_columns(spark):
    df = middle(spark, *RECORDS).selectExpr("*", "'x' as node", "'y' as label", "1 as page_no", "array(1) as ords")
    assert layout_tree.layout_places(df).count() == len(brute(RECORDS))
    assert layout_tree.layout_blocks(df).count() > 0


def test_empty_table(spark):
    df = middle(spark, (1, None)).limit(0)
    for f in (layout_tree.layout_places, layout_tree.layout_spans, layout_tree.layout_blocks, captions.image_captions, captions.table_captions):
        assert f(df).count() == 0


def page(*blocks):
    return (list(blocks),)


def test_caption_goes_to_the_nearest_image_left_of_it(spark):
    def body(box, path):
        return block("image", box, None, [("image_body", [float(x) for x in box], [line(span(None, path=path))])])

    cap = lambda box, text: block("image_caption", box, [line(span(text))])
    pages = [page(body((0, 0, 10, 10), "far"), body((20, 0, 30, 10), "near"), body((40, 0, 50, 10), "same x"), cap((40, 0, 50, 10), "Fig. 1"), cap((40, 0, 50, 10), "Table"), cap((0, 0, 1, 1), "Fig. 2")), None]
    assert rows(captions.image_captions(middle(spark, (1, pages)))) == [(1, 0, 0, "Fig. 1", "near")]
    assert len(rows(captions.image_captions(middle(spark, (1, pages)), begins=""))) == 2


def test_table_captions_take_the_nearest_table(spark):
    table = lambda *box: block("table", box)
    cap = block("table_caption", (0.0, 10.0, 10.0, 12.0), [line(span("Table"), span(None), span("1"))])
    pages = [page(table(0, 20, 10, 30), table(0, 0, 10, 8), cap, block("table", None))]
    assert rows(captions.table_captions(middle(spark, (1, pages)))) == [(1, 0, 0, "Table 1", 0.0, 0.0, 10.0, 8.0)]


def test_reconcile(spark):
    lines = [line(span("old a"), box=(0.0, 0.0, 10.0, 2.0)), line(span("old b"), box=(0.0, 4.0, 10.0, 6.0)), line(span("b again"), box=(0.0, 4.0, 10.0, 6.5))]
    df = middle(spark, (1, [page(block("text", (0.0, 0.0, 10.0, 10.0), lines))]))
    blocks = reconcile.layout_blocks(df)
    pdf = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 10.0, 2.0, "new a"), (1, 0, 1, 0.0, 4.0, 10.0, 6.0, "new b"), (1, 0, 2, 0.0, 2.5, 10.0, 3.5, "between"), (1, 0, 3, 50.0, 50.0, 60.0, 60.0, "nowhere")], "rec_id long, page_no int, pdf_line int, x0 double, y0 double, x1 double, y1 double, text string")
    assert reconcile.best_blocks(pdf, blocks).count() == 0  # each line covers less than half of the block
    low = reconcile.reconciled(pdf, blocks, least=0.1).orderBy("line_no").collect()
    assert [r["content"] for r in low][0] == "new a"
    assert [r["action"] for r in reconcile.line_actions(pdf, blocks, least=0.09).orderBy("pdf_line").collect()] == ["overwrite", "merge", "insert"]


def test_reconcile_block_sees_earlier_changes():
    stored = [{"box": [0, 0, 10, 2], "content": "a"}, {"box": [0, 4, 10, 6], "content": "b"}, {"box": [0, 4, 10, 6.5], "content": "c"}]
    new = [{"box": [0, 4, 10, 6], "content": "B"}, {"box": [0, 2.5, 10, 3.5], "content": "new"}, {"box": [0, 2.5, 10, 3.4], "content": "newer"}]
    assert [x["content"] for x in reconcile.reconcile_block(stored, new)] == ["a", "newer", "B"]


@pytest.mark.parametrize("least", [0.5])
def test_best_block_ties_go_to_the_earlier(spark, least):
    df = middle(spark, (1, [page(block("text", (0.0, 0.0, 10.0, 2.0)), block("text", (0.0, 0.0, 10.0, 2.0)))]))
    pdf = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 10.0, 2.0, "x")], "rec_id long, page_no int, pdf_line int, x0 double, y0 double, x1 double, y1 double, text string")
    assert rows(reconcile.best_blocks(pdf, reconcile.layout_blocks(df), least=least)) == [(1, 0, 0, 0, 1.0)]
