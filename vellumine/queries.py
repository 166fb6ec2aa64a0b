"""The queries of the operators outside the llm subpackage; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.functions import headings as H
from vellumine.functions import references as R
from vellumine.functions import text as X
from vellumine.functions import latex
from vellumine.operators import captions, cleaning, layout_tree, reconcile, reference_lists, tei
from vellumine.operators import structure as S
from vellumine.plans import pipeline, tree
from vellumine.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_tree.layout_places(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def p1_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_tree.layout_spans(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def p1_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_tree.layout_blocks(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def p1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_tree.layout_lines(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def p1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_tree.layout_pages(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def _items(spark: SparkSession, sf_dir: str, columns: list[str] = S.TEXT) -> DataFrame:
    return S.items(table(spark, sf_dir, "content_list"), columns=columns)


def _outline(spark: SparkSession, sf_dir: str, columns: list[str] = S.TEXT) -> DataFrame:
    return S.outlined(_items(spark, sf_dir, columns))


_FLAT = [*S.TEXT, "img_caption", "table_caption"]


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headers(_items(spark, sf_dir))


def format_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).groupBy("format").agg(F.count("*").alias("n"))


def level_of_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).select("doc_id", "idx", H.level_of_format(F.col("format")).alias("level"))


def document_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bounds(_outline(spark, sf_dir))


def docs_without_intro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_bounds(spark, sf_dir).filter("intro_idx is null").select("doc_id")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sections(_outline(spark, sf_dir))


def depth_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = F.when(F.col("sub_no") > 0, 1).otherwise(0)
    return sections(spark, sf_dir).groupBy(depth.alias("depth"), H.depth_label(depth).alias("label")).agg(F.count("*").alias("n"))


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.paragraphs(_outline(spark, sf_dir))


def paragraphs_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.paragraph_order(paragraphs(spark, sf_dir)).select("doc_id", "para_id", "rank")


def para_per_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs(spark, sf_dir).groupBy("doc_id", "sec_id").agg(F.count("*").alias("n_paragraphs"), F.sum(F.length("text")).alias("n_chars"))


def equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.equations(_outline(spark, sf_dir))


def equations_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.equation_order(equations(spark, sf_dir).filter("eq_id is not null")).select("doc_id", "eq_id", "idx", "rank")


def document_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.errors(_outline(spark, sf_dir))


def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.figures(_outline(spark, sf_dir, S.FIGURES))


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tables(_outline(spark, sf_dir, S.TABLES))


def figures_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.figures(_outline(spark, sf_dir, S.FIGURES), bounded=False)


def tables_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tables(_outline(spark, sf_dir, S.TABLES), bounded=False)


def formulae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.formulae(paragraphs(spark, sf_dir))


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = paragraphs(spark, sf_dir).select("doc_id", F.explode(X.citations(F.col("text"))).alias("number"))
    return cited.groupBy("doc_id", "number").agg(F.count("*").alias("n"))


def region_content_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.region_content(_outline(spark, sf_dir))


def region_content_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.region_content(_outline(spark, sf_dir), compat=False)


def body_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.body_text(_outline(spark, sf_dir))


def reference_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "ref_records", ["ref_key", "raw_text"]).filter("raw_text is not null").distinct()
    parsed = raw.select("ref_key", R.details(F.col("raw_text")).alias("d"))
    return parsed.select("ref_key", F.array_join("d.authors", "; ").alias("authors"), "d.title", "d.source", "d.year", "d.volume", "d.issue", "d.pages")


def reference_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "ref_records", ["ref_key", "raw_text"]).filter("raw_text is not null").distinct()
    return raw.select("ref_key", F.posexplode(R.authors(F.col("raw_text"))).alias("n", "author"))


def reference_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "ref_records", ["ref_key", "raw_text"]).filter("raw_text is not null").distinct()
    return raw.select("ref_key", X.reference_text(F.col("raw_text")).alias("clean"))


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.latest(table(spark, sf_dir, "papers"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, tei_header, tei_references`` made from papers and ref_records."""
    papers = _papers(spark, sf_dir)
    refs = table(spark, sf_dir, "ref_records").distinct()
    return papers.select(F.col("paper_id").alias("doc_id"), tei.header_xml(papers).alias("tei_header")).join(tei.reference_xml(refs), "doc_id", "left")


def _text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "content_list", ["item_id", "type", "text"]).filter("text is not null").distinct()


def tei_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = _papers(spark, sf_dir)
    return tei.headers_of(papers.select(F.col("paper_id").alias("doc_id"), tei.header_xml(papers).alias("tei_header")))


def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tei_header(spark, sf_dir).groupBy("contentTypeDisplay", "subType").agg(F.count("*").alias("n"))


def tei_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = tei.references_of(tei.reference_xml(table(spark, sf_dir, "ref_records").distinct()))
    return refs.withColumn("authors", F.array_join("authors", "; "))


def rest_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service answers made from ref_records, read back."""
    refs = table(spark, sf_dir, "ref_records").distinct()
    one = F.struct("ref_key", F.struct(F.col("ref_id").alias("id"), F.col("raw_text").alias("text"), "title", F.col("article_number").alias("articleNumber"), F.struct(F.col("document_link").alias("documentLink")).alias("links")).alias("r"))
    listed = refs.groupBy(F.col("paper_id").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["r"]).alias("references"))
    answers = listed.select("doc_id", F.to_json(F.struct("references")).alias("answer"))
    return reference_lists.rest_references(answers).withColumn("authors", F.array_join("authors", "; "))


def html_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages made from ref_records, read back."""
    refs = table(spark, sf_dir, "ref_records", ["ref_key", "paper_id", "raw_text"]).filter("raw_text is not null").distinct()
    box = F.concat(F.lit('<div class="reference-container"><div class="number"><b>'), F.col("ref_key").cast("string"), F.lit('.</b></div><div class="col"><div>'), F.replace("raw_text", F.lit("&"), F.lit("&amp;")), F.lit("</div></div></div>"))
    pages = refs.groupBy(F.col("paper_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_key", box.alias("x")))), lambda s: s["x"]), "<br>").alias("html"))
    return reference_lists.html_references(pages).withColumn("authors", F.array_join("authors", "; "))


def caption_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.image_captions(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def caption_images_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a condition on the caption's beginning, which the captions of the test tables don't meet."""
    return captions.image_captions(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]), begins="")


def caption_images_the(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a beginning that some captions of the test tables have."""
    return captions.image_captions(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]), begins="The ")


def caption_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.table_captions(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))


def _blocks_and_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The layout's blocks and, as a PDF's lines, their own lines moved a little: each third one by half its height."""
    blocks = reconcile.layout_blocks(table(spark, sf_dir, "middle_json", ["rec_id", "pdf_info"]))
    lines = reconcile.layout_lines(blocks)
    shift = F.when(F.col("line_no") % 3 == 2, (F.col("y1") - F.col("y0")) * 0.5).otherwise(1.0)
    moved = lines.select("rec_id", "page_no", (F.col("block_no") * 1000 + F.col("line_no")).alias("pdf_line"), "x0", (F.col("y0") + shift).alias("y0"), "x1", (F.col("y1") + shift).alias("y1"), F.col("content").alias("text"))
    return moved, blocks


def best_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reconcile.best_blocks(*_blocks_and_lines(spark, sf_dir))
    return found.select("rec_id", "page_no", "pdf_line", "block_no", F.round("score", 6).alias("score"))


def line_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.line_actions(*_blocks_and_lines(spark, sf_dir))


def reconciled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconciled(*_blocks_and_lines(spark, sf_dir))


def bad_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _items(spark, sf_dir)
    return cleaning.bad_entries(_with_boilerplate(rows))


def _with_boilerplate(rows: DataFrame) -> DataFrame:
    """The items with a publisher's line put in place of each text whose place ends in 5, since the tables have none."""
    put = (F.col("idx") % 10 == 5) & (F.col("type") == "text") & (F.coalesce("text_level", F.lit(0)) == 0)
    return rows.withColumn("text", F.when(put, F.concat(F.lit("© 2011 IEEE. Manuscript received, no. "), F.col("idx"))).otherwise(F.col("text")))


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaned(_with_boilerplate(_items(spark, sf_dir)))


def cleaned_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaned_isolated(_with_boilerplate(_items(spark, sf_dir)))


def plain_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).select("item_id", X.plain_blanks(F.col("text")).alias("plain"))


def html_to_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit("H<sub>2</sub>O <sup class='x'>+</sup><b>"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("</b>"))
    return _text_rows(spark, sf_dir).select("item_id", X.html_to_marks(marked).alias("marked"))


def unfold_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter("type = 'equation'").select("item_id", X.unfold_malformed(F.concat(F.lit(r"a \over b \tag{(3)} & "), "text")).alias("unfolded"))


def restore_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).select("item_id", X.restore_commands(F.col("text")).alias("restored"))


def math_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter("type = 'equation'").select("item_id", X.tidy_latex(X.math_to_text(F.col("text"))).alias("plain"))


def compact_latex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter("type = 'equation'").select("item_id", X.compact_latex(F.col("text")).alias("compact"))


def squeeze_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter("type = 'equation'").select("item_id", X.squeeze_commands(F.col("text")).alias("squeezed"))


def latex_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter("type = 'equation'").select("item_id", latex.latex_to_text(F.col("text")).alias("plain"))


def cleaned_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_rows(spark, sf_dir).filter(F.instr("text", "$") > 0).select("item_id", latex.cleaned_inline(F.col("text")).alias("clean"))


def flat_schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = pipeline.flat_schema(_items(spark, sf_dir, _FLAT))
    return flat.select("doc_id", *(F.size(c).cast("long").alias(f"n_{c}") for c in ("sections", "paragraphs", "equations", "figures", "tables")))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.merged(_documents(spark, sf_dir), pipeline.flat_schema(_items(spark, sf_dir, _FLAT)))


def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("doc_id", "status")


def merged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _merged(spark, sf_dir)
    return whole.select("doc_id", "status", "header.title", "header.doi", F.coalesce(F.size("refs"), F.lit(0)).cast("long").alias("n_refs"), F.coalesce(F.size("paragraphs"), F.lit(0)).cast("long").alias("n_paragraphs"))


def merged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.as_json(_merged(spark, sf_dir))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _papers(spark, sf_dir).select(F.col("paper_id").alias("doc_id"), "file_name")
    return pipeline.failures(_merged(spark, sf_dir), S.errors(_outline(spark, sf_dir)), names)


def failure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir)


def retry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _papers(spark, sf_dir).select(F.col("paper_id").alias("doc_id"), "file_name")
    return pipeline.to_retry(names, _failures(spark, sf_dir))


def body_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.body_tree(_outline(spark, sf_dir)).select("doc_id", F.to_json("body").alias("body"))


def figures_and_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.figures_and_tables(_outline(spark, sf_dir, [*S.FIGURES, *S.TABLES[3:]]))


_STRUCTURE: list[Query] = [
    headers, format_histogram, level_of_format, document_bounds, docs_without_intro, sections, depth_labels, paragraphs, paragraphs_ordered, para_per_section,
    equations, equations_ordered, document_errors, figures, tables, figures_unbounded, tables_unbounded, formulae, citations,
    region_content_compat, region_content_text, body_text_rows, reference_details, reference_authors, reference_text,
]
_OTHER: list[Query] = [
    tei_header, content_types, tei_references, rest_references, html_references, caption_images, caption_images_any, caption_images_the, caption_tables, best_blocks, line_actions, reconciled_lines,
    bad_entries, cleaned_documents, cleaned_isolated, plain_blanks, html_to_marks, unfold_malformed, restore_commands, math_to_text, compact_latex,
    squeeze_commands, latex_to_text, cleaned_inline, flat_schema_counts, document_status, merged_documents, merged_json, failure_report, retry_list,
    body_tree, figures_and_tables,
]
_P1: list[Query] = [p1_found, p1_spans, p1_blocks, p1_lines, p1_pages]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in [*_P1, *_STRUCTURE, *_OTHER]}
