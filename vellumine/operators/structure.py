"""From layout items to sections, paragraphs, equations, figures and tables.

Everything is a window over one document, so a plan shuffles once, by document. The tree of headings has two levels:
headings of the introduction's numbering are sections, all others between them subsections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellumine.functions import headings as H
from vellumine.functions import text as X

ITEM = ["type", "text", "text_level", "page_idx", "img_path", "img_caption", "table_caption", "table_body"]
#: What the outline, paragraphs and equations read; what figures and tables read besides.
TEXT = ["type", "text", "text_level"]
FIGURES, TABLES = [*TEXT, "img_caption", "img_path"], [*TEXT, "table_caption", "table_body"]


def _doc():
    return W.partitionBy("doc_id")


#: Reading order: the place and, of unlike rows at one place, a number made of what they say, so that the order is always the same.
ORDER = ["idx", "tie"]


def _read():
    return _doc().orderBy(*ORDER)


def _so_far():
    return _read().rowsBetween(W.unboundedPreceding, W.currentRow)


def items(content: DataFrame, doc: str = "paper_id", columns: list[str] | None = None) -> DataFrame:
    """Layout items ``doc_id, idx`` and ITEM *columns* (all, or those named), each row once; rows without document or place are left out.

    The shuffle by document comes first, so that dropping repeated rows and all later windows need no other. Name the
    columns that are read, so that no other is scanned or moved.
    """
    rows = content.filter(F.col(doc).isNotNull() & F.col("idx").isNotNull()).select(F.col(doc).alias("doc_id"), "idx", *(columns or ITEM))
    return rows.repartition("doc_id").distinct()


def outlined(rows: DataFrame) -> DataFrame:
    """The items with what the outline says of each row.

    ``stripped, is_header, prefix, format``; of the document ``intro_idx, intro_format, body_end``; ``is_node`` and
    ``is_section`` for headings in the body; ``node_idx, sec_no, sub_no, sec_id`` of the latest heading; ``in_text``
    where the row belongs to that heading's own text. A null text is an empty one.
    """
    base = rows.withColumns({"stripped": X.strip(F.coalesce("text", F.lit(""))), "is_header": F.coalesce((F.col("text_level") == 1) & F.col("type").contains("text"), F.lit(False)), "tie": F.xxhash64(*(c for c in rows.columns if c not in ("doc_id", "idx")))})
    base = base.withColumn("prefix", H.prefix(F.col("stripped"))).withColumn("format", H.prefix_format(F.col("prefix")))
    intro = F.min(F.when(F.col("is_header") & F.col("stripped").rlike("(?i)introduction"), F.struct("idx", "format"))).over(_doc())
    end = F.min(F.when(F.col("is_header") & F.col("stripped").rlike("(?i)references"), F.col("idx"))).over(_doc())
    base = base.withColumns({"intro": intro, "body_end": F.coalesce(end, F.max("idx").over(_doc()) + 1)})
    base = base.withColumns({"intro_idx": F.col("intro.idx"), "intro_format": F.col("intro.format")}).drop("intro")
    node = F.coalesce(F.col("is_header") & (F.col("idx") >= F.col("intro_idx")) & (F.col("idx") < F.col("body_end")), F.lit(False))
    base = base.withColumn("is_node", node).withColumn("is_section", F.col("is_node") & (F.col("format") == F.col("intro_format")))
    base = base.withColumns({"node_idx": F.last(F.when(F.col("is_node"), F.col("idx")), ignorenulls=True).over(_so_far()), "sec_no": F.sum(F.col("is_section").cast("int")).over(_so_far())})
    in_section = W.partitionBy("doc_id", "sec_no").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow)
    base = base.withColumn("sub_no", F.sum((F.col("is_node") & ~F.col("is_section")).cast("int")).over(in_section))
    stray = F.coalesce((F.col("text_level") == 1) & ~F.col("is_node"), F.lit(False)).cast("int")
    in_node = W.partitionBy("doc_id", "node_idx").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow)
    owned = F.col("node_idx").isNotNull() & ~F.col("is_node") & (F.col("idx") < F.col("body_end")) & (F.sum(stray).over(in_node) == 0)
    sec_id = F.when(F.col("sub_no") > 0, F.concat_ws(".", "sec_no", "sub_no")).otherwise(F.col("sec_no").cast("string"))
    return base.withColumns({"in_text": owned, "sec_id": F.when(F.col("node_idx").isNotNull(), sec_id)})


def headers(rows: DataFrame) -> DataFrame:
    """``doc_id, idx, title, prefix, format`` of all headings, front matter included."""
    title = X.strip(F.coalesce("text", F.lit("")))
    found = rows.filter((F.col("text_level") == 1) & F.col("type").contains("text")).select("doc_id", "idx", title.alias("title"))
    return found.withColumn("prefix", H.prefix(F.col("title"))).withColumn("format", H.prefix_format(F.col("prefix")))


def bounds(outline: DataFrame) -> DataFrame:
    """``doc_id, intro_idx, intro_format, body_end``, one row for each document; null where there is no introduction."""
    return outline.select("doc_id", "intro_idx", "intro_format", "body_end").distinct()


def sections(outline: DataFrame) -> DataFrame:
    """``doc_id, sec_id, sec_no, sub_no, idx, prefix, title, format, level, region_start, region_end`` in reading order of idx."""
    nodes = outline.filter("is_node").select("doc_id", *ORDER, "prefix", F.col("stripped").alias("title"), "format", "is_section", "body_end", "sec_no", "sub_no", "sec_id")
    after = F.lead("idx").over(_read())
    top = F.min(F.when(F.col("is_section"), F.col("idx"))).over(_read().rowsBetween(1, W.unboundedFollowing))
    last = F.coalesce(F.when(F.col("is_section"), top).otherwise(after), F.col("body_end")) - 1
    level = F.when(F.col("is_section"), H.DEPTH_NAMES[0]).otherwise(H.DEPTH_NAMES[1])
    return nodes.select("doc_id", "sec_id", F.col("sec_no").cast("long").alias("sec_no"), F.col("sub_no").cast("long").alias("sub_no"), "idx", "prefix", "title", "format", level.alias("level"), F.col("idx").alias("region_start"), last.alias("region_end"))


def walked(outline: DataFrame) -> DataFrame:
    """The rows of all sections' own texts, with ``para_id`` where a row is a paragraph and ``carried_para`` for equations."""
    own = outline.filter("in_text")
    is_para = F.coalesce(F.col("type").startswith("text"), F.lit(False)) & (F.col("stripped") != "")
    by_kind = W.partitionBy("doc_id", "node_idx", "is_para").orderBy(*ORDER)
    own = own.withColumn("is_para", is_para).withColumn("para_no", F.when(F.col("is_para"), F.row_number().over(by_kind)))
    own = own.withColumn("para_id", F.when(F.col("is_para"), F.concat(F.col("sec_id"), F.lit("_p"), F.col("para_no"))))
    return own.withColumn("carried_para", F.last("para_id", ignorenulls=True).over(_so_far()))


def paragraphs(outline: DataFrame) -> DataFrame:
    """``doc_id, para_id, sec_id, para_no, idx, text``; numbers start at 1 in each section."""
    return walked(outline).filter("is_para").select("doc_id", "para_id", "sec_id", F.col("para_no").cast("long").alias("para_no"), "idx", F.col("stripped").alias("text"))


def equations(outline: DataFrame) -> DataFrame:
    """``doc_id, eq_id, para_id, idx, raw_latex``: equations with the last paragraph before them, even of an earlier section.

    The number starts at 0 in each section, so ids may repeat. Without any paragraph before it an equation has none.
    """
    own = walked(outline).filter(F.col("type").startswith("equation") & (F.col("stripped") != ""))
    k = F.row_number().over(W.partitionBy("doc_id", "node_idx").orderBy(*ORDER)) - 1
    return own.select("doc_id", F.concat(F.col("carried_para"), F.lit("_eq"), k.cast("string")).alias("eq_id"), F.col("carried_para").alias("para_id"), "idx", F.col("stripped").alias("raw_latex"))


def paragraph_order(paras: DataFrame) -> DataFrame:
    """The paragraphs with ``rank``, the place in numeric order of section and paragraph (1 < 1.2 < 1.10 < 2)."""
    path = F.transform(F.split("sec_id", "[.]"), lambda x: x.cast("int"))
    return paras.withColumn("rank", F.row_number().over(_doc().orderBy(path, "para_no")).cast("long"))


def equation_order(eqs: DataFrame) -> DataFrame:
    """The equations with ``rank``, the place in plain order of their ids, ties in reading order."""
    return eqs.withColumn("rank", F.row_number().over(_doc().orderBy("eq_id", "idx", "raw_latex")).cast("long"))


def figures(outline: DataFrame, bounded: bool = True) -> DataFrame:
    """``doc_id, fig_id, fig_num, idx, caption, img_path`` of images before the body's end, or of all if not *bounded*."""
    return _numbered(outline, "image", "img_caption", "img_path", "fig", bounded)


def tables(outline: DataFrame, bounded: bool = True) -> DataFrame:
    """``doc_id, tab_id, tab_num, idx, caption, table_body``; see figures."""
    return _numbered(outline, "table", "table_caption", "table_body", "tab" if bounded else "table", bounded)


def _numbered(outline: DataFrame, kind: str, captions: str, extra: str, name: str, bounded: bool) -> DataFrame:
    rows = outline.filter((F.col("type") == kind) & F.col("intro_idx").isNotNull())
    if bounded:
        rows = rows.filter("idx < body_end")
    short = name[:3]
    rows = rows.withColumn(f"{short}_num", F.row_number().over(_read()).cast("long"))
    return rows.select("doc_id", F.concat(F.lit(name), F.col(f"{short}_num")).alias(f"{short}_id"), f"{short}_num", "idx", X.first_or_empty(F.col(captions)).alias("caption"), extra)


def formulae(paras: DataFrame) -> DataFrame:
    """``doc_id, para_id, n, cleaned, raw``: the inline formulas of the paragraphs, numbered from 0."""
    return paras.select("doc_id", "para_id", F.posexplode(X.formulae(F.col("text"))).alias("n", "f")).select("doc_id", "para_id", "n", "f.cleaned", "f.raw")


def region_content(outline: DataFrame, compat: bool = True) -> DataFrame:
    """``doc_id, sec_id, idx, text``: the text of each section for the tree form.

    *compat*: an item that is no text repeats the text row before it in its section (the empty text, after a blank
    one) and has a null text if there is none, which fails the document in tree form. Otherwise only text rows.
    """
    own = outline.filter("in_text").withColumn("is_text", F.coalesce(F.col("type").startswith("text"), F.lit(False)))
    if not compat:
        return own.filter("is_text and stripped <> ''").select("doc_id", "sec_id", "idx", F.col("stripped").alias("text"))
    last = F.last(F.when(F.col("is_text"), F.col("stripped")), ignorenulls=True).over(W.partitionBy("doc_id", "node_idx").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow))
    return own.withColumn("said", last).filter("not is_text or stripped <> ''").select("doc_id", "sec_id", "idx", F.col("said").alias("text"))


def body_text(outline: DataFrame, compat: bool = True) -> DataFrame:
    """``doc_id, section, subsection, n, text``: the tree form as rows; *subsection* is null for a section's own text.

    A subsection's key is the section's prefix, a dash and its title. Of sections with one title the last one counts,
    as of subsections with one key in a section; *n* is the 0-based place in the text of its heading.
    """
    nodes = outline.filter("is_node").select("doc_id", "sec_no", "sub_no", "sec_id", "idx", "stripped", "prefix", "is_section")
    of = W.partitionBy("doc_id", "sec_no")
    nodes = nodes.withColumns({"section": F.max(F.when(F.col("is_section"), F.col("stripped"))).over(of), "sec_prefix": F.max(F.when(F.col("is_section"), F.col("prefix"))).over(of)})
    nodes = nodes.withColumn("subsection", F.when(~F.col("is_section"), F.concat_ws(" - ", "sec_prefix", "stripped")))
    last_section = F.max("sec_no").over(W.partitionBy("doc_id", "section")) == F.col("sec_no")
    last_sub = F.max("sub_no").over(W.partitionBy("doc_id", "sec_no", "subsection")) == F.col("sub_no")
    kept = nodes.withColumns({"a": last_section, "b": last_sub}).filter("a and b").select("doc_id", "sec_id", "section", "subsection")
    text = region_content(outline, compat)
    n = F.row_number().over(W.partitionBy("doc_id", "sec_id").orderBy("idx", "text")) - 1
    return text.withColumn("n", n.cast("long")).join(kept, ["doc_id", "sec_id"]).select("doc_id", "section", "subsection", "n", "text")


def errors(outline: DataFrame) -> DataFrame:
    """``doc_id, error_code, tree_error_code``, one row for each document, null where it can be parsed.

    NO_INTRODUCTION: no heading tells where the body begins. EQ_BEFORE_PARA: an equation stands before the first
    paragraph of the body. NONTEXT_BEFORE_TEXT (tree form only): a section's text begins with another kind of item.
    """
    early = walked(outline).filter(F.col("type").startswith("equation") & F.col("carried_para").isNull()).select("doc_id").distinct().withColumn("eq_early", F.lit(True))
    mute = region_content(outline).filter("text is null").select("doc_id").distinct().withColumn("mute", F.lit(True))
    docs = bounds(outline).join(early, "doc_id", "left").join(mute, "doc_id", "left")
    flat = F.when(F.col("intro_idx").isNull(), "NO_INTRODUCTION").when(F.col("eq_early"), "EQ_BEFORE_PARA")
    tree = F.when(F.col("intro_idx").isNull(), "NO_INTRODUCTION").when(F.col("mute"), "NONTEXT_BEFORE_TEXT")
    return docs.select("doc_id", flat.alias("error_code"), tree.alias("tree_error_code"))
