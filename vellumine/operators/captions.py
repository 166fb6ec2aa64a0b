"""Captions matched to the images and tables of their page.

A page's images, tables and captions are gathered as arrays of one row, and each caption takes the least struct of
distance and order, so matching needs neither a join nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions.geometry import box, weighted_distance


def _whole(b: Column) -> Column:
    """Whether a block has a box of four numbers."""
    return (F.size(b["bbox"]) >= 4) & ~F.exists(F.slice(b["bbox"], 1, 4), lambda x: x.isNull())


def caption_text(b: Column) -> Column:
    """The contents of all spans of a block, in order, joined by blanks; null ones are left out."""
    spans = F.flatten(F.transform(F.filter(b["lines"], lambda x: x.isNotNull() & x["spans"].isNotNull()), lambda x: F.transform(x["spans"], lambda s: s["content"])))
    return F.coalesce(F.array_join(spans, " "), F.lit(""))


def _typed(blocks: Column, kind: str) -> Column:
    return F.filter(blocks, lambda b: F.coalesce(b["type"] == kind, F.lit(False)))


def _nested(blocks: Column, kind: str) -> Column:
    """The sub-blocks of a kind in the image blocks, each with the bounds and lines of its own."""
    subs = F.transform(F.filter(_typed(blocks, "image"), lambda b: b["blocks"].isNotNull()), lambda b: _typed(b["blocks"], kind))
    return F.flatten(subs)


def _captions(blocks: Column) -> Column:
    return F.transform(F.filter(blocks, _whole), lambda b: F.struct(b["bbox"].alias("bbox"), caption_text(b).alias("caption")))


def pages_of(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """``rec_id, page_no, blocks``, one row for each distinct page that is not null; null blocks are dropped."""
    rows = middle.filter(F.col(key).isNotNull()).select(key, F.posexplode("pdf_info").alias("page_no", "page")).filter("page is not null")
    return rows.select(key, "page_no", F.filter(F.coalesce("page.preproc_blocks", F.expr("array()").cast(rows.schema["page"].dataType["preproc_blocks"].dataType)), lambda b: b.isNotNull()).alias("blocks"))


def _matched(pages: DataFrame, key: str, captions: Column, targets: Column, wx: float, right_of: bool) -> DataFrame:
    """``key, page_no, caption_no, caption, target``: the nearest target of each caption; the earliest of equals."""
    with_targets = pages.select(key, "page_no", targets.alias("targets"), F.posexplode(captions).alias("caption_no", "c"))

    def rated(t: Column, i: Column) -> Column:
        far = weighted_distance(box(F.col("c.bbox")), box(t["bbox"]), wx, 1)
        ok = F.get(t["bbox"], F.lit(0)) < F.get(F.col("c.bbox"), F.lit(0)) if right_of else F.lit(True)
        return F.when(ok, F.struct(far.alias("far"), i.alias("order"), t.alias("t")))

    best = F.array_min(F.filter(F.transform("targets", rated), lambda x: x.isNotNull()))
    return with_targets.select(key, "page_no", "caption_no", "c.caption", best.alias("best")).filter("best is not null").select(key, "page_no", "caption_no", "caption", "best.t")


def image_captions(middle: DataFrame, key: str = "rec_id", begins: str = "Fig") -> DataFrame:
    """``rec_id, page_no, caption_no, caption, image_path``: captions that begin with Fig (*begins*), with the nearest image.

    Captions stand in image blocks or on the page; an image must begin left of its caption (strictly); horizontal
    offsets weigh five times. An image's path is that of its first line's first span. A caption without such an
    image is dropped; an image may have several captions. Blocks without a whole box take no part.
    """
    b = F.col("blocks")
    found = _captions(F.concat(_nested(b, "image_caption"), F.transform(_typed(b, "image_caption"), lambda x: F.struct(x["type"].alias("type"), x["bbox"].alias("bbox"), x["lines"].alias("lines")))))
    captions = F.filter(found, lambda c: c["caption"].startswith(begins))
    path = lambda x: F.get(F.get(x["lines"], F.lit(0))["spans"], F.lit(0))["image_path"]
    images = F.transform(F.filter(_nested(b, "image_body"), _whole), lambda x: F.struct(x["bbox"].alias("bbox"), path(x).alias("image_path")))
    return _matched(pages_of(middle, key), key, captions, images, 5, True).select(key, "page_no", "caption_no", "caption", "t.image_path").distinct()


def table_captions(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """``rec_id, page_no, caption_no, caption, x0, y0, x1, y1``: captions of the page with the box of the nearest table.

    Horizontal offsets weigh three times; there is no condition on sides.
    """
    b = F.col("blocks")
    boxes = F.transform(F.filter(_typed(b, "table"), _whole), lambda x: F.struct(x["bbox"].alias("bbox")))
    found = _matched(pages_of(middle, key), key, _captions(_typed(b, "table_caption")), boxes, 3, False)
    at = [F.get("t.bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return found.select(key, "page_no", "caption_no", "caption", *at).distinct()
