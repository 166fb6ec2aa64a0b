"""Lines of a PDF's text layer reconciled with the blocks and lines of its layout."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellumine.functions.geometry import box, iou, touches

_BOX = ["x0", "y0", "x1", "y1"]


def layout_blocks(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """``rec_id, page_no, block_no, x0, y0, x1, y1, lines`` of the blocks that have a whole box."""
    rows = middle.filter(F.col(key).isNotNull()).select(key, F.posexplode("pdf_info").alias("page_no", "page"))
    rows = rows.select(key, "page_no", F.posexplode("page.preproc_blocks").alias("block_no", "b"))
    at = [b.alias(n) for b, n in zip(box(F.col("b.bbox")), _BOX)]
    return rows.select(key, "page_no", "block_no", *at, F.col("b.lines").alias("lines")).dropna(subset=_BOX)


def layout_lines(blocks: DataFrame, key: str = "rec_id") -> DataFrame:
    """``rec_id, page_no, block_no, line_no, x0, y0, x1, y1, content`` of the lines of these blocks that have a whole box."""
    rows = blocks.select(key, "page_no", "block_no", F.posexplode("lines").alias("line_no", "l")).filter("l is not null")
    content = F.array_join(F.transform(F.coalesce("l.spans", F.expr("array()")), lambda s: s["content"]), " ")
    return rows.select(key, "page_no", "block_no", "line_no", *(b.alias(n) for b, n in zip(box(F.col("l.bbox")), _BOX)), content.alias("content")).dropna(subset=_BOX)


def best_blocks(pdf_lines: DataFrame, blocks: DataFrame, key: str = "rec_id", least: float = 0.5) -> DataFrame:
    """``rec_id, page_no, pdf_line, block_no, score``: of each PDF line the block that overlaps it most, by at least *least*.

    The join is on document and page; closed boxes that don't meet are sorted out before the exact measure. Ties go to
    the earlier block; lines without such a block are dropped.
    """
    l, b = pdf_lines.alias("l"), blocks.drop("lines").alias("b")
    a, c = [F.col(f"l.{x}") for x in _BOX], [F.col(f"b.{x}") for x in _BOX]
    met = l.join(b, (F.col(f"l.{key}") == F.col(f"b.{key}")) & (F.col("l.page_no") == F.col("b.page_no")) & touches(a, c))
    rated = met.select(F.col(f"l.{key}").alias(key), F.col("l.page_no").alias("page_no"), "l.pdf_line", "b.block_no", iou(a, c).alias("score")).filter(F.col("score") >= least)
    first = F.row_number().over(W.partitionBy(key, "page_no", "pdf_line").orderBy(F.desc("score"), "block_no"))
    return rated.withColumn("rank", first).filter("rank = 1").drop("rank")


def line_actions(pdf_lines: DataFrame, blocks: DataFrame, key: str = "rec_id", least: float = 0.5) -> DataFrame:
    """``rec_id, page_no, pdf_line, block_no, n_lines, action``: what the line does in its block, seen against the stored lines.

    One overlapping line: overwrite; several: merge into the first; none: insert.
    """
    chosen = best_blocks(pdf_lines, blocks, key, least).join(pdf_lines, [key, "page_no", "pdf_line"])
    own = layout_lines(blocks, key).select(key, "page_no", "block_no", "line_no", *(F.col(x).alias(f"l{x}") for x in _BOX))
    pair = chosen.join(own, [key, "page_no", "block_no"], "left")
    hit = F.coalesce(iou([F.col(x) for x in _BOX], [F.col(f"l{x}") for x in _BOX]) >= least, F.lit(False))
    counted = pair.groupBy(key, "page_no", "pdf_line", "block_no").agg(F.sum(hit.cast("long")).alias("n_lines"))
    return counted.withColumn("action", F.when(F.col("n_lines") == 0, "insert").when(F.col("n_lines") == 1, "overwrite").otherwise("merge"))


def _iou(a: list[float], b: list[float]) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    common = w * h
    return common / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - common)


def reconcile_block(stored: list[dict], new: list[dict], least: float = 0.5) -> list[dict]:
    """The lines of one block after the new ones came in their order; each sees the block as the ones before it left it."""
    lines = [dict(x) for x in stored]
    for x in new:
        line = {"box": list(x["box"]), "content": x["content"]}
        hits = [i for i, y in enumerate(lines) if _iou(x["box"], y["box"]) >= least]
        if hits:
            lines[hits[0]] = line
            for i in reversed(hits[1:]):
                del lines[i]
        else:
            at = next((i for i, y in enumerate(lines) if y["box"][1] > x["box"][1]), len(lines))
            lines.insert(at, line)
    return lines


def reconciled(pdf_lines: DataFrame, blocks: DataFrame, key: str = "rec_id", least: float = 0.5) -> DataFrame:
    """``rec_id, page_no, block_no, line_no, x0, y0, x1, y1, content``: all lines of the blocks after reconciliation.

    PDF lines change a block one after another, so this part runs block by block; a group is the lines of one block.
    """
    chosen = best_blocks(pdf_lines, blocks, key, least).join(pdf_lines, [key, "page_no", "pdf_line"])
    new = chosen.select(key, "page_no", "block_no", F.col("pdf_line").alias("no"), *_BOX, F.col("text").alias("content"), F.lit(True).alias("is_new"))
    old = layout_lines(blocks, key).select(key, "page_no", "block_no", F.col("line_no").alias("no"), *_BOX, "content", F.lit(False).alias("is_new"))

    def run(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no", kind="stable")
        rows = [{"box": list(b), "content": c, "new": n} for b, c, n in zip(pdf[_BOX].itertuples(index=False, name=None), pdf["content"], pdf["is_new"])]
        out = reconcile_block([r for r in rows if not r["new"]], [r for r in rows if r["new"]], least)
        return pd.DataFrame([(*ids, i, *r["box"], r["content"]) for i, r in enumerate(out)], columns=[key, "page_no", "block_no", "line_no", *_BOX, "content"])

    both = old.unionByName(new)
    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    schema = f"{key} {kinds[key]}, page_no int, block_no int, line_no int, x0 double, y0 double, x1 double, y1 double, content string"
    return both.groupBy(key, "page_no", "block_no").applyInPandas(run, schema)
