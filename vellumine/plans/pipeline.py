"""Whole documents: structure, header and references merged into one record, with a status for each document.

Nothing raises for a bad document: what would stop a program becomes an error code, and the status routes the document.
ok: structure and metadata; partial: structure only; failed: no structure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellumine.functions import text as X
from vellumine.operators import structure as S
from vellumine.operators import tei


def _listed(rows: DataFrame, name: str, order: list[str | Column], fields: dict[str, str]) -> DataFrame:
    """``doc_id`` and an array of structs, sorted by *order*."""
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    one = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)), F.struct(*(F.col(c).alias(n) for n, c in fields.items())).alias("v"))
    return rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["v"]).alias(name))


def flat_schema(items: DataFrame) -> DataFrame:
    """``doc_id, sections, paragraphs, equations, figures, tables``: the flat product of each document that can be parsed.

    Each row of the outline is marked with what it is in the product, and one grouping gathers all five lists, on the
    partitioning by document that the items came with: one scan, one shuffle. It gives what the operators of
    ``structure`` give one by one.
    """
    doc, node = W.partitionBy("doc_id").orderBy(*S.ORDER), W.partitionBy("doc_id", "node_idx").orderBy(*S.ORDER)
    so_far = lambda w: w.rowsBetween(W.unboundedPreceding, W.currentRow)
    count = lambda what, w: F.sum(F.when(what, 1).otherwise(0)).over(so_far(w))
    rows = S.outlined(items)
    own, starts = F.col("in_text"), lambda kind: F.coalesce(F.col("type").startswith(kind), F.lit(False))
    filled, inside = F.col("stripped") != "", F.col("intro_idx").isNotNull() & (F.col("idx") < F.col("body_end"))
    rows = rows.withColumns({"is_para": own & starts("text") & filled, "is_eq": own & starts("equation") & filled, "is_fig": inside & (F.col("type") == "image"), "is_tab": inside & (F.col("type") == "table")})
    rows = rows.withColumn("para_no", count(F.col("is_para"), node))
    rows = rows.withColumn("para_id", F.last(F.when(F.col("is_para"), F.concat("sec_id", F.lit("_p"), "para_no")), ignorenulls=True).over(so_far(doc)))
    rows = rows.withColumns({"eq_no": count(F.col("is_eq"), node) - 1, "fig_no": count(F.col("is_fig"), doc), "tab_no": count(F.col("is_tab"), doc)})
    path = F.transform(F.split("sec_id", "[.]"), lambda x: x.cast("int"))
    eq_id = F.concat("para_id", F.lit("_eq"), F.col("eq_no").cast("string"))
    lists = {
        "sections": ("is_node", S.ORDER, {"sec_id": F.col("sec_id"), "title": F.col("stripped")}),
        "paragraphs": ("is_para", [path, "para_no"], {"para_id": F.col("para_id"), "sec_id": F.col("sec_id"), "text": F.col("stripped")}),
        "equations": ("is_eq", [eq_id, *S.ORDER], {"eq_id": eq_id, "para_id": F.col("para_id"), "raw_latex": F.col("stripped")}),
        "figures": ("is_fig", ["fig_no"], {"fig_id": F.concat(F.lit("fig"), "fig_no"), "caption": X.first_or_empty(F.col("img_caption"))}),
        "tables": ("is_tab", ["tab_no"], {"tab_id": F.concat(F.lit("tab"), "tab_no"), "caption": X.first_or_empty(F.col("table_caption"))}),
    }
    gathered = []
    for name, (what, order, fields) in lists.items():
        keys = [(F.col(o) if isinstance(o, str) else o).alias(f"k{i}") for i, o in enumerate(order)]
        one = F.struct(*keys, F.struct(*(c.alias(n) for n, c in fields.items())).alias("v"))
        gathered.append(F.transform(F.array_sort(F.collect_list(F.when(F.col(what), one))), lambda x: x["v"]).alias(name))
    early = F.max(own & starts("equation") & F.col("para_id").isNull()).alias("early")
    whole = rows.groupBy("doc_id").agg(*gathered, F.max(F.col("intro_idx")).alias("intro_idx"), early)
    return whole.filter(F.col("intro_idx").isNotNull() & ~F.col("early")).select("doc_id", *lists)


def references_list(references: DataFrame) -> DataFrame:
    """``doc_id, refs``: each document's references in order, under the record's own field names."""
    names = {"ref_id": "ref_id", "title": "title", "authors": "authors", "source": "source", "volume": "volume", "issue no.": "issue_no", "pages": "pages", "publication year": "publication_year", "raw text": "raw_text"}
    return _listed(references, "refs", ["n"], names)


def merged(documents: DataFrame, flat: DataFrame) -> DataFrame:
    """``doc_id, status, header, refs`` and the lists of *flat* for ``documents(doc_id, tei_header, tei_references)``.

    A header or reference list that is null or malformed leaves the document partial, without either.
    """
    head = documents.select("doc_id", tei.header_record(F.col("tei_header")).alias("header"), F.col("tei_references").isNotNull().alias("has_refs"))
    refs = references_list(tei.references_of(documents))
    all_ = head.join(flat, "doc_id", "left").join(refs, "doc_id", "left")
    known = F.col("header").isNotNull() & F.col("has_refs") & F.col("refs").isNotNull()
    status = F.when(F.col("sections").isNull(), "failed").when(known, "ok").otherwise("partial")
    none = lambda name: F.when(known, F.col(name))
    return all_.withColumn("status", status).select("doc_id", "status", none("header").alias("header"), none("refs").alias("refs"), "sections", "paragraphs", "equations", "figures", "tables")


def as_json(whole: DataFrame) -> DataFrame:
    """``doc_id, status, json``: the record as one flat JSON object, nulls kept; failed documents have none."""
    parts = F.struct(F.col("header.*"), "sections", "paragraphs", "equations", "figures", "tables", F.col("refs").alias("bibliographical references"))
    only = F.struct("sections", "paragraphs", "equations", "figures", "tables")
    keep = {"ignoreNullFields": "false"}
    text = F.when(F.col("status") == "ok", F.to_json(parts, keep)).when(F.col("status") == "partial", F.to_json(only, keep))
    return whole.select("doc_id", "status", text.alias("json"))


def failures(whole: DataFrame, errors: DataFrame, files: DataFrame) -> DataFrame:
    """``doc_id, file_name, stage, error_code`` of the documents that are not ok; *files* has ``doc_id, file_name``.

    The stage is parse for failed documents (NO_ITEMS where there are none) and metadata for partial ones.
    """
    bad = whole.filter("status <> 'ok'").select("doc_id", "status").join(errors.select("doc_id", "error_code"), "doc_id", "left").join(files, "doc_id", "left")
    stage = F.when(F.col("status") == "failed", "parse").otherwise("metadata")
    code = F.when(F.col("status") == "failed", F.coalesce("error_code", F.lit("NO_ITEMS"))).otherwise("NO_METADATA")
    return bad.select("doc_id", "file_name", stage.alias("stage"), code.alias("error_code"))


def to_retry(documents: DataFrame, failed: DataFrame, partial_too: bool = False) -> DataFrame:
    """The documents that failed to parse, and those without metadata if *partial_too*."""
    again = failed if partial_too else failed.filter("stage = 'parse'")
    return documents.join(again.select("doc_id"), "doc_id", "left_semi")


def latest(papers: DataFrame, key: str = "paper_id", at: str = "ingested_at") -> DataFrame:
    """One row for each key: the last one ingested; of equals the greatest row by its JSON text."""
    row = F.struct(F.col(at).alias("a"), F.to_json(F.struct("*")).alias("j"), F.struct("*").alias("r"))
    order = F.struct(F.col("x.a"), F.col("x.j"))
    return papers.filter(F.col(key).isNotNull()).select(F.col(key).alias("key__"), row.alias("x")).groupBy("key__").agg(F.max_by("x.r", order).alias("r")).select("r.*")
