"""Files in, files out: documents by path, JSON arrays with their order, one JSON file for each document, work lists."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_SCHEMA = "array<struct<type:string,text:string,text_level:int,page_idx:int,img_path:string,img_caption:array<string>,table_caption:array<string>,table_body:string>>"
_LINE = "struct<bbox:array<double>,spans:array<struct<bbox:array<double>,content:string,type:string,score:double,image_path:string>>>"
MIDDLE_SCHEMA = f"struct<pdf_info:array<struct<preproc_blocks:array<struct<type:string,bbox:array<double>,lines:array<{_LINE}>,blocks:array<struct<type:string,bbox:array<double>,lines:array<{_LINE}>>>>>>>>"
PDF_LINES_SCHEMA = "struct<Lines:array<struct<bbox:array<double>,text:string>>>"


def pdf_files(spark: SparkSession, directory: str, recursive: bool = False, content: bool = True) -> DataFrame:
    """``path, length, content`` of the files named *.pdf (in this case) in a directory, or below it if *recursive*."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", str(recursive).lower()).load(directory)
    return df.select("path", "length", *(["content"] if content else []))


def pdf_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files of an explicit list whose names end in .pdf in any case; directories give the files in them, sorted by path."""
    df = spark.read.format("binaryFile").load(paths)
    return df.filter(F.lower("path").endswith(".pdf")).select("path", "length", "content").orderBy("path")


def _named(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    name = F.regexp_extract("_metadata.file_name", r"^(.*?)(?:_content_list|_middle)?\.json$", 1)
    return raw.select(name.alias("doc_id"), "value")


def content_lists(spark: SparkSession, path: str) -> DataFrame:
    """Layout items of content-list JSON files: ``doc_id, idx`` and the item columns, in the order of the arrays.

    A file that is no such JSON gives no items; ``unreadable`` lists it.
    """
    rows = _named(spark, path).select("doc_id", F.posexplode(F.from_json("value", ITEM_SCHEMA)).alias("idx", "i"))
    return rows.filter("i is not null").select("doc_id", "idx", "i.*")


def unreadable(spark: SparkSession, path: str, schema: str = ITEM_SCHEMA) -> DataFrame:
    """``doc_id, error_code`` of the files that hold no JSON of this shape."""
    return _named(spark, path).filter(F.from_json("value", schema).isNull()).select("doc_id", F.lit("MALFORMED_JSON").alias("error_code"))


def middle_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, pdf_info`` of layout-geometry JSON files."""
    return _named(spark, path).select("doc_id", F.from_json("value", MIDDLE_SCHEMA).alias("m")).select("doc_id", "m.pdf_info")


def pdf_line_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, page_no, pdf_line, x0, y0, x1, y1, text`` of line dumps, which are those of the first page."""
    rows = _named(spark, path).select("doc_id", F.posexplode(F.from_json("value", PDF_LINES_SCHEMA)["Lines"]).alias("pdf_line", "l"))
    box = [F.get("l.bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select("doc_id", F.lit(0).alias("page_no"), "pdf_line", *box, F.col("l.text").alias("text"))


def write_each(rows: DataFrame, directory: str, name: str = "doc_id", text: str = "json") -> DataFrame:
    """One file ``<name>.json`` for each row, written by the tasks to a folder that all executors share; gives ``path, bytes``.

    The write happens when the result is read. A file is replaced as a whole, so a task may be repeated.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        os.makedirs(directory, exist_ok=True)
        for pdf in batches:
            out = []
            for n, t in zip(pdf[name], pdf[text]):
                if t is None:
                    continue
                path = os.path.join(directory, f"{str(n).replace(os.sep, '_')}.json")
                part = f"{path}.{uuid.uuid4().hex}"
                with open(part, "w", encoding="utf-8") as f:
                    f.write(t)
                os.replace(part, path)
                out.append((path, len(t.encode())))
            yield pd.DataFrame(out, columns=["path", "bytes"])

    return rows.select(name, text).mapInPandas(run, "path string, bytes long")


def work_list(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """``idx, pdf_path`` of a JSON array of objects with a pdf_path, in order; the first *most* of them if given."""
    shape = T._parse_datatype_string("array<struct<pdf_path:string>>")
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", shape)).alias("idx", "i")).select("idx", "i.pdf_path")
    return rows.orderBy("idx").limit(most) if most is not None else rows


def failure_maps(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, path`` of a failure report, a JSON object of names and paths."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("file_name", "path"))
