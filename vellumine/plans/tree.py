"""The tree form of a document: body text by titles, figures and tables by names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.functions import text as X
from vellumine.operators import structure as S


def body_tree(outline: DataFrame) -> DataFrame:
    """``doc_id, body``: map of section title to heading, text and map of subsections; failed documents are left out.

    Keys are unique before the maps are made (the last of equal titles counts), so no setting of the session matters.
    """
    fine = S.errors(outline).filter("tree_error_code is null").select("doc_id")
    entry = F.struct("n", F.struct("text", X.formulae(F.col("text")).alias("formulae")).alias("v"))
    texts = S.body_text(outline).groupBy("doc_id", "section", "subsection").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"]).alias("text"))
    nodes = S.sections(outline).join(fine, "doc_id", "left_semi")
    tops = nodes.filter("sub_no = 0").select("doc_id", "sec_no", "prefix", F.col("title").alias("section"))
    tops = tops.groupBy("doc_id", "section").agg(F.max("sec_no").alias("sec_no"), F.min("sec_no").alias("first"), F.max_by("prefix", "sec_no").alias("prefix"))
    subs = nodes.filter("sub_no > 0").select("doc_id", "sec_no", "sub_no", "title").join(tops, ["doc_id", "sec_no"])
    subs = subs.withColumn("subsection", F.concat_ws(" - ", "prefix", "title")).groupBy("doc_id", "section", "subsection").agg(F.min("sub_no").alias("at"), F.max_by("title", "sub_no").alias("title"))
    own = texts.filter("subsection is not null")
    subs = subs.join(own, ["doc_id", "section", "subsection"], "left")
    none = F.array().cast(texts.schema["text"].dataType)
    sub = F.struct("at", F.struct(F.col("subsection").alias("key"), F.struct(F.col("title").alias("heading"), F.coalesce("text", none).alias("text")).alias("value")).alias("e"))
    subs = subs.groupBy("doc_id", "section").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(sub)), lambda x: x["e"])).alias("subsections"))
    whole = tops.join(texts.filter("subsection is null").drop("subsection"), ["doc_id", "section"], "left").join(subs, ["doc_id", "section"], "left")
    value = F.struct(F.col("section").alias("heading"), F.coalesce("text", none).alias("text"), F.coalesce("subsections", F.create_map().cast(subs.schema["subsections"].dataType)).alias("subsections"))
    one = F.struct("first", F.struct(F.col("section").alias("key"), value.alias("value")).alias("e"))
    return whole.groupBy("doc_id").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(one), lambda a, b: (a["first"] - b["first"]).cast("int")), lambda x: x["e"])).alias("body"))


def figures_and_tables(outline: DataFrame) -> DataFrame:
    """``doc_id, name, caption, num, content`` of all images and tables, those after the references included."""
    figs = S.figures(outline, bounded=False).select("doc_id", F.col("fig_id").alias("name"), "caption", F.col("fig_num").alias("num"), F.col("img_path").alias("content"))
    tabs = S.tables(outline, bounded=False).select("doc_id", F.col("tab_id").alias("name"), "caption", F.col("tab_num").alias("num"), F.col("table_body").alias("content"))
    return figs.unionByName(tabs)
