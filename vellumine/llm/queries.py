"""The queries of the problems that prepare text for language models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine.llm import confusables, leaks, mixing, names, ocr, quality, site_lines
from vellumine.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(names.linked(table(spark, sf_dir, "ref_records", ["authors", "source"])))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked(table(spark, sf_dir, "ref_records", ["authors", "source"]))


def _scans(spark: SparkSession, sf_dir: str) -> ocr.Scans:
    return ocr.Scans(
        {
            "content_list": (table(spark, sf_dir, "content_list", ["item_id", "type", "text_level", "text"]), "item_id"),
            "paragraphs": (table(spark, sf_dir, "paragraphs", ["para_key", "text"]), "para_key"),
        }
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scans(spark, sf_dir).damaged()


def p3_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scans(spark, sf_dir).emissions()


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scans(spark, sf_dir).repaired()


def _looked_at(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str, str]]:
    fields = (("content_list", "item_id", "text"), ("ref_records", "ref_key", "raw_text"))
    return {name: (table(spark, sf_dir, name, [key, text]), key, text) for name, key, text in fields}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.lookalikes(_looked_at(spark, sf_dir))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.look_groups(_looked_at(spark, sf_dir))


def p4_one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, (rows, key, text) in _looked_at(spark, sf_dir).items():
        forms = confusables.one_form(rows, text)
        forms = forms.select(F.lit(name).alias("tbl"), F.col(key).cast("long").alias("key"), "look")
        out = forms if out is None else out.unionByName(forms)
    return out


_CONTENT = ["item_id", "paper_id", "source", "type", "text", "text_level"]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.site_lines(table(spark, sf_dir, "content_list", _CONTENT))


def p5_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_site_lines(table(spark, sf_dir, "content_list", _CONTENT))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.site_line_report(table(spark, sf_dir, "content_list", _CONTENT))


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "eval_items", ["item_id", "item_text"]))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_leaks(spark, sf_dir).filter("kind = 'exact'").select("doc_id", "item_id")


def p6_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_items(p6_leaks(spark, sf_dir))


def _mix(spark: SparkSession, sf_dir: str) -> mixing.Mixer:
    return mixing.Mixer(table(spark, sf_dir, "documents", ["doc_id", "text", "source"]), table(spark, sf_dir, "mix_targets"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir).unreachable()


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir).shares()


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir).mixed()


def p8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]), table(spark, sf_dir, "common_words"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(p8_quality(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and "_" in name and name[1].isdigit()}
