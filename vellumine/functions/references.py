"""Fields of a formatted reference string, as expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumine.functions.text import none_if_empty


def authors(text: Column) -> Column:
    """The names before the first quotation mark, split at commas and 'and'; [''] if there is none."""
    return F.split(F.regexp_extract(text, r'(?s)^([^\n\r]*?),\s*"', 1), r",\s+and\s+| and |, ")


def source(text: Column) -> Column:
    return F.regexp_extract(text, r"<em>(.*?)</em>", 1)


def title(text: Column) -> Column:
    return none_if_empty(F.regexp_extract(text, r'"([^"]+)"', 1))


def year(text: Column) -> Column:
    """The first number that looks like a year, be it a page; empty if there is none."""
    return F.regexp_extract(text, r"\b(19|20)\d{2}\b", 0)


def volume(text: Column) -> Column:
    return none_if_empty(F.regexp_extract(text, r"(?i)vol\.\s*(\d+)", 1))


def issue(text: Column) -> Column:
    return none_if_empty(F.regexp_extract(text, r"(?i)no\.\s*(\d+)", 1))


def pages(text: Column) -> Column:
    both = F.regexp_extract(text, r"(?i)pp\.\s*(\d+-\d+)", 1)
    one = F.regexp_extract(text, r"(?i)pp\.\s*(\d+)", 1)
    return F.coalesce(none_if_empty(both), none_if_empty(one))


def details(text: Column) -> Column:
    """All fields as one struct."""
    return F.struct(
        authors(text).alias("authors"), title(text).alias("title"), source(text).alias("source"), year(text).alias("year"),
        volume(text).alias("volume"), issue(text).alias("issue"), pages(text).alias("pages"),
    )
