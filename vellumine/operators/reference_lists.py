"""Reference lists as a web service or a web page gives them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellumine.functions import references as R
from vellumine.functions.text import none_if_empty, reference_text

REST_SHAPE = "struct<references:array<struct<id:string,text:string,title:string,articleNumber:string,links:struct<documentLink:string>>>>"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def rest_references(answers: DataFrame, doc: str = "doc_id", answer: str = "answer") -> DataFrame:
    """``doc_id, n, ref_id`` and the record's fields from a service's JSON answer for each document.

    The title is the service's, all else is read from the text. The link is given only with an article number. An answer
    that is null, malformed or without references gives no rows.
    """
    rows = answers.select(F.col(doc), F.posexplode(F.from_json(F.col(answer), REST_SHAPE)["references"]).alias("n", "r")).filter("r is not null")
    d = R.details(F.coalesce("r.text", F.lit("")))
    named = none_if_empty(F.col("r.articleNumber"))
    return rows.select(doc, F.col("n").cast("long").alias("n"), F.col("r.id").alias("ref_id"), F.col("r.title").alias("title"), d.alias("d"), F.col("r.text").alias("raw_text"), named.alias("article_number"), F.when(named.isNotNull(), F.col("r.links.documentLink")).alias("document_link")).select(
        doc, "n", "ref_id", "title", "d.authors", "d.source", "d.volume", F.col("d.issue").alias("issue_no"), "d.pages", F.col("d.year").alias("publication_year"), "raw_text", "article_number", "document_link"
    )


class _Tree(HTMLParser):
    """A page as nested lists [tag, classes, children], texts as strings; tags that are left open end with their parent."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root: list = ["", set(), []]
        self.path = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = [tag, set((dict(attrs).get("class") or "").split()), []]
        self.path[-1][2].append(node)
        if tag not in _VOID:
            self.path.append(node)

    def handle_startendtag(self, tag, attrs):
        self.path[-1][2].append([tag, set((dict(attrs).get("class") or "").split()), []])

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, 0, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                break

    def handle_data(self, data):
        self.path[-1][2].append(data)


def _below(node: list, tag: str, name: str | None = None) -> Iterator[list]:
    """The elements below a node of a tag (and class), in document order."""
    todo = [x for x in reversed(node[2]) if not isinstance(x, str)]
    while todo:
        x = todo.pop()
        if x[0] == tag and (name is None or name in x[1]):
            yield x
        todo.extend(y for y in reversed(x[2]) if not isinstance(y, str))


def _texts(node: list) -> Iterator[str]:
    for x in node[2]:
        if isinstance(x, str):
            if x.strip():
                yield x.strip()
        else:
            yield from _texts(x)


def listed(page: str) -> list[tuple[str, str, str | None]]:
    """(number, text, emphasised text) of each reference container that has both a number and a text."""
    out = []
    for box in _below(_Tree(page).root, "div", "reference-container"):
        number = next((b for d in _below(box, "div", "number") for b in _below(d, "b")), None)
        text = next((x for d in _below(box, "div", "col") for x in d[2] if not isinstance(x, str) and x[0] == "div"), None)
        if number is not None and text is not None:
            em = next(_below(text, "em"), None)
            out.append(("".join(_texts(number)).rstrip("."), " ".join(_texts(text)), None if em is None else "".join(_texts(em))))
    return out


def html_references(pages: DataFrame, doc: str = "doc_id", page: str = "html") -> DataFrame:
    """``doc_id, ref_id, n`` and the record's fields from the page with a document's references.

    Only the page itself is taken apart in Python; its texts are read by the JVM. The source is the emphasised text; of
    references with one number the last counts; *n* is the place in the page. Null pages give no rows.
    """
    kind = pages.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, i, *r) for d, html in zip(pdf[doc], pdf[page]) for i, r in enumerate(listed(html))]
            yield pd.DataFrame(rows, columns=[doc, "n", "number", "raw", "em"])

    found = pages.filter(F.col(page).isNotNull()).select(doc, page).mapInPandas(run, f"{doc} {kind}, n long, number string, raw string, em string")
    last = F.row_number().over(W.partitionBy(doc, "number").orderBy(F.desc("n")))
    kept = found.withColumn("nth", last).filter("nth = 1").withColumn("raw_text", reference_text(F.col("raw")))
    d = R.details(F.col("raw_text"))
    return kept.select(doc, "n", F.concat(F.lit("ref"), "number").alias("ref_id"), d.alias("d"), "em", "raw_text").select(
        doc, "ref_id", "n", "d.title", "d.authors", F.col("em").alias("source"), "d.volume", F.col("d.issue").alias("issue_no"), "d.pages", F.col("d.year").alias("publication_year"), "raw_text"
    )
