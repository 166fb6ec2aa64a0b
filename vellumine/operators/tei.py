"""Bibliographic records from TEI XML: header and references.

Scalars are read by XPath over guarded XML: a text that is not well formed gives a null record instead of failing the
job. Repeated elements (authors, references) are read as arrays of structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions.text import none_if_empty, strip

_NAME = "struct<forename:array<string>,surname:string>"
_AUTHOR = f"struct<persName:{_NAME}>"
HEADER_SHAPE = f"teiHeader struct<fileDesc:struct<sourceDesc:struct<biblStruct:struct<analytic:struct<author:array<{_AUTHOR}>>>>>>, _corrupt_record string"
REFERENCE_SHAPE = f"analytic struct<author:array<{_AUTHOR}>>"
# A reference and the list that holds it, as they stand in the text, at any depth; comments are taken out before.
_LIST = r"(?s)<(?:\w+:)?listBibl\b[^>]*(?<!/)>(.*?)</(?:\w+:)?listBibl\s*>"
_ONE = r"(?s)<(?:\w+:)?biblStruct\b(?:[^>]*/>|.*?</(?:\w+:)?biblStruct\s*>)"

# Names of the record's fields, in their order.
HEADER_FIELDS = [
    "authors", "title", "doi", "displayPublicationDate", "publisher", "contentTypeDisplay", "subType", "publicationTitle",
    "confLoc", "volume", "startPage", "endPage", "publicationDate", "publicationYear", "abstract",
]


def _full_names(authors: Column) -> Column:
    """Forenames and surname of each author joined by blanks; authors without any name are left out."""
    name = lambda a: strip(F.array_join(F.concat(F.coalesce(a["persName"]["forename"], F.array().cast("array<string>")), F.array(a["persName"]["surname"])), " "))
    return F.filter(F.transform(F.coalesce(authors, F.array().cast(f"array<{_AUTHOR}>")), name), lambda n: n != "")


_APART = "\x1f"


def header_record(xml: Column) -> Column:
    """The 15-field record of a TEI header; null for a text that is null or no well-formed XML. Empty values are null."""
    shape = F.from_xml(xml, HEADER_SHAPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    sound = xml.isNotNull() & shape["_corrupt_record"].isNull()
    first = "(//publicationStmt/{0} | //imprint/{0})[1]"
    scope = "(//monogr)[1]//biblScope[@unit='{}']"
    paths = {
        "title": "//titleStmt/title[@level='a'][@type='main']",
        "doi": "//idno[@type='DOI']",
        "date": first.format("date"),
        "when": first.format("date") + "/@when",
        "publisher": first.format("publisher"),
        "journal": "(//monogr)[1]/title[@level='j' or @level='m'][1]",
        "place": "(//monogr)[1]//meeting//addrLine | (//monogr)[1]//meeting//settlement",
        "volume": scope.format("volume"),
        "from": scope.format("page") + "/@from",
        "to": scope.format("page") + "/@to",
        "abstract": "//abstract",
    }

    def record(bound: Column) -> Column:
        at = {name: F.get(bound["values"], F.lit(i)) for i, name in enumerate(paths)}
        conference = at["place"] != ""
        fields = [
            F.array_join(_full_names(bound["authors"]), ", "),
            at["title"], at["doi"], at["date"], at["publisher"],
            F.when(conference, "Conferences").otherwise("Journals"), F.when(conference, "IEEE Conference").otherwise("IEEE Journal"),
            at["journal"], at["place"], at["volume"], at["from"], at["to"], at["date"],
            F.substring(F.coalesce(none_if_empty(at["when"]), at["date"]), 1, 4),
            strip(at["abstract"]),
        ]
        return F.struct(*(none_if_empty(f).alias(name) for f, name in zip(fields, HEADER_FIELDS)))

    authors = shape["teiHeader"]["fileDesc"]["sourceDesc"]["biblStruct"]["analytic"]["author"]
    once = F.array(F.struct(_values(xml, paths).alias("values"), authors.alias("authors")))  # bound, so that no field reads it anew
    return F.when(sound, F.get(F.transform(once, record), F.lit(0)))


def headers_of(documents: DataFrame, doc: str = "doc_id", xml: str = "tei_header") -> DataFrame:
    """``doc_id`` and the header fields; all fields are null for a missing or malformed header."""
    return documents.select(F.col(doc), header_record(F.col(xml)).alias("r")).select(doc, "r.*")


def _values(xml: Column, paths: dict[str, str]) -> Column:
    """The strings of all *paths* by one path, so that a text is parsed once; the separator cannot stand in XML."""
    return F.split(F.xpath_string(xml, F.lit("concat(" + f", '{_APART}', ".join(f"string({path})" for path in paths.values()) + ")")), _APART)


# Where a reference's values are: each path gives the first node in document order.
_REFERENCE_PATHS = {
    "title": "/*/analytic/title",
    "source": "/*/monogr/title",
    "volume": "//biblScope[@unit='volume']",
    "issue": "//biblScope[@unit='issue']",
    "from": "//biblScope[@unit='page']/@from",
    "to": "//biblScope[@unit='page']/@to",
    "when": "//date/@when",
    "date": "//date",
    "raw": "/*/note[@type='raw_reference']",
}


def references_of(documents: DataFrame, doc: str = "doc_id", xml: str = "tei_references") -> DataFrame:
    """``doc_id, ref_id, n, title, authors, source, volume, issue_no, pages, publication_year, raw_text``.

    The references are those of every list in the text, wherever it stands, numbered from 1 in document order; the title is
    the first analytic title. Pages need both ends; an absent value, or an empty one, is null. A document whose XML is
    null, malformed or without references gives no rows.
    """
    sound = F.from_xml(F.col(xml), "text string, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = documents.filter(F.col(xml).isNotNull()).select(F.col(doc), F.regexp_replace(xml, r"(?s)<!--.*?-->", "").alias("x"), sound["_corrupt_record"].isNull().alias("sound")).filter("sound")
    lists = F.regexp_extract_all("x", F.lit(_LIST), F.lit(1))
    rows = rows.select(doc, F.posexplode(F.flatten(F.transform(lists, lambda part: F.regexp_extract_all(part, F.lit(_ONE), F.lit(0))))).alias("i", "b"))
    names = _full_names(F.from_xml(F.col("b"), REFERENCE_SHAPE, {"mode": "PERMISSIVE"})["analytic"]["author"])
    rows = rows.select(doc, "i", names.alias("names"), _values(F.col("b"), _REFERENCE_PATHS).alias("v"))
    at = {name: F.get("v", F.lit(i)) for i, name in enumerate(_REFERENCE_PATHS)}
    return rows.select(
        doc,
        F.concat(F.lit("ref"), F.col("i") + 1).alias("ref_id"),
        (F.col("i") + 1).cast("long").alias("n"),
        none_if_empty(at["title"]).alias("title"),
        F.when(F.size("names") > 0, F.col("names")).alias("authors"),
        none_if_empty(at["source"]).alias("source"),
        none_if_empty(at["volume"]).alias("volume"),
        none_if_empty(at["issue"]).alias("issue_no"),
        F.when((at["from"] != "") & (at["to"] != ""), F.concat_ws("-", at["from"], at["to"])).alias("pages"),
        none_if_empty(F.substring(F.coalesce(none_if_empty(at["when"]), at["date"]), 1, 4)).alias("publication_year"),
        none_if_empty(at["raw"]).alias("raw_text"),
    )


def _escaped(text: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _element(name: str, text: Column, attributes: str = "") -> Column:
    """One element around *text*; nothing where it is null."""
    return F.when(text.isNotNull(), F.concat(F.lit(f"<{name}{attributes}>"), _escaped(text), F.lit(f"</{name}>"))).otherwise("")


def _person(name: Column) -> Column:
    """A name's last word as surname, the words before it as forenames."""
    words = F.split(strip(name), r"(?U)\s+")
    fore = F.array_join(F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w: _element("forename", w)), "")
    return F.concat(F.lit("<author><persName>"), fore, _element("surname", F.element_at(words, -1)), F.lit("</persName></author>"))


def header_xml(papers: DataFrame) -> Column:
    """A TEI header made from the columns of ``papers``, for services that are not at hand."""
    people = F.array_join(F.transform(F.split(F.coalesce("authors", F.lit("")), ", "), _person), "")
    pages = F.when(F.col("start_page").isNotNull() | F.col("end_page").isNotNull(), F.concat(F.lit('<biblScope unit="page"'), *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {a}="'), _escaped(F.col(c)), F.lit('"'))).otherwise("") for a, c in (("from", "start_page"), ("to", "end_page"))), F.lit("/>"))).otherwise("")
    when = F.when(F.col("publication_year").isNotNull(), F.concat(F.lit(' when="'), _escaped(F.col("publication_year")), F.lit('"'))).otherwise("")
    date = F.when(F.col("publication_date").isNotNull(), F.concat(F.lit("<date"), when, F.lit(">"), _escaped(F.col("publication_date")), F.lit("</date>"))).otherwise("")
    meeting = F.when(F.col("conf_loc").isNotNull(), F.concat(F.lit("<meeting>"), _element("settlement", F.col("conf_loc")), F.lit("</meeting>"))).otherwise("")
    return F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt>'), _element("title", F.col("title"), ' level="a" type="main"'),
        F.lit("</titleStmt><publicationStmt>"), _element("publisher", F.col("publisher")), date,
        F.lit("</publicationStmt><sourceDesc><biblStruct><analytic>"), F.when(F.col("authors").isNotNull(), people).otherwise(""),
        F.lit("</analytic><monogr>"), _element("title", F.col("publication_title"), ' level="j"'), meeting,
        F.lit("<imprint>"), _element("biblScope", F.col("volume"), ' unit="volume"'), pages, F.lit("</imprint></monogr>"),
        _element("idno", F.col("doi"), ' type="DOI"'), F.lit("</biblStruct></sourceDesc></fileDesc><profileDesc>"),
        _element("abstract", F.col("abstract_text")), F.lit("</profileDesc></teiHeader></TEI>"),
    )


def reference_xml(refs: DataFrame, doc: str = "paper_id") -> DataFrame:
    """``doc_id, tei_references``: a reference list for each document, made from the columns of ``ref_records``, in order of ref_key."""
    people = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), _person), "")
    lo, hi = F.split_part("pages", F.lit("-"), F.lit(1)), F.split_part("pages", F.lit("-"), F.lit(2))
    pages = F.when(F.col("pages").isNotNull(), F.concat(F.lit('<biblScope unit="page" from="'), _escaped(lo), F.lit('" to="'), _escaped(hi), F.lit('"/>'))).otherwise("")
    date = F.when(F.col("publication_year").isNotNull(), F.concat(F.lit('<date when="'), _escaped(F.col("publication_year")), F.lit('"/>'))).otherwise("")
    one = F.concat(
        F.lit("<biblStruct><analytic>"), _element("title", F.col("title"), ' level="a" type="main"'), people, F.lit("</analytic><monogr>"), _element("title", F.col("source"), ' level="j"'),
        F.lit("<imprint>"), _element("biblScope", F.col("volume"), ' unit="volume"'), _element("biblScope", F.col("issue_no"), ' unit="issue"'), pages, date,
        F.lit("</imprint></monogr>"), _element("note", F.col("raw_text"), ' type="raw_reference"'), F.lit("</biblStruct>"),
    )
    listed = refs.groupBy(F.col(doc).alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_key", one.alias("x")))), lambda s: s["x"]), "").alias("x"))
    return listed.select("doc_id", F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><back><div><listBibl>'), F.col("x"), F.lit("</listBibl></div></back></text></TEI>")).alias("tei_references"))
