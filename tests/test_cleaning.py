"""The boilerplate fold and TEI records."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vellumine.operators import cleaning, tei

CASES = [
    (["We show that", "© 2011 IEEE", "gain rises."], ["We show that gain rises."], None),
    (["Done.", "© 2011 IEEE", "gain rises."], ["Done.", "gain rises."], None),
    (["We show", "© 2011 IEEE", "2011 IEEE x", "gain."], ["gain."], None),
    (["© 2011 IEEE", "gain."], [], "BAD_ENTRY_NO_NEIGHBOUR"),
    (["ab\ncd"], ["abcd"], None),
    ([None, "x"], ["", "x"], None),
    ([], [], None),
]


@pytest.mark.parametrize("texts, wanted, error", CASES)
def test_fold(texts, wanted, error):
    is_bad = lambda t: "IEEE" in t
    rows_ = [{"type": "text", "text": t or "", "text_level": None, "bad": is_bad(t or ""), "clean": (t or "").replace("\n", "")} for t in texts]
    out, code = cleaning.fold(rows_)
    assert ([r["text"] for r in out if not is_bad(r["text"])], code) == (wanted, error)


def items(spark):
    data = [(d, i, "text", t, None) for d, (texts, _, _) in enumerate(CASES) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, idx int, type string, text string, text_level int")


def test_cleaned_by_document(spark):
    got = cleaning.cleaned(items(spark)).orderBy("doc_id", "idx").collect()
    for d, (_, wanted, error) in enumerate(CASES):
        own = [r for r in got if r["doc_id"] == d]
        assert [r["text"] for r in own if r["error_code"] is None] == wanted and {r["error_code"] for r in own} <= {None, error}
    assert cleaning.cleaned(items(spark).limit(0)).count() == 0


def test_isolated_agrees_with_the_fold(spark):
    some = items(spark).filter("doc_id in (0, 1, 4)")
    assert rows(cleaning.cleaned_isolated(some)) == rows(cleaning.cleaned(some), "doc_id", "idx", "text")


NS = '<TEI xmlns="http://www.tei-c.org/ns/1.0">'
HEADER = (
    NS + '<teiHeader><fileDesc><titleStmt><title level="a" type="main">My Title</title></titleStmt><publicationStmt><publisher>P</publisher><date when="2020-01-02">Jan 2020</date></publicationStmt>'
    "<sourceDesc><biblStruct><analytic><author><persName><forename>A</forename><forename>B</forename><surname>C</surname></persName></author><author><persName><forename>D</forename><surname>E</surname></persName></author>"
    '<author><email>x</email></author></analytic><monogr><title level="j">J</title><imprint><biblScope unit="volume">7</biblScope><biblScope unit="page" from="1" to="5"/><date when="2019">2019</date></imprint></monogr>'
    '<idno type="DOI">10.1/x</idno></biblStruct></sourceDesc></fileDesc><profileDesc><abstract> Hello w </abstract></profileDesc></teiHeader></TEI>'
)


def test_header(spark):
    r = spark.range(1).select(tei.header_record(F.lit(HEADER)).alias("r")).select("r.*").first().asDict()
    assert r == {
        "authors": "A B C, D E", "title": "My Title", "doi": "10.1/x", "displayPublicationDate": "Jan 2020", "publisher": "P", "contentTypeDisplay": "Journals", "subType": "IEEE Journal", "publicationTitle": "J",
        "confLoc": None, "volume": "7", "startPage": "1", "endPage": "5", "publicationDate": "Jan 2020", "publicationYear": "2020", "abstract": "Hello w",
    }


def test_malformed_and_missing_xml(spark):
    docs = spark.createDataFrame([(1, None), (2, "<a>"), (3, ""), (4, HEADER)], "doc_id long, tei_header string")
    assert rows(tei.headers_of(docs), "doc_id", "title") == [(1, None), (2, None), (3, None), (4, "My Title")]


def test_references(spark):
    one = (
        '<biblStruct><analytic><title level="a">Sub</title><title level="a" type="main">Main</title><author><persName><surname>S</surname></persName></author></analytic><monogr><title>J</title><title>K</title>'
        '<imprint><biblScope unit="volume">2</biblScope><biblScope unit="issue">3</biblScope><biblScope unit="page" from="4"/><date>1999-05</date></imprint></monogr><note type="raw_reference">raw &amp; more</note></biblStruct>'
    )
    two = '<biblStruct xml:id="b1"><monogr><title>Book <hi>Two</hi></title><imprint><date type="x"/><date when="2001-02">May</date><biblScope unit="page" from="1" to="9"/></imprint></monogr></biblStruct>'
    head = "<teiHeader><fileDesc><sourceDesc><biblStruct><analytic><title>Own</title></analytic></biblStruct></sourceDesc></fileDesc></teiHeader>"
    xml = f"{NS}{head}<text><body><p>x</p></body><back><div type='a'><listBibl>{one}<!-- <biblStruct/> --></listBibl></div><div type='b'><div><listBibl n='2'>{two}<biblStruct/></listBibl></div></div></back></text></TEI>"
    docs = spark.createDataFrame([(1, xml), (2, None), (3, "<x"), (4, NS + "</TEI>"), (5, f"{NS}<text><listBibl>{one}</text></TEI>"), (6, f"<t:TEI xmlns:t='u'><t:listBibl/><t:listBibl></t:listBibl></t:TEI>")], "doc_id long, tei_references string")
    got = rows(tei.references_of(docs), "doc_id", "ref_id", "title", "authors", "source", "volume", "issue_no", "pages", "publication_year", "raw_text")
    assert got == [
        (1, "ref1", "Sub", ["S"], "J", "2", "3", None, "1999", "raw & more"),
        (1, "ref2", None, None, "Book Two", None, None, "1-9", "2001", None),
        (1, "ref3", None, None, None, None, None, None, None, None),
    ]
