"""Reference lists of a service and of a page, and the service calls."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

from tests.conftest import rows
from vellumine.operators import reference_lists as L
from vellumine.sources import providers as P

TEXT = 'A. Bee and C. Dee, "A title," <em>J. Test</em>, vol. 12, no. 3, pp. 45-67, 2011.'


def test_rest(spark):
    answer = {"references": [{"id": "b1", "text": TEXT, "title": "T", "articleNumber": "7", "links": {"documentLink": "/7"}}, {"id": "b2", "text": None, "links": {"documentLink": "/8"}}, None]}
    docs = spark.createDataFrame([(1, json.dumps(answer)), (2, "no json"), (3, None), (4, "{}"), (5, '{"references": []}')], "doc_id long, answer string")
    got = rows(L.rest_references(docs), "doc_id", "ref_id", "title", "authors", "source", "pages", "publication_year", "article_number", "document_link")
    assert got == [(1, "b1", "T", ["A. Bee", "C. Dee"], "J. Test", "45-67", "2011", "7", "/7"), (1, "b2", None, [""], "", None, "", None, None)]
    assert L.rest_references(docs.limit(0)).count() == 0


PAGE = f"""<html><body><div class="x reference-container"><div class="number"><b> 1. </b></div><div class="row col"><span>no</span><div>A. Bee, "Old" <br> vol. 1</div></div></div>
<div class="reference-container"><div class="number"><b>2</b></div><p>no text</p></div><div class="reference-container"><div class="col"><div>no number</div></div></div>
<div class="reference-container"><div class="number"><b>1.</b></div><div class="col"><div>{TEXT} \\$x\\$ &amp;</div></div></div><div class="reference-container"><div class="number"><b>3"""


def test_html(spark):
    docs = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<<<>>> </div> <div class=>")], "doc_id long, html string")
    got = rows(L.html_references(docs), "doc_id", "ref_id", "n", "title", "authors", "source", "volume", "pages", "raw_text")
    assert got == [(1, "ref1", 1, "A title,", ["A. Bee", "C. Dee"], "J. Test", "12", "45-67", 'A. Bee and C. Dee, "A title," J. Test , vol. 12, no. 3, pp. 45-67, 2011. &')]
    assert L.html_references(docs.limit(0)).count() == 0


class _Service(BaseHTTPRequestHandler):
    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        good = b"%PDF" in body and b"application/xml" == self.headers["Accept"].encode()
        self.send_response(200 if good else 400)
        self.end_headers()
        self.wfile.write(b"<TEI>" + (b"header" if b'name="consolidateHeader"' in body else b"refs") + b"</TEI>" if good else b"")

    def do_GET(self):
        self.send_response(200 if self.path == "/document/7" else 404)
        self.end_headers()
        self.wfile.write(b'{"references": []}')

    def log_message(self, *args):
        pass


def test_services(spark):
    server = HTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        docs = spark.createDataFrame([("a", b"%PDF-1"), ("b", b"no")], "doc_id string, content binary")
        got = rows(P.metadata_service(f"{url}/h", f"{url}/r").apply(docs))
        assert got == [("a", "<TEI>header</TEI>", "<TEI>refs</TEI>", None), ("b", None, None, "HTTPError")]
        numbers = spark.createDataFrame([("a", b"7"), ("b", b"8")], "doc_id string, content binary")
        assert rows(P.references_service(lambda n, base=url: f"{base}/document/{n}").apply(numbers)) == [("a", '{"references": []}', None), ("b", None, "HTTPError")]
    finally:
        server.shutdown()
