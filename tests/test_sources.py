"""Files, providers, the landing stream, and the entry points."""

import json
import os

import duckdb
import pytest

from tests.conftest import rows
from vellumine import cli
from vellumine.sources import files
from vellumine.sources.providers import BatchProvider, TableProvider
from vellumine.streaming import landing

DOC = [{"type": "text", "text": "1 Introduction", "text_level": 1}, {"type": "text", "text": "Hello ü."}, {"type": "image", "img_caption": ["Fig. 1"]}]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a_content_list.json").write_text(json.dumps(DOC, indent=2), encoding="utf-8")
    (tmp_path / "in/b_content_list.json").write_text("no json", encoding="utf-8")
    return tmp_path


def test_content_lists(spark, folder):
    got = rows(files.content_lists(spark, f"{folder}/in"), "doc_id", "idx", "type", "text", "img_caption")
    assert got == [("a", 0, "text", "1 Introduction", None), ("a", 1, "text", "Hello ü.", None), ("a", 2, "image", None, ["Fig. 1"])]
    assert rows(files.unreadable(spark, f"{folder}/in")) == [("b", "MALFORMED_JSON")]


def test_pdf_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.pdf", "b.PDF", "c.txt", "sub/d.pdf"):
        (tmp_path / name).write_bytes(b"x")
    names = lambda df: [os.path.basename(r["path"]) for r in df.orderBy("path").collect()]
    assert names(files.pdf_files(spark, str(tmp_path))) == ["a.pdf"]
    assert names(files.pdf_files(spark, str(tmp_path), recursive=True)) == ["a.pdf", "d.pdf"]
    assert names(files.pdf_paths(spark, [str(tmp_path / n) for n in ("a.pdf", "b.PDF", "c.txt")])) == ["a.pdf", "b.PDF"]


def test_work_list_and_failures(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps([{"pdf_path": f"{i}.pdf", "x": 1} for i in range(12)]))
    assert [r["pdf_path"] for r in files.work_list(spark, f"{tmp_path}/w.json", 10).collect()] == [f"{i}.pdf" for i in range(10)]
    assert files.work_list(spark, f"{tmp_path}/w.json").count() == 12
    (tmp_path / "f.json").write_text(json.dumps({"a.pdf": "/x/a.pdf"}))
    assert rows(files.failure_maps(spark, f"{tmp_path}/f.json")) == [("a.pdf", "/x/a.pdf")]


def test_write_each(spark, tmp_path):
    df = spark.createDataFrame([("a/b", '{"x": "ü"}'), ("c", None)], "doc_id string, json string")
    assert files.write_each(df, str(tmp_path / "out")).count() == 1
    assert json.loads((tmp_path / "out/a_b.json").read_text(encoding="utf-8")) == {"x": "ü"}


def test_settled_tables_and_sweep(spark):
    from vellumine.sources import settled, sweep

    sweep(spark)
    df = settled(spark.range(5).selectExpr("id", "id * 2 as b"), columns=["b"])
    assert df.columns == ["b"] and rows(df) == [(0,), (2,), (4,), (6,), (8,)]
    assert "parquet" in df._jdf.queryExecution().optimizedPlan().toString() and sweep(spark) == 1 and sweep(spark) == 0


def test_providers(spark):
    docs = spark.createDataFrame([("a", b"xy"), ("b", b"")], "doc_id string, content binary")
    got = BatchProvider(lambda: lambda c: {"n": 1 // len(c)}, "n long").apply(docs)
    assert rows(got) == [("a", 0, None), ("b", None, "ZeroDivisionError")]
    stored = spark.createDataFrame([("a", 7)], "doc_id string, n long")
    assert rows(TableProvider(stored).apply(docs)) == [("a", 7, None), ("b", None, None)]


def test_landing_stream(spark, folder):
    query = landing.parse_into(landing.landing(spark, f"{folder}/in"), f"{folder}/p", f"{folder}/s", f"{folder}/c")
    query.awaitTermination(120)
    assert rows(spark.read.parquet(f"{folder}/p"), "doc_id", "para_id", "text") == [("a", "1_p1", "Hello ü.")]
    assert rows(spark.read.parquet(f"{folder}/s"), "doc_id", "error_code") == [("a", None), ("b", "MALFORMED_JSON")]


def test_command_line(spark, folder):
    cli.main([f"{folder}/in", "-o", f"{folder}/out"])
    record = json.loads((folder / "out/predictions/a.json").read_text(encoding="utf-8"))
    assert [p["text"] for p in record["paragraphs"]] == ["Hello ü."] and record["figures"] == [{"fig_id": "fig1", "caption": "Fig. 1"}]
    report = rows(spark.read.json(f"{folder}/out/failures"), "doc_id", "stage", "error_code")
    assert report == [("a", "metadata", "NO_METADATA"), ("b", "read", "MALFORMED_JSON")]


def pdf(info: bytes, trailer: bytes = b"trailer << /Root 1 0 R /Info 2 0 R >>") -> bytes:
    return b"%PDF-1.5\n1 0 obj << /Type /Catalog >> endobj\n2 0 obj << " + info + b" >> endobj\n" + trailer + b"\nstartxref 0\n%%EOF"


def test_pdf_information(spark):
    import zlib

    from vellumine.sources.pdf_info import article_id, article_ids, information

    assert information(pdf(rb"/Title (A \(small\) \344\n(nested) one) /IEEE#20Article#20ID (5937123) /Trapped /False")) == {"Title": "A (small) ä\n(nested) one", "IEEE Article ID": "5937123", "Trapped": "False"}
    assert information(pdf(b"/Title <FEFF00E40062>")) == {"Title": "äb"}
    body = zlib.compress(b"7 0 2 4 << >><< /IEEE#20Article#20ID (42) >>")
    packed = b"%PDF-1.5\n9 0 obj << /Type /ObjStm /N 2 /First 8 /Filter /FlateDecode >> stream\n" + body + b"\nendstream endobj\n8 0 obj << /Type /XRef /Info 2 0 R >> stream\nx\nendstream endobj"
    assert article_id(packed) == "42" and article_id(pdf(b"/Title (x)")) is None and article_id(b"no pdf") is None and article_id(b"") is None
    docs = spark.createDataFrame([("a", pdf(b"/IEEE#20Article#20ID (7)")), ("b", b"\x00"), ("c", None)], "doc_id string, content binary")
    assert rows(article_ids().apply(docs)) == [("a", "7", None), ("b", None, None), ("c", None, None)]


def test_text_layer(spark):
    from vellumine.sources.providers import text_layer

    docs = spark.createDataFrame([("a", b"x"), ("b", b"")], "doc_id string, content binary")
    got = text_layer(lambda: lambda c: c + b"+" if c else 1 / 0).apply(docs)
    assert sorted((r[0], None if r[1] is None else bytes(r[1]), r[2]) for r in got.collect()) == [("a", b"x+", None), ("b", None, "ZeroDivisionError")]


def test_metadata_command(spark, tmp_path):
    import http.server
    import threading

    from tests.test_cleaning import HEADER, NS

    class Service(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            answer = (HEADER if "Header" in self.path else f"{NS}<text><listBibl><biblStruct><monogr><title>J</title></monogr></biblStruct></listBibl></text></TEI>").encode()
            self.send_response(500 if b"bad" in body else 200)
            self.end_headers()
            self.wfile.write(answer)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.pdf").write_bytes(b"good")
    (tmp_path / "in/two.pdf").write_bytes(b"bad")
    cli.main(["metadata", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--url", f"http://127.0.0.1:{server.server_port}", "-q"])
    server.shutdown()
    got = spark.read.parquet(str(tmp_path / "out/metadata"))
    assert rows(got.selectExpr("doc_id", "header.title", "refs[0].source")) == [("one.pdf", "My Title", "J"), ("two.pdf", None, None)]
    assert rows(spark.read.json(str(tmp_path / "out/failures")), "title", "provider_error") == [("two.pdf", "HTTPError")]
    assert {r["step"] for r in spark.read.json(str(tmp_path / "out/timing")).collect()} == {"service", "records", "failures"}


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_queries_agree_with_their_sql(spark):
    from vellumine.oracle import oracle_sql
    from vellumine.queries import queries

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    flat = lambda v: round(v, 6) if isinstance(v, float) else v
    made, sql = queries(), oracle_sql()
    assert set(sql) <= set(made)
    for name, text in sql.items():
        df = made[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted((tuple(flat(r[c]) for c in cols) for r in df.collect()), key=repr)
        result = con.execute(text)
        at = [[x[0] for x in result.description].index(c) for c in cols]
        wanted = sorted((tuple(flat(r[i]) for i in at) for r in result.fetchall()), key=repr)
        assert got == wanted, name


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_only_columns_that_are_read_are_scanned(spark):
    from vellumine.queries import queries

    plan = queries()["paragraphs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<paper_id:bigint,idx:int,type:string,text:string,text_level:int>" in plan and plan.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(paper_id), IsNotNull(idx)]" in plan


def test_entry_imports_without_the_optional_part():
    import __spark_entry__ as e

    assert "p1_found" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
