"""What runs outside the engine (layout model, OCR, metadata service, PDF properties, reference service) behind one protocol.

A provider turns rows with ``doc_id, content`` into rows with ``doc_id`` and its own columns, by Arrow batches; it is
made once in each Python worker. Where a service's results were stored before, a TableProvider joins them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Provider(Protocol):
    """Adds the columns of *schema* to documents."""

    schema: str

    def apply(self, documents: DataFrame) -> DataFrame: ...


@dataclass
class BatchProvider:
    """Calls a model or service: *make* builds, once for a worker, a function of one document's bytes to one dict or none."""

    make: Callable[[], Callable[[bytes], dict | None]]
    schema: str
    doc_type: str = "string"

    def apply(self, documents: DataFrame) -> DataFrame:
        names = [part.strip().split(" ")[0] for part in self.schema.split(", ")]
        make = self.make

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            call = make()
            for pdf in batches:
                rows = []
                for doc, content in zip(pdf["doc_id"], pdf["content"]):
                    try:
                        got, error = call(content) or {}, None
                    except Exception as e:  # a document that fails is routed, not raised
                        got, error = {}, type(e).__name__
                    rows.append((doc, *(got.get(n) for n in names), error))
                yield pd.DataFrame(rows, columns=["doc_id", *names, "provider_error"])

        return documents.select("doc_id", "content").mapInPandas(run, f"doc_id {self.doc_type}, {self.schema}, provider_error string")


@dataclass
class TableProvider:
    """Results stored in a table with ``doc_id`` and the provider's columns."""

    stored: DataFrame
    schema: str = ""

    def apply(self, documents: DataFrame) -> DataFrame:
        return documents.select("doc_id").join(self.stored, "doc_id", "left").withColumn("provider_error", F.lit(None).cast("string"))


def post_pdf(content: bytes, endpoint: str, consolidate: str, timeout: int = 120) -> str:
    """Posts a document to a metadata service as a multipart form with one switch set to 1; gives the XML it answers.

    Raises on an HTTP error or after *timeout* seconds; within a BatchProvider that becomes the document's error.
    """
    import urllib.request
    import uuid

    mark = uuid.uuid4().hex
    head = f'--{mark}\r\nContent-Disposition: form-data; name="{consolidate}"\r\n\r\n1\r\n--{mark}\r\nContent-Disposition: form-data; name="input"; filename="doc.pdf"\r\nContent-Type: application/pdf\r\n\r\n'
    body = head.encode() + content + f"\r\n--{mark}--\r\n".encode()
    request = urllib.request.Request(endpoint, body, {"Content-Type": f"multipart/form-data; boundary={mark}", "Accept": "application/xml"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def metadata_service(header_url: str, references_url: str, doc_type: str = "string") -> BatchProvider:
    """``tei_header, tei_references`` of each document, by two requests with the document's bytes read once."""

    def make() -> Callable[[bytes], dict]:
        return lambda content: {"tei_header": post_pdf(content, header_url, "consolidateHeader"), "tei_references": post_pdf(content, references_url, "includeRawCitations")}

    return BatchProvider(make, "tei_header string, tei_references string", doc_type)


def references_service(url_of: Callable[[str], str], doc_type: str = "string", timeout: int = 120) -> BatchProvider:
    """``answer``, the JSON a reference service gives for an article number, which stands in ``content`` as bytes."""

    def make() -> Callable[[bytes], dict]:
        import urllib.request

        def call(number: bytes) -> dict:
            with urllib.request.urlopen(url_of(number.decode()), timeout=timeout) as answer:
                return {"answer": answer.read().decode("utf-8")}

        return call

    return BatchProvider(make, "answer string", doc_type)


def text_layer(make: Callable[[], Callable[[bytes], bytes | None]], doc_type: str = "string") -> BatchProvider:
    """``content`` of each document after recognition: *make* builds, once for a worker, a function that gives a document
    with a text layer for one without. Where it gives none, or raises, the content is null and the error says so."""

    def build() -> Callable[[bytes], dict]:
        recognise = make()
        return lambda content: {"content": recognise(content)}

    return BatchProvider(build, "content binary", doc_type)
