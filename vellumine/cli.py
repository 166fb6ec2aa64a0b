"""spark-submit entry. ``parse``: content-list files into flat records, one JSON file for each document, with a failure
report. ``metadata``: the header and references of PDF files from a service, without parsing them. Each step's seconds are
logged and written to ``timing`` in the output folder.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vellumine.operators import structure as S
from vellumine.operators import tei
from vellumine.plans import pipeline
from vellumine.sources import files, providers, ship

log = logging.getLogger("vellumine")


class Clock:
    """The seconds of each step, kept in order."""

    def __init__(self) -> None:
        self.steps: list[tuple[str, float]] = []

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        yield
        self.steps.append((name, round(time.perf_counter() - began, 3)))
        log.info("%s: %.1f s", *self.steps[-1])

    def write(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.steps or [("none", 0.0)], "step string, seconds double").coalesce(1).write.mode("overwrite").json(path)


def parse(spark: SparkSession, args: argparse.Namespace) -> None:
    clock = Clock()
    items = S.items(files.content_lists(spark, args.inputs), "doc_id")
    outline = S.outlined(items)
    docs = items.select("doc_id").distinct()
    stored = spark.read.parquet(args.tei) if args.tei else docs.select("doc_id", F.lit(None).cast("string").alias("tei_header"), F.lit(None).cast("string").alias("tei_references"))
    whole = pipeline.merged(docs.join(stored, "doc_id", "left"), pipeline.flat_schema(items))
    with clock.step("predictions"):
        files.write_each(pipeline.as_json(whole), f"{args.output}/predictions").write.mode("overwrite").parquet(f"{args.output}/written")
    names = docs.select("doc_id", F.col("doc_id").alias("file_name"))
    report = pipeline.failures(whole, S.errors(outline), names)
    report = report.unionByName(files.unreadable(spark, args.inputs).select("doc_id", F.col("doc_id").alias("file_name"), F.lit("read").alias("stage"), "error_code"))
    with clock.step("failures"):
        report.write.mode("overwrite").json(f"{args.output}/failures")
    clock.write(spark, f"{args.output}/timing")


def metadata(spark: SparkSession, args: argparse.Namespace) -> None:
    """``metadata`` (parquet: doc_id, tei_header, tei_references, header, refs) and ``failures`` (title and path of each
    document that the service gave nothing for)."""
    clock = Clock()
    pdfs = files.pdf_files(spark, args.inputs).withColumn("doc_id", F.element_at(F.split("path", "/"), -1))
    service = providers.metadata_service(f"{args.url}/api/processHeaderDocument", f"{args.url}/api/processReferences")
    with clock.step("service"):
        service.apply(pdfs).join(pdfs.select("doc_id", "path"), "doc_id").write.mode("overwrite").parquet(f"{args.output}/answers")
    answers = spark.read.parquet(f"{args.output}/answers")
    refs = pipeline.references_list(tei.references_of(answers))
    with clock.step("records"):
        answers.select("doc_id", "tei_header", "tei_references", tei.header_record(F.col("tei_header")).alias("header")).join(refs, "doc_id", "left").write.mode("overwrite").parquet(f"{args.output}/metadata")
    with clock.step("failures"):
        bad = answers.filter(F.col("provider_error").isNotNull() | F.col("tei_header").isNull())
        bad.select(F.col("doc_id").alias("title"), F.col("path").alias("PDF path"), "provider_error").write.mode("overwrite").json(f"{args.output}/failures")
    clock.write(spark, f"{args.output}/timing")


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] not in ("parse", "metadata", "-h", "--help"):
        argv.insert(0, "parse")
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run, what in (("parse", parse, "folder or glob of content-list JSON files"), ("metadata", metadata, "folder or glob of PDF files")):
        one = commands.add_parser(name)
        one.add_argument("inputs", help=what)
        one.add_argument("-o", "--output", required=True, help="folder that all executors share")
        one.add_argument("-q", "--quiet", action="store_true", help="log warnings only")
        one.set_defaults(run=run)
    commands.choices["parse"].add_argument("--tei", help="parquet of doc_id, tei_header, tei_references; without it all documents are partial")
    commands.choices["metadata"].add_argument("--url", default="http://localhost:8070", help="address of the metadata service")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.WARNING if args.quiet else logging.INFO, format="%(asctime)s %(message)s")
    spark = SparkSession.builder.appName("vellumine").getOrCreate()
    ship(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
