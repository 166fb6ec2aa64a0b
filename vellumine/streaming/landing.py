"""Documents parsed as they land: a stream over a folder of content-list files, each micro-batch through the batch plan.

Parsing needs a document's items only, and a file holds one document, so no state is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumine.operators import structure as S
from vellumine.sources.files import ITEM_SCHEMA


def landing(spark: SparkSession, directory: str, per_batch: int = 1000) -> DataFrame:
    """``doc_id, value``: the files of a folder, each once, as they appear."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", per_batch).load(directory)
    return raw.select(F.regexp_extract("_metadata.file_name", r"^(.*?)(?:_content_list)?\.json$", 1).alias("doc_id"), "value")


def parse_into(stream: DataFrame, paragraphs: str, statuses: str, checkpoint: str) -> StreamingQuery:
    """Writes the paragraphs and the error codes of each batch as parquet, partitioned by batch, so that a repeated batch replaces its own."""

    def sink(batch: DataFrame, number: int) -> None:
        rows = batch.select("doc_id", F.posexplode(F.from_json("value", ITEM_SCHEMA)).alias("idx", "i")).filter("i is not null").select("doc_id", "idx", "i.*")
        outline = S.outlined(S.items(rows, "doc_id")).persist()
        try:
            S.paragraphs(outline).write.mode("overwrite").parquet(f"{paragraphs}/batch={number}")
            broken = batch.filter(F.from_json("value", ITEM_SCHEMA).isNull()).select("doc_id", F.lit("MALFORMED_JSON").alias("error_code"))
            S.errors(outline).select("doc_id", "error_code").unionByName(broken).write.mode("overwrite").parquet(f"{statuses}/batch={number}")
        finally:
            outline.unpersist()

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
