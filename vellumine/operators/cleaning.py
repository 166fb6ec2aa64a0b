"""Boilerplate rows taken out of a document's items, the text around them closed up.

The rule is a fold over the items in reading order, in which a row may change rows before and after it; it runs over sorted
partitions, document after document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumine.functions import text as X
from vellumine.functions.latex import cleaned_inline


def marked(items: DataFrame) -> DataFrame:
    """``doc_id, idx, type, text, text_level, bad, clean``: whether a row holds boilerplate, and what its text becomes if
    it is kept: line ends taken out and blanks collapsed where there are any, formulas tidied. Null texts are empty."""
    rows = items.select("doc_id", "idx", "type", F.coalesce("text", F.lit("")).alias("text"), "text_level")
    flat = F.when(F.instr("text", "\n") > 0, F.regexp_replace(F.replace("text", F.lit("\n"), F.lit("")), r"(?U)\s+", " ")).otherwise(F.col("text"))
    return rows.withColumns({"bad": X.is_boilerplate(F.col("text")), "clean": F.when(F.col("type") == "text", cleaned_inline(flat)).otherwise(F.col("text"))})


def fold(rows: list[dict]) -> tuple[list[dict], str | None]:
    """The cleaned rows of one document (``type, text, text_level, bad, clean``), or none and an error code.

    A bad row needs a running text before it among the rows kept and one after it, which may be bad itself; if the one
    before doesn't end in a full stop, the one after is appended to it as it stands and taken out. Rows are told apart
    by place, not by content. A row that has become bad by an addition stays here; ``cleaned`` takes it out.
    """
    running = lambda r: r["type"] == "text" and not r["text_level"]
    kept: list[dict] = []
    taken: set[int] = set()
    for i, row in enumerate(rows):
        if i in taken:
            continue
        if not row["bad"]:
            kept.append(dict(row, text=row["clean"]))
            continue
        before = next((r for r in reversed(kept) if running(r)), None)
        after = next((j for j in range(i + 1, len(rows)) if j not in taken and running(rows[j])), None)
        if before is None or after is None:
            return [], "BAD_ENTRY_NO_NEIGHBOUR"
        if not before["text"].endswith("."):
            before["text"] += " " + rows[after]["text"]
            taken.add(after)
    return kept, None


def cleaned(items: DataFrame) -> DataFrame:
    """``doc_id, idx, type, text, text_level, error_code``: the items after the fold, at their old places.

    Only documents with a bad row go through the fold; the rows of all others are given as they are marked, in the JVM.
    A document that cannot be cleaned gives one row with an error code and no place. Null texts count as empty.
    """
    schema = T.StructType([items.schema["doc_id"], *(T.StructField(n, k) for n, k in (("idx", T.IntegerType()), ("type", T.StringType()), ("text", T.StringType()), ("text_level", T.IntegerType()), ("error_code", T.StringType())))])
    columns = ["doc_id", "idx", "type", "text", "text_level", "bad", "clean"]
    names, kinds = schema.names, [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()]

    def folded(doc: object, rows: list[dict]) -> list[tuple]:
        out, error = fold(rows)
        return [(doc, r["idx"], r["type"], r["text"], r["text_level"], None) for r in out] if not error else [(doc, None, None, None, None, error)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The documents of a partition, which is sorted, one after another; a document may reach over batches."""
        at, rows, first = None, [], None
        for b in batches:
            first = first or b.schema.field(0).type
            out = []
            for row in b.to_pylist():
                if rows and row["doc_id"] != at:
                    out.extend(folded(at, rows))
                    rows = []
                at = row["doc_id"]
                rows.append(row)
            yield made(out, first)
        if rows:
            yield made(folded(at, rows), first)

    def made(out: list[tuple], first: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, [first, *kinds])], names=names)

    # the window leaves each document whole in one partition, so sorting there is all that the fold needs
    rows = marked(items).withColumn("any_bad", F.max("bad").over(W.partitionBy("doc_id")))
    sound = rows.filter("not any_bad").select("doc_id", "idx", "type", F.col("clean").alias("text"), "text_level", F.lit(None).cast("string").alias("error_code"))
    rest = rows.filter("any_bad").select(*columns).sortWithinPartitions("doc_id", "idx", "text").mapInArrow(run, schema)
    return sound.unionByName(rest).filter(F.col("error_code").isNotNull() | ~X.is_boilerplate(F.col("text")))


def bad_entries(items: DataFrame) -> DataFrame:
    """``doc_id, idx`` of the rows with boilerplate, of every type."""
    return items.filter(X.is_boilerplate(F.col("text"))).select("doc_id", "idx")


def cleaned_isolated(items: DataFrame) -> DataFrame:
    """``doc_id, idx, text``: the fold in the JVM for documents whose bad rows have sound running texts next to them.

    Only rows of running text are given, and formulas are left as they are. Rows with a bad neighbour are treated as
    if that neighbour were absent, which is the fold's result only where bad rows don't follow one another.
    """
    rows = items.filter((F.col("type") == "text") & (F.coalesce("text_level", F.lit(0)) == 0)).select("doc_id", "idx", F.coalesce("text", F.lit("")).alias("raw"))
    rows = rows.withColumns({"bad": X.is_boilerplate(F.col("raw")), "flat": F.when(F.instr("raw", "\n") > 0, F.regexp_replace(F.replace("raw", F.lit("\n"), F.lit("")), r"(?U)\s+", " ")).otherwise(F.col("raw"))})
    order = W.partitionBy("doc_id").orderBy("idx", "raw")
    open_before = F.coalesce(F.lag("bad").over(order) & ~F.lag("flat", 2).over(order).endswith("."), F.lag("bad").over(order) & F.lag("flat", 2).over(order).isNotNull() & ~F.lag("flat", 2).over(order).endswith("."), F.lit(False))
    joined = F.when(F.lead("bad").over(order) & ~F.col("flat").endswith("."), F.concat_ws(" ", "flat", F.lead("raw", 2).over(order))).otherwise(F.col("flat"))
    return rows.select("doc_id", "idx", "bad", open_before.alias("gone"), joined.alias("text")).filter("not bad and not gone").select("doc_id", "idx", "text")
