"""Lines repeated across the documents of one source.

Each line's papers are stored as compressed bitmaps per source, one for each exact line and 65,536 paper ids; the bitmaps
of its variants (other digits, other letter case) are united; the exact cardinality is held against the threshold; a
line is then deleted where its paper is in the bitmap of its variant and source.

Lines are reduced to 64-bit keys in the JVM before anything moves. A count of rows per key, combined before the
shuffle, bounds the cardinality from above, so bitmaps are made only of lines that can pass: at most the mean number
of lines of a paper over 0.15, for each source. Bitmaps are made within each task, then united by parts of an exact
line, then by variant; a partition is sorted and read as a stream, so nothing is gathered by key and no function
is called for a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.llm import bitmaps
from vellumine.sources.tables import settled

PARTS = 32


def variant_key(line: Column) -> Column:
    """The line, runs of digits and letter case apart."""
    return F.regexp_replace(F.lower(line), r"\p{Nd}+", "0")


def has_words(line: Column, least: int = 4) -> Column:
    return line.rlike(r"(?:\p{L}+\P{L}+){%d}\p{L}" % (least - 1))


def body_lines(content: DataFrame, least_words: int = 4) -> DataFrame:
    """``source, line_key, line, paper_id, item_id, line_no`` of each line of enough words, in rows of running text;
    *line_key* is the key of the line's variants, *line* that of the line as it stands.

    Running text has ``type`` text in any case and a null ``text_level``. Null sources form one source of their own
    (the empty name); rows without text, paper or item are left out.
    """
    rows = content.filter((F.lower("type") == "text") & F.col("text_level").isNull() & F.col("text").isNotNull() & F.col("paper_id").isNotNull() & F.col("item_id").isNotNull())
    lines = rows.select(F.coalesce("source", F.lit("")).alias("source"), "paper_id", "item_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(has_words(F.col("line"), least_words)).select("source", F.xxhash64(variant_key(F.col("line"))).alias("line_key"), F.xxhash64("line").alias("line"), "paper_id", "item_id", "line_no")


def source_papers(content: DataFrame) -> DataFrame:
    """``source, papers``: the exact number of papers of each source, counted over all its rows."""
    return content.filter(F.col("paper_id").isNotNull()).select(F.coalesce("source", F.lit("")).alias("source"), "paper_id").distinct().groupBy("source").agg(F.count("*").alias("papers"))


def _bitmaps_of(batches: Iterator[pd.DataFrame], most: int = 500_000) -> Iterator[pd.DataFrame]:
    """A bitmap for each source, exact line and chunk of ids in this task, given out after *most* rows at the latest."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) >= most:
            yield _packed(pd.concat(held))
            held = []
    if held:
        yield _packed(pd.concat(held))


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.assign(chunk=pdf["paper_id"].to_numpy() >> 16).sort_values([*_EXACT, "paper_id"], kind="stable").reset_index(drop=True)
    starts = _starts(pdf, _EXACT)
    papers, ends = pdf["paper_id"].to_numpy(), [*starts[1:], len(pdf)]
    return pdf.iloc[starts][_EXACT].assign(papers_map=[bitmaps.pack(papers[a:b]) for a, b in zip(starts, ends)])


_EXACT = ["source", "line_key", "line", "chunk"]
_VARIANT = ["source", "line_key", "chunk"]
_KINDS = {"source": "string", "line_key": "long", "line": "long", "chunk": "long", "part": "int"}


def _starts(pdf: pd.DataFrame, keys: list[str]) -> list[int]:
    """Where a new key begins in sorted rows."""
    if not len(pdf):
        return []
    new = np.zeros(len(pdf), dtype=bool)
    new[0] = True
    for k in keys:
        values = pdf[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new).tolist()


def _unite(keys: list[str], few: int = 256) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The union of the bitmaps of each key, over rows sorted by key; at most *few* bitmaps, of at most 8 KB, are held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: tuple = ()
        held: list[bytes] = []
        for pdf in batches:
            out = []
            for key, part in zip(pdf[keys].itertuples(index=False, name=None), pdf["papers_map"]):
                if key != at and held:
                    out.append((*at, bitmaps.union(held)))
                    held = []
                at = key
                held.append(part)
                if len(held) >= few:
                    held = [bitmaps.union(held)]
            yield pd.DataFrame(out, columns=[*keys, "papers_map"])
        if held:
            yield pd.DataFrame([(*at, bitmaps.union(held))], columns=[*keys, "papers_map"])

    return run


def _united(maps: DataFrame, keys: list[str]) -> DataFrame:
    schema = ", ".join(f"{k} {_KINDS[k]}" for k in keys) + ", papers_map binary"
    return maps.select(*keys, "papers_map").repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_unite(keys), schema)


def line_bitmaps(content: DataFrame, lines: DataFrame, least_papers: int = 3, share: float = 0.15) -> DataFrame:
    """``source, line_key, chunk, papers_map``: the bitmaps of the lines that can be in enough papers of their source, of
    all variants of a line together; one of at most 8 KB for each 65,536 ids."""
    bound = lines.groupBy("source", "line_key").agg(F.count("*").alias("rows")).filter(F.col("rows") >= least_papers)
    may = bound.join(source_papers(content), "source").filter(_enough(F.col("rows"), least_papers, share)).select("source", "line_key")
    some = lines.join(may, ["source", "line_key"], "left_semi").select("source", "line_key", "line", "paper_id")
    exact = some.mapInPandas(_bitmaps_of, ", ".join(f"{k} {_KINDS[k]}" for k in _EXACT) + ", papers_map binary")
    parts = _united(exact.withColumn("part", F.pmod(F.hash("papers_map"), F.lit(PARTS))), [*_EXACT, "part"])
    return _united(parts, _VARIANT)


def _enough(n: Column, least_papers: int, share: float) -> Column:
    return (n >= least_papers) & (n >= F.col("papers") * F.lit(share))


def repeated_lines(content: DataFrame, maps: DataFrame, least_papers: int = 3, share: float = 0.15) -> DataFrame:
    """``source, line_key, line_papers, papers``: lines whose exact cardinality is enough for their source."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["source", "line_key"]].assign(n=[bitmaps.cardinality(b) for b in pdf["papers_map"]])

    each = maps.mapInPandas(counted, "source string, line_key long, n long").groupBy("source", "line_key").agg(F.sum("n").alias("line_papers"))
    return each.join(source_papers(content), "source").filter(_enough(F.col("line_papers"), least_papers, share)).select("source", "line_key", "line_papers", "papers")


def _looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines whose paper is in the bitmap of their source and variant, over rows sorted by key, each key's bitmap first.
    A line of a source that doesn't repeat it finds no bitmap."""
    at: tuple = ()
    ids = np.array([], dtype=np.int64)
    for pdf in batches:
        pdf = pdf.reset_index(drop=True)
        starts, keep = _starts(pdf, _VARIANT), np.zeros(len(pdf), dtype=bool)
        papers, maps = pdf["paper_id"].to_numpy(), pdf["papers_map"].tolist()
        for a, b in zip(starts, [*starts[1:], len(pdf)]):
            key = tuple(pdf[k].iat[a] for k in _VARIANT)
            if key != at:
                at, ids = key, np.array([], dtype=np.int64)
            if maps[a] is not None:
                ids = bitmaps.unpack(maps[a])
                a += 1
            keep[a:b] = np.isin(papers[a:b], ids)
        yield pdf.loc[keep, _PLACE]


_PLACE = ["source", "line_key", "paper_id", "item_id", "line_no"]


def _found(content: DataFrame, least_papers: int, share: float, least_words: int) -> tuple[DataFrame, DataFrame]:
    lines = settled(body_lines(content, least_words), content.sparkSession)
    maps = settled(line_bitmaps(content, lines, least_papers, share), content.sparkSession)
    kept = settled(repeated_lines(content, maps, least_papers, share), content.sparkSession)
    own = maps.join(kept, ["source", "line_key"], "left_semi")
    own = own.select(*_VARIANT, *(F.lit(0).cast("long").alias(x) for x in ("paper_id", "item_id")), F.lit(0).alias("line_no"), "papers_map")
    some = lines.join(kept.select("line_key").distinct(), "line_key", "left_semi")
    some = some.select("source", "line_key", F.shiftright("paper_id", 16).alias("chunk"), "paper_id", "item_id", "line_no", F.lit(None).cast("binary").alias("papers_map"))
    both = some.unionByName(own).repartition(*_VARIANT).sortWithinPartitions(*_VARIANT, F.col("papers_map").isNull())
    hits = both.mapInPandas(_looked_up, "source string, line_key long, paper_id long, item_id long, line_no int")
    return hits, kept


def site_lines(content: DataFrame, least_papers: int = 3, share: float = 0.15, least_words: int = 4) -> DataFrame:
    """``item_id, line_no``: the places of the lines that their source repeats, each place once.

    *line_no* is 0-based after splitting the text at newlines. A line counts if it has *least_words* words of letters
    and, runs of digits and letter case apart, stands in at least *least_papers* papers and at least *share* of
    the papers of its source. Repeated rows count once; an empty table gives no rows; other columns are ignored.
    """
    hits, _ = _found(content, least_papers, share, least_words)
    return hits.select("item_id", F.col("line_no").cast("int").alias("line_no")).distinct()


def without_site_lines(content: DataFrame, least_papers: int = 3, share: float = 0.15, least_words: int = 4) -> DataFrame:
    """``item_id, clean_text, removed``: each distinct row's whole text without the lines its source repeats.

    A text of which nothing is left becomes empty; null stays null. Rows of other types are kept as they are.
    """
    hits, _ = _found(content, least_papers, share, least_words)
    drop = hits.groupBy("item_id").agg(F.collect_set("line_no").alias("gone"))
    rows = content.select("item_id", "text").distinct().join(drop, "item_id", "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    return rows.select("item_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("clean_text"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed"))


def site_line_report(content: DataFrame, least_papers: int = 3, share: float = 0.15, least_words: int = 4) -> DataFrame:
    """``source, line_papers, papers, n_lines``: of each repeated line its papers, its source's and its places."""
    hits, kept = _found(content, least_papers, share, least_words)
    places = hits.select("source", "line_key", "item_id", "line_no").distinct().groupBy("source", "line_key").agg(F.count("*").alias("n_lines"))
    return kept.join(places, ["source", "line_key"]).select("source", "line_papers", "papers", "n_lines")
