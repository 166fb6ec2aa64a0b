"""Passages of held-out test items in corpus documents, by pigeonhole edit matching.

A test item of n words is cut into k + 1 pieces of six words, k = n // 6 - 1 being its error budget: a copy with at
most k wrong words keeps a piece, and every unbroken run of twelve words, wherever it starts, holds a whole one.
Exact piece hits are found in one pass over each document. Two verdicts follow. Edited copies: Myers' bit-parallel
distance between the whole item and the document around its hits is held against the budget. Runs: a hit goes on if the
distance of the words around its piece leaves room for a run of twelve (at most six of eighteen words wrong), and the runs
of what is left are measured exactly, so that parts of an item count too.

Documents are read once, where they lie, and no text is moved; only hits leave the task. The test items are a stated
query set of checked size: they are broadcast in one block of at most *most_chars* characters, whose index each Python
worker builds once; a larger set goes in several blocks, each with its own pass over the documents.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.confusables import look

PIECE, RUN = 6, 12
_CUT = re.compile(r"[-¬‐­]\s*\n\s*|[-¬‐]")
_WORD = re.compile(r"[^\W_]+")


_SOFT = re.compile(r"­[ \t]*\n\s*")


def words(text: str) -> list[str]:
    """The words of a text, case, punctuation, line breaks, hyphens and look-alike characters apart."""
    if "\u00ad" in text:  # a soft hyphen at a line end cuts a word; any other is invisible
        text = _SOFT.sub("", text)
    return _WORD.findall(_CUT.sub("", look(text)).lower())


def pieces(item: list[str]) -> list[int]:
    """The places of the item's pieces: as many as its error budget plus one."""
    return list(range(0, len(item) - PIECE + 1, PIECE))


def myers(pattern: list[str], text: list[str], inside: bool = False) -> int:
    """The edit distance of two word sequences by Myers' bit-parallel algorithm; any length, one integer as the column.

    *inside*: the least distance of the pattern from any stretch of the text.
    """
    m = len(pattern)
    if not m:
        return 0 if inside else len(text)
    equal: dict[str, int] = {}
    for i, w in enumerate(pattern):
        equal[w] = equal.get(w, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, least, step = mask, 0, m, m, 0 if inside else 1
    for w in text:
        eq = equal.get(w, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & mask
        right = (down | ~(diagonal | up)) & mask
        left = up & diagonal
        if right & high:
            score += 1
        elif left & high:
            score -= 1
        if score < least:
            least = score
        right = (right << 1 | step) & mask
        left = (left << 1) & mask
        up = (left | ~(diagonal | right)) & mask
        down = right & diagonal
    return least if inside else score


class Items:
    """A block of test items with the index of their pieces."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.words = {i: w for i, t in rows if t and len(w := words(t)) >= RUN}
        self.sets = {i: frozenset(w) for i, w in self.words.items()}
        self.index: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for i, w in self.words.items():
            for at in pieces(w):
                self.index.setdefault(tuple(w[at : at + PIECE]), []).append((i, at))
        self.first = {p[:2] for p in self.index}

    def hits(self, doc: list[str]) -> Iterator[tuple[int, int, int]]:
        """(item, place in the item, place in the document) of each exact piece."""
        first, index = self.first, self.index
        for p, pair in enumerate(zip(doc, doc[1:])):
            if pair in first:
                for item, at in index.get(tuple(doc[p : p + PIECE]), ()):
                    yield item, at, p

    def verified(self, doc: list[str], item: int, at: int, p: int) -> bool:
        """Whether the words around the piece are within the error budget of a run through it. Each word of the item that
        the document lacks there is an error of its own, which tells most hits by chance without the distance."""
        w = self.words[item]
        lo, hi = max(0, at - PIECE), min(len(w), at + 2 * PIECE)
        budget = hi - lo - RUN
        shift = p - at
        there = doc[max(0, lo + shift) : max(0, hi + shift)]
        return budget >= 0 and len(set(w[lo:hi]).difference(there)) <= budget and myers(w[lo:hi], there) <= budget

    def edits(self, doc: list[str], item: int, shifts: set[int]) -> int | None:
        """The least distance of the item from a stretch of the document around its hits; None above the error budget. A word
        of the item that such a stretch lacks is an edit of its own."""
        w = self.words[item]
        k = len(w) // PIECE - 1
        spans: list[list[int]] = []
        for s in sorted(shifts):  # a copy within the budget begins and ends at most k words off
            lo, hi = max(0, s - k), s + len(w) + k
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi])
        near = [part for lo, hi in spans if len(self.sets[item].difference(part := doc[lo:hi])) <= k]
        best = min([myers(w, part, inside=True) for part in near], default=len(w))
        return best if best <= k else None

    def leaked(self, doc: list[str]) -> dict[int, tuple[int, int, int | None]]:
        """For each item with a run or an edited copy: (words in runs, words of the item, edits)."""
        done: set[tuple[int, int, int]] = set()
        inside: dict[int, set[int]] = {}
        shifts: dict[int, set[int]] = {}
        for item, at, p in self.hits(doc):
            w, shift = self.words[item], p - at
            shifts.setdefault(item, set()).add(shift)
            if (item, at, shift) in done or not self.verified(doc, item, at, p):
                continue
            a, b = at, at + PIECE
            while a > 0 and a + shift > 0 and w[a - 1] == doc[a + shift - 1]:
                a -= 1
            while b < len(w) and b + shift < len(doc) and w[b] == doc[b + shift]:
                b += 1
            done.update((item, x, shift) for x in pieces(w) if a <= x and x + PIECE <= b)
            if b - a >= RUN:
                inside.setdefault(item, set()).update(range(a, b))
        out = {}
        for item, found in shifts.items():
            edits, n = self.edits(doc, item, found), len(inside.get(item, ()))
            if n or edits is not None:
                out[item] = (n, len(self.words[item]), edits)
        return out


_BUILT: dict[str, Items] = {}


def _index(token: str, block: list[tuple[int, str]]) -> Items:
    """The index of a block, built once by each Python worker, which keeps that of one block."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Items(block)
    return _BUILT[token]


def item_blocks(items: DataFrame, most_chars: int = 8_000_000) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of at most *most_chars* characters, streamed to the driver one row at a time.

    Items with null id or text are left out; of repeated rows one is kept.
    """
    block, size = [], 0
    for row in items.filter(F.col("item_id").isNotNull() & F.col("item_text").isNotNull()).select("item_id", "item_text").distinct().toLocalIterator():
        if block and size + len(row[1]) > most_chars:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame, least_share: float = 0.5, most_chars: int = 8_000_000) -> DataFrame:
    """``doc_id, item_id, in_runs, item_words, edits, kind``: each document with the test items it leaks.

    *kind* 'exact': at least *least_share* of the item's words stand in the document in unbroken runs of twelve or
    more words, disregarding case, punctuation, line breaks, hyphens and look-alike characters. 'edited': not so, but
    the document holds the whole item with at most its error budget of words wrong, left out or put in; *edits* is that number,
    null beyond the budget. Null texts and items of fewer than twelve words leak nothing; of repeated rows one is
    kept, of unlike texts under one id the most leaked; an empty table gives no rows; columns other than ``doc_id, text`` and ``item_id,
    item_text`` are ignored.
    """
    docs = documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out, sc = None, docs.sparkSession.sparkContext
    for block in item_blocks(items, most_chars):
        sent, token = sc.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, token=token) -> Iterator[pa.RecordBatch]:
            index = None
            for b in batches:
                index = index or _index(token, sent.value)
                rows: list[list] = [[], [], [], [], []]
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for item, (n, of, edits) in index.leaked(words(text)).items():
                        if n >= least_share * of or edits is not None:
                            for column, value in zip(rows, (doc, item, n, of, edits)):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["doc_id", "item_id", "in_runs", "item_words", "edits"])

        found = docs.mapInArrow(run, "doc_id long, item_id long, in_runs long, item_words long, edits long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, in_runs long, item_words long, edits long, kind string")
    most = out.groupBy("doc_id", "item_id").agg(F.max("in_runs").alias("in_runs"), F.max("item_words").alias("item_words"), F.min("edits").alias("edits"))
    return most.withColumn("kind", F.when(F.col("in_runs") >= least_share * F.col("item_words"), "exact").otherwise("edited"))


def leaked_items(found: DataFrame) -> DataFrame:
    """``item_id, docs, exact_docs``: each leaked test item with the number of documents that leak it, and of those that do in runs."""
    exact = F.countDistinct(F.when(F.col("kind") == "exact", F.col("doc_id")))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("docs"), exact.alias("exact_docs"))
