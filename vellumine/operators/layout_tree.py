"""The entities of layout geometry: pages, blocks, sub-blocks, lines and spans of ``pdf_info``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.operators.shred import Entity, adjacency, delivered, entities, labels_of

PLACES = ["page_no", "block_no", "sub_no", "line_no", "span_no"]
_BOX = {"x0": ("bbox", 0), "y0": ("bbox", 1), "x1": ("bbox", 2), "y1": ("bbox", 3)}
_SPAN = {**_BOX, "content": ("content",), "type": ("type",), "score": ("score",), "image_path": ("image_path",)}
_PAGE, _BLOCK, _SUB = ("[]",), ("[]", ".preproc_blocks[]"), ("[]", ".preproc_blocks[]", ".blocks[]")

#: The entity, and which of page, block, sub-block, line and span the array steps on its way are.
LEVELS: dict[str, tuple[Entity, list[str]]] = {
    "page": (Entity("page", _PAGE, {}), ["page_no"]),
    "block": (Entity("block", _BLOCK, {**_BOX, "type": ("type",)}), ["page_no", "block_no"]),
    "sub_block": (Entity("sub_block", _SUB, {**_BOX, "type": ("type",)}), ["page_no", "block_no", "sub_no"]),
    "line": (Entity("line", (*_BLOCK, ".lines[]"), _BOX), ["page_no", "block_no", "line_no"]),
    "sub_line": (Entity("sub_line", (*_SUB, ".lines[]"), _BOX), ["page_no", "block_no", "sub_no", "line_no"]),
    "span": (Entity("span", (*_BLOCK, ".lines[]", ".spans[]"), _SPAN), ["page_no", "block_no", "line_no", "span_no"]),
    "sub_span": (Entity("sub_span", (*_SUB, ".lines[]", ".spans[]"), _SPAN), ["page_no", "block_no", "sub_no", "line_no", "span_no"]),
}


def layout_nodes(middle: DataFrame, key: str = "rec_id", labels: set[str] | None = None) -> DataFrame:
    """The adjacency table of ``pdf_info``; see :func:`vellumine.operators.shred.adjacency`."""
    return adjacency(middle, key, "pdf_info", labels)


def _placed(flat: DataFrame, levels: list[str]) -> list[Column]:
    at = []
    for p in PLACES:
        found = [F.when(F.col("entity") == x, F.get("ords", F.lit(LEVELS[x][1].index(p)))) for x in levels if p in LEVELS[x][1]]
        at.append(F.coalesce(*found, F.lit(-1)).cast("int").alias(p))
    return at


def _path(names: list[str], places: list[str]) -> Column:
    """The way down to a node in words, e.g. pdf_info[0].preproc_blocks[2]."""
    return F.concat_ws(".", *(F.concat(F.lit(f"{name}["), F.col(place).cast("string"), F.lit("]")) for name, place in zip(names, places)))


def node_path(level: str) -> tuple[Column, Column]:
    """The paths of a node of this level and of its parent object (null for a page), made from the places."""
    names, places = ["pdf_info", *(x.strip(".[]") for x in LEVELS[level][0].labels[1:])], LEVELS[level][1]
    parent = _path(names[:-1], places[:-1]) if len(places) > 1 else F.lit(None).cast("string")
    return _path(names, places), parent


def layout_entities(middle: DataFrame, levels: list[str], key: str = "rec_id") -> DataFrame:
    """``rec_id``, the five places, ``entity, delivery, node, parent`` and the scalars of the entities of these *levels*.

    Places of levels below the node, or of no sub-block, are -1. *node* and *parent* name the node and the object above it by their
    ways down, so that a row finds its parent's row; null for a page. Unlike records under one key have rows of their own.
    """
    wanted = [LEVELS[x][0] for x in levels]
    flat = entities(layout_nodes(delivered(middle, key, "pdf_info"), key, labels_of(wanted)), key, wanted)
    scalars = [c for c in flat.columns if c not in (key, "entity", "node", "ords", "delivery")]
    placed = flat.select(key, *_placed(flat, levels), "entity", "delivery", *scalars)
    own, above = F.lit(None).cast("string"), F.lit(None).cast("string")
    for x in levels:
        node, parent = node_path(x)
        own, above = F.when(F.col("entity") == x, node).otherwise(own), F.when(F.col("entity") == x, parent).otherwise(above)
    return placed.select(key, *PLACES, "entity", "delivery", own.alias("node"), above.alias("parent"), *scalars)


def layout_places(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """The places of all pages, blocks, sub-blocks, lines and spans that are not null, each once.

    Null or empty levels give no rows; an object whose fields are all null is a node. Of repeated records, and of
    two unlike records under one key, each place is given once. An empty table gives no rows.
    """
    bare = [Entity(e.name, e.labels, {}) for e, _ in LEVELS.values()]
    nodes = layout_nodes(middle, key, labels_of(bare)).filter("kind = 'object'")
    entity = F.lit(None).cast("string")
    for e in bare:
        entity = F.when(F.col("label") == "".join(e.labels), e.name).otherwise(entity)
    flat = nodes.select(key, entity.alias("entity"), "ords")
    return flat.select(key, *_placed(flat, list(LEVELS))).distinct()


_NUMBERS = ("x0", "y0", "x1", "y1", "score")


def _typed(middle: DataFrame, levels: list[str], columns: list[str], key: str) -> DataFrame:
    found = layout_entities(middle, levels, key)
    return found.select(key, *PLACES, "node", "parent", *(F.col(c).cast("double").alias(c) if c in _NUMBERS else F.col(c) for c in columns)).distinct()


def layout_spans(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """All spans, in blocks and sub-blocks, with their scalars typed, ``node`` and ``parent`` (the line)."""
    return _typed(middle, ["span", "sub_span"], [*_NUMBERS, "content", "type", "image_path"], key)


def layout_lines(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """All lines of blocks and sub-blocks with their box, ``node`` and ``parent`` (the block or sub-block)."""
    return _typed(middle, ["line", "sub_line"], list(_NUMBERS[:4]), key)


def layout_blocks(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """All blocks and sub-blocks with their box and type, ``node`` and ``parent`` (the page or the block)."""
    return _typed(middle, ["block", "sub_block"], [*_NUMBERS[:4], "type"], key)


def layout_pages(middle: DataFrame, key: str = "rec_id") -> DataFrame:
    """All pages that are not null, with ``node``; their ``parent`` is the record, so it is null."""
    return _typed(middle, ["page"], [], key)
