"""Shredding of deeply nested records into an adjacency table and from there into entity tables.

Every node of a record (object, array or scalar) becomes one row ``node, parent, label, ordinal, kind, scalar``.
Object nodes are then joined with their scalar children and pivoted into one flat table per entity, each row
keeping the places of all its ancestors. The adjacency rows of one record are built by one expression made from
the schema, so the input is scanned once whatever the depth, and nothing leaves the JVM. Nodes are numbers, and only
nodes of wanted labels are made: what is read decides what is built, as columns do for a scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    """An entity table: the label path of its nodes, array steps marked [], and scalars to pivot.

    *scalars* maps the output column to the label path below the object, e.g. ``("bbox", 0)`` for the first
    number of an array of numbers, or ``("type",)``.
    """

    name: str
    labels: tuple[str, ...]
    scalars: dict[str, tuple]


def labels_of(wanted: list[Entity]) -> set[str]:
    """The labels of the objects of these entities and of the scalars that they pivot."""
    out = set()
    for e in wanted:
        label = "".join(e.labels)
        out |= {label, *(_scalar_label(label, below)[0] for below in e.scalars.values())}
    return out


def _scalar_label(label: str, below: tuple) -> tuple[str, list[int]]:
    """The label of a scalar below an object, and its place in an array, if it is in one."""
    fields, place = [x for x in below if isinstance(x, str)], [x for x in below if isinstance(x, int)]
    return ".".join([label, *fields]) + "[]" * len(place), place


_NODE = "struct<node:bigint,parent:bigint,label:string,ordinal:int,kind:string,ords:array<int>,owner:bigint,scalar:string>"


def _nodes(value: Column, kind: T.DataType, node: Column, parent: Column, ords: Column, own: Column, label: str, ordinal: Column, labels: set[str] | None) -> Column | None:
    """array<struct> of the node of *value* and of the nodes below it; empty where *value* is null, None if no label is wanted.

    *ords* are the places of the array elements on the way, *own* the nearest object at or above the node, which is
    what the scalars are joined to.
    """
    if labels is not None and not any(x == label or (x.startswith(label) and x[len(label)] in ".[") for x in labels):
        return None

    def row(sort: str, scalar: Column, owner: Column) -> list[Column]:
        if labels is not None and label not in labels:
            return []
        return [
            F.array(
                F.struct(
                    node.alias("node"), parent.alias("parent"), F.lit(label).alias("label"), ordinal.alias("ordinal"),
                    F.lit(sort).alias("kind"), ords.alias("ords"), owner.alias("owner"), scalar.alias("scalar"),
                )
            )
        ]

    none = F.lit(None).cast("string")
    if isinstance(kind, T.StructType):
        parts = row("object", none, node)
        for field in kind.fields:
            name = f"{label}.{field.name}" if label else field.name
            below = _nodes(value.getField(field.name), field.dataType, F.xxhash64(node, F.lit(field.name)), node, ords, node, name, F.lit(None).cast("int"), labels)
            parts += [below] if below is not None else []
    elif isinstance(kind, T.ArrayType):
        parts = row("array", none, own)
        probe = _nodes(F.lit(None), kind.elementType, node, node, ords, own, f"{label}[]", ordinal, labels)
        if probe is not None:
            # the element's number and places are bound once, so that the nodes below don't make them again and again
            bound = lambda i: F.array(F.struct(F.xxhash64(node, i).alias("node"), F.concat(ords, F.array(i)).alias("ords")))
            element = lambda x, i, at: _nodes(x, kind.elementType, at["node"], node, at["ords"], own, f"{label}[]", i, labels)
            parts.append(F.flatten(F.transform(value, lambda x, i: F.get(F.transform(bound(i), lambda at: element(x, i, at)), F.lit(0)))))
    else:
        parts = row("scalar", value.cast("string"), own)
    found = parts[0] if len(parts) == 1 else F.concat(*parts)
    return F.when(value.isNotNull(), found).otherwise(F.expr(f"cast(array() as array<{_NODE}>)"))


def delivered(records: DataFrame, key: str, column: str) -> DataFrame:
    """``key, delivery, column`` of the records that have both, exact copies once.

    *delivery* is a number made of the whole record, so that unlike records under one key stay apart in all tables
    made from them. The records are partitioned by it, which the entities need no other shuffle for.
    """
    some = records.filter(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key), F.xxhash64(column).alias("delivery"), F.col(column))
    return some.dropDuplicates([key, "delivery"])


def adjacency(records: DataFrame, key: str, column: str, labels: set[str] | None = None) -> DataFrame:
    """The adjacency table of the nested *column*: ``key, delivery, node, parent, label, ordinal, kind, ords, owner, scalar``.

    ``node`` is the node's number in its record, made from its way down; ``parent`` that of the node above (null at the
    root), ``label`` the path of field names with ``[]`` for array elements, ``ordinal`` the 0-based place in the stored
    array (null for fields), ``scalar`` the value as text. Null values, at any level, give no node; null array
    elements keep their place, since the ordinals are those of the stored array. Records whose column is null
    or whose key is null give no row. Repeated rows give repeated nodes; ``entities`` merges them. Other columns
    of *records* are ignored, so their names can't clash. With *labels* only the nodes of these labels are made.
    """
    kind = records.schema[column].dataType
    none, places = F.lit(None).cast("int"), F.expr("cast(array() as array<int>)")
    delivery = F.col("delivery") if "delivery" in records.columns else F.xxhash64(column)
    some = records.filter(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("key__"), delivery.alias("delivery__"), F.col(column).alias("column__"))
    top, empty = F.xxhash64(F.lit(column)), F.expr(f"cast(array() as array<{_NODE}>)")
    out = [F.col("key__").alias(key), F.col("delivery__").alias("delivery")]
    if not isinstance(kind, T.ArrayType):
        root = _nodes(F.col("column__"), kind, top, F.lit(None).cast("long"), places, top, "", none, labels)
        return some.select(*out, F.explode(root if root is not None else empty).alias("n")).select(key, "delivery", "n.*")
    # an array of a record's parts is opened first, so that a task holds the nodes of one part at a time
    parts = some.select("key__", "delivery__", F.posexplode_outer("column__").alias("at__", "part__"))
    whole = F.array(F.struct(top.alias("node"), F.lit(None).cast("long").alias("parent"), F.lit("").alias("label"), none.alias("ordinal"), F.lit("array").alias("kind"), places.alias("ords"), top.alias("owner"), F.lit(None).cast("string").alias("scalar")))
    below = _nodes(F.col("part__"), kind.elementType, F.col("node__"), top, F.array("at__"), top, "[]", F.col("at__"), labels)
    found = [F.when(F.coalesce("at__", F.lit(0)) == 0, whole).otherwise(empty)] if labels is None or "" in labels else []
    found += [below] if below is not None else []
    every = F.concat(*found) if len(found) > 1 else found[0] if found else empty
    return parts.withColumn("node__", F.xxhash64(top, F.col("at__"))).select(*out, F.explode(every).alias("n")).select(key, "delivery", "n.*")


def entities(nodes: DataFrame, key: str, wanted: list[Entity]) -> DataFrame:
    """The entity tables *wanted*, one below the other: ``key, delivery, node, entity, ords`` and the union of their scalars.

    Scalar rows carry the number of the object that owns them, so the join of object nodes with their scalar children and
    the pivot of these into columns are one grouping by ``(key, delivery, owner)``, which needs no shuffle where the records
    are partitioned by delivery. *ords* are the places of the array steps on the way to the object. An object without any
    scalar keeps its row, with nulls; columns that an entity doesn't have are null. Exact copies of a record give one row;
    unlike records under one key have rows of their own, told apart by *delivery*: no row is made of two records.
    """
    names = list(dict.fromkeys(c for e in wanted for c in e.scalars))
    object_labels = {"".join(e.labels): e for e in wanted}
    hits: dict[str, list[Column]] = {c: [] for c in names}
    for label, e in object_labels.items():
        for out, below in e.scalars.items():
            name, place = _scalar_label(label, below)
            hit = F.col("label") == name
            hits[out].append(hit & (F.col("ordinal") == place[0]) if place else hit)
    is_object = (F.col("kind") == "object") & F.col("label").isin(list(object_labels))
    entity = reduce(lambda c, pair: F.when(F.col("label") == pair[0], pair[1].name).otherwise(c), object_labels.items(), F.lit(None).cast("string"))
    if not names:  # objects alone are only told apart
        return nodes.filter(is_object).select(key, "delivery", "node", entity.alias("entity"), "ords").distinct()
    is_scalar = {out: (F.col("kind") == "scalar") & reduce(lambda a, b: a | b, each) for out, each in hits.items()}
    some = nodes.filter(reduce(lambda a, b: a | b, is_scalar.values(), is_object))
    picks = [F.max(F.when(hit, F.col("scalar"))).alias(out) for out, hit in is_scalar.items()]
    first = F.max(F.when(is_object, F.struct("ords", entity.alias("entity")))).alias("object")
    grouped = some.groupBy(key, "delivery", "owner").agg(first, *picks).filter("object is not null")
    return grouped.select(key, "delivery", F.col("owner").alias("node"), F.col("object.entity").alias("entity"), F.col("object.ords").alias("ords"), *names)
