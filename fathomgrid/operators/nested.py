"""Deeply nested records to flat tables by Dewey labels.

A node's label is the list of ordinals on the way to it. Its parent's label is
the label without the last ordinal, reading order is the order of labels, and
nodes with the same schema path (the way without ordinals) form one table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _atoms(prefix: tuple[str, ...], kind: T.StructType) -> tuple[list[tuple[str, ...]], list[tuple[str, ...]]]:
    """Paths of plain fields and of fields that repeat, below a struct; structs in between are passed through."""
    plain, repeat = [], []
    for f in kind.fields:
        at = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType):
            a, b = _atoms(at, f.dataType)
            plain += a
            repeat += b
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            repeat.append(at)
        else:
            plain.append(at)
    return plain, repeat


def _field(base: Column, path: tuple[str, ...]) -> Column:
    for p in path:
        base = base.getField(p)
    return base


def _kind(kind: T.DataType, path: tuple[str, ...]) -> T.DataType:
    for p in path:
        kind = kind[p].dataType  # type: ignore[index]
    return kind


def flatten(records: DataFrame, record_id: str) -> dict[str, DataFrame]:
    """Every repeated field, at any depth, as a table of its own.

    Keys of the result are schema paths such as `comments` or
    `comments.reactions`; the root table has the key "", an array in an array
    the path of the outer one with `.element`. Columns: `_id` (the
    record), `_label` (ordinals from 0, null elements counted), `_parent` (the
    label without its last ordinal), then the fields, nested structs joined by
    an underscore; elements that are no structs have the column `value`, maps
    `key` and `value`. Null elements give no row but keep their ordinal; null
    and empty arrays give no rows. Fields named like these columns get an
    underscore at the end until they are free.
    """
    out: dict[str, DataFrame] = {}
    root = T.StructType([f for f in records.schema.fields if f.name != record_id])
    base = records.select(F.col(record_id).alias("_id"), F.array().cast("array<int>").alias("_label"), F.struct(*[F.col(f"`{f.name}`") for f in root.fields]).alias("_v"))

    def names(taken: list[str], paths: list[tuple[str, ...]]) -> list[str]:
        got = []
        for p in paths:
            n = "_".join(p)
            while n.lower() in [x.lower() for x in (*taken, *got)]:
                n += "_"
            got.append(n)
        return got

    def visit(df: DataFrame, kind: T.DataType, at: str) -> None:
        own = ["_id", "_label", "_parent"]
        parent = F.when(F.size("_label") > 0, F.slice("_label", 1, F.size("_label") - 1)).alias("_parent")
        if not isinstance(kind, T.StructType):
            if isinstance(kind, (T.ArrayType, T.MapType)):
                grow(df, F.col("_v"), kind, f"{at}.element")
                out[at] = df.select("_id", "_label", parent)
            else:
                out[at] = df.select("_id", "_label", parent, F.col("_v").alias("value"))
            return
        plain, repeat = _atoms((), kind)
        out[at] = df.select("_id", "_label", parent, *[_field(F.col("_v"), p).alias(n) for p, n in zip(plain, names(own, plain))])
        for p in repeat:
            grow(df, _field(F.col("_v"), p), _kind(kind, p), ".".join([x for x in (at, *p) if x]))

    def grow(df: DataFrame, value: Column, kind: T.DataType, at: str) -> None:
        if isinstance(kind, T.MapType):
            value, kind = F.map_entries(value), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        rows = df.select("_id", "_label", F.posexplode(value).alias("_pos", "_v")).where(F.col("_v").isNotNull())
        visit(rows.select("_id", F.concat("_label", F.array("_pos")).alias("_label"), "_v"), kind.elementType, at)  # type: ignore[union-attr]

    visit(base, root, "")
    return out


def load_document(text: str | None) -> dict | None:
    """The object in a JSON text, also where it was encoded twice; None when unreadable or no object."""
    if not text:
        return None
    try:
        value = json.loads(text)
        if isinstance(value, str):
            value = json.loads(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def tree_labels(document: dict) -> tuple[list[tuple[int, ...]], list[dict]]:
    """Dewey labels and nodes of a tree of `content` arrays in reading order, the root with the empty label.

    Elements of a content array that are no objects count as ordinals only.
    """
    labels, nodes, stack = [], [], [((), document)]
    while stack:
        label, node = stack.pop()
        labels.append(label)
        nodes.append(node)
        inner = node.get("content")
        if isinstance(inner, list):
            stack.extend([((*label, i), x) for i, x in enumerate(inner) if isinstance(x, dict)][::-1])
    return labels, nodes


def _parents(document: dict) -> list[int]:
    """Position of each node's parent in reading order, -1 for the root: the label truncated, looked up."""
    labels, _ = tree_labels(document)
    at = {label: i for i, label in enumerate(labels)}
    return [at[label[:-1]] if label else -1 for label in labels]


def tree_nodes(records: DataFrame, record_id: str, column: str) -> DataFrame:
    """Nodes of the JSON trees in a text column: record_id, pos, parent_pos, label, type, text.

    Null, blank and unreadable texts and those that hold no object have no
    nodes; a text encoded twice counts as the document in it. type and text are
    null where a node has none. Extra columns are ignored.
    """
    schema = f"{record_id} long, pos int, parent_pos int, label string, type string, text string"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, pos, parent, labels, types, texts = [], [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if (doc := load_document(text)) is None:
                    continue
                ls, nodes = tree_labels(doc)
                at = {label: k for k, label in enumerate(ls)}
                ids += [i] * len(ls)
                pos += range(len(ls))
                parent += [at[x[:-1]] if x else -1 for x in ls]
                labels += [".".join(map(str, x)) for x in ls]
                types += [str(n["type"]) if n.get("type") is not None else None for n in nodes]
                texts += [n["text"].encode("utf-8", "replace").decode() if isinstance(n.get("text"), str) else None for n in nodes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pos, pa.int32()), pa.array(parent, pa.int32()), pa.array(labels, pa.string()), pa.array(types, pa.string()), pa.array(texts, pa.string())],
                names=[record_id, "pos", "parent_pos", "label", "type", "text"],
            )

    return records.select(F.col(record_id).cast("long").alias(record_id), column).mapInArrow(batches, schema)


def tree_links(records: DataFrame, record_id: str, column: str) -> DataFrame:
    """Like `tree_nodes`, only record_id, pos and parent_pos: what joins need, without labels and texts."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [_parents(d) if (d := load_document(t)) is not None else [] for t in b.column(1).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((p for ps in found for p in ps), np.int32, int(sizes.sum()))
            pos = np.arange(len(flat), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), sizes)), pa.array(pos), pa.array(flat)], names=[record_id, "pos", "parent_pos"])

    return records.select(F.col(record_id).cast("long").alias(record_id), column).where(F.col(record_id).isNotNull()).mapInArrow(batches, f"{record_id} long, pos int, parent_pos int")


def without_repeats(array: Column, field: str) -> Column:
    """An array with null in place of elements that repeat the field of an earlier one.

    Null and blank values are no repetition. Elements are sorted by the field
    and back, so long arrays take no more than n log n steps.
    """
    ranked = F.array_sort(F.transform(array, lambda x, i: F.struct(x.getField(field).alias("u"), i.alias("at"))))
    shifted = F.concat(F.array(F.lit(None)), ranked)
    blank = lambda c: F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""
    marked = F.zip_with(ranked, shifted, lambda s, before: F.when(s.isNotNull(), F.struct(s["at"].alias("at"), (blank(s["u"]) | before.isNull() | ~s["u"].eqNullSafe(before["u"])).alias("first"))))
    back = F.array_sort(F.filter(marked, lambda m: m.isNotNull()))
    return F.zip_with(array, back, lambda x, m: F.when(m["first"], x))


def labels(records: DataFrame, record_id: str) -> DataFrame:
    """Dewey labels of all elements of all repeated fields, at any depth, from one read of the records.

    Columns: record_id, path (schema path such as `comments.reactions`), label
    (ordinals from 0, null elements counted), parent (the label without its last
    ordinal). Null elements give no row but keep their ordinal, null and empty
    arrays give none. Nothing is shuffled.
    """
    kind = "array<struct<path:string,label:array<int>>>"
    none = F.array().cast(kind)

    def below(value: Column, dtype: T.DataType, at: str, label: Column) -> list[Column]:
        if isinstance(dtype, T.StructType):
            _, repeat = _atoms((), dtype)
            return [c for p in repeat for c in below(_field(value, p), _kind(dtype, p), ".".join([x for x in (at, *p) if x]), label)]
        if isinstance(dtype, T.MapType):
            value, dtype = F.map_entries(value), T.ArrayType(T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)]))
        if not isinstance(dtype, T.ArrayType):
            return []

        def element(x: Column, i: Column) -> Column:
            own = F.concat(label, F.array(i))
            row = F.array(F.struct(F.lit(at).alias("path"), own.alias("label"))).cast(kind)
            inner = f"{at}.element" if isinstance(dtype.elementType, (T.ArrayType, T.MapType)) else at
            return F.when(x.isNotNull(), F.concat(row, *below(x, dtype.elementType, inner, own))).otherwise(none)

        return [F.coalesce(F.flatten(F.transform(value, element)), none)]

    root = T.StructType([f for f in records.schema.fields if f.name != record_id])
    found = below(F.struct(*[F.col(f"`{f.name}`") for f in root.fields]), root, "", F.array().cast("array<int>"))
    nodes = records.select(F.col(record_id), F.explode(F.concat(*found) if found else none).alias("_n"))
    return nodes.select(record_id, F.col("_n.path").alias("path"), F.col("_n.label").alias("label"), F.slice("_n.label", 1, F.size("_n.label") - 1).alias("parent"))


def placed(labelled: DataFrame, record_id: str, names: dict[str, str]) -> DataFrame:
    """Labels as rows record_id, child, pos, parent_pos: the last ordinal, and that of the parent, -1 for elements of the record itself.

    names: the schema paths to keep, with the name of each in `child`.
    """
    child = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("path")]
    own, parent = F.element_at("label", -1), F.coalesce(F.try_element_at("parent", F.lit(-1)), F.lit(-1))
    return labelled.where(F.col("path").isin(*names)).select(record_id, child.alias("child"), own.alias("pos"), parent.alias("parent_pos"))
