"""Nested records into flat related tables, by Dewey labels.

A node's label is the list of its ordinals from the root. The spec names the node types (schema paths); nodes of one
type form one table, and the label of a node's parent is a prefix of its own, so parent links need no join.

A record is shredded where it is read: no shuffle. The walk runs in Arrow batches in Python, because JSON functions in
nested lambdas open a parser per sub-record and took 20 CPU seconds where this takes one (18 MB of claims), and because
VARIANT and maps lose the reading order of object keys, which the ordinals count.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Nodes in one output batch; a batch ends after the record that exceeds it.
BATCH_NODES = 20_000
#: Path of a record itself, above its nodes; returned only where `only` asks for it.
ROOT = "root"


@dataclass(frozen=True)
class NodeType:
    """A schema path. `name` is also the path in the output.

    parent: name of the parent type, None for children of the root.
    field: member of the parent object that holds the nodes; None if the parent itself is the list.
    ordinal: the field's own ordinal in the label (None: no such step).
    many: the field holds a list of nodes; else it is the node."""

    name: str
    parent: str | None = None
    field: str | None = None
    ordinal: int | None = None
    many: bool = True


class Number(str):
    """A JSON number with a fraction or exponent, as written."""

    __slots__ = ()


def _constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def parse_json(text: str) -> Any:
    """The value of a complete JSON text; ValueError if it is none. Numbers with a fraction keep their digits."""
    try:
        return json.loads(text, parse_float=Number, parse_constant=_constant)
    except RecursionError as e:
        raise ValueError("nested too deeply") from e


def children(value: Any) -> list:
    """Elements of a list, or members of an object that stands for a list, in reading order."""
    return value if isinstance(value, list) else list(value.values()) if isinstance(value, dict) else []


def label_depth(spec: list[NodeType], name: str) -> int:
    """Length of the labels of type `name`."""
    node = next(n for n in spec if n.name == name)
    return (label_depth(spec, node.parent) if node.parent else 0) + (node.ordinal is not None) + node.many


def walk(roots: list, spec: list[NodeType]) -> list[list[tuple[list[int], Any]]]:
    """For each type of the spec, (label, value) of its nodes but nulls, in reading order."""
    found: list[list[tuple[list[int], Any]]] = []
    names = [n.name for n in spec]
    for n in spec:
        if n.parent is None:
            found.append([([i], v) for i, v in enumerate(roots) if v is not None])
            continue
        at: list[tuple[list[int], Any]] = []
        field, step = n.field, [] if n.ordinal is None else [n.ordinal]
        for label, p in found[names.index(n.parent)]:
            v = p if field is None else p.get(field) if isinstance(p, dict) else None
            if v is None:
                continue
            stem = label + step
            if not n.many:
                at.append((stem, v))
            elif v:
                at += [(stem + [i], c) for i, c in enumerate(children(v)) if c is not None]
        found.append(at)
    return found


def dewey_nodes(
    df: DataFrame,
    keys: list[str],
    text: str,
    spec: list[NodeType],
    fields: T.StructType,
    decode: Callable[[str, Any], tuple | None],
    roots: Callable[[str], list | None],
    only: list[str] | None = None,
) -> DataFrame:
    """One row per node: `keys`, path STRING, dewey ARRAY<INT>, and `fields`.

    roots(text) gives the top-level nodes of a record, None if it has none to give (missing, cut off); decode(path,
    value) gives the values of `fields`, or None for a node to leave out. only: node types to return; with ROOT, each record
    for which `roots` gives a list, an empty one too, has a row of its own, with an empty label. Parents precede children in `spec`. A NULL or blank
    text, a missing or NULL member and a member of another shape give no nodes; an empty table gives an empty one.
    Other columns of `df` never reach Python, whatever their names. The result keeps all nodes of a record; memory is
    bounded by the longest record and BATCH_NODES."""
    names, wanted = [n.name for n in spec], set(only or [n.name for n in spec])
    source = df.select(*keys, F.col(text).alias("_text")).where(F.trim("_text") != "")
    out = T.StructType([*[source.schema[k] for k in keys], T.StructField("path", T.StringType()), T.StructField("dewey", T.ArrayType(T.IntegerType())), *fields.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            texts = batch.column(len(keys))
            row: list[int] = []
            paths: list[str] = []
            labels: list[list[int]] = []
            values: list[tuple] = []

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                at = pa.array(row, pa.int32())
                columns = [batch.column(i).take(at).cast(schema.field(i).type) for i in range(len(keys))]
                columns += [pa.array(paths, pa.string()), pa.array(labels, schema.field("dewey").type)]
                columns += [pa.array(c, schema.field(len(keys) + 2 + i).type) for i, c in enumerate(zip(*values))]
                for x in (row, paths, labels, values):
                    x.clear()
                return pa.RecordBatch.from_arrays(columns, schema=schema)

            for i, t in enumerate(texts):
                nodes = roots(t.as_py())
                if nodes is not None and ROOT in wanted:
                    row.append(i)
                    paths.append(ROOT)
                    labels.append([])
                    values.append(decode(ROOT, None))
                if not nodes:
                    continue
                for name, found in zip(names, walk(nodes, spec)):
                    if name in wanted:
                        for label, v in found:
                            value = decode(name, v)
                            if value is not None:
                                row.append(i)
                                paths.append(name)
                                labels.append(label)
                                values.append(value)
                if len(row) >= BATCH_NODES:
                    yield flush()
            if row:
                yield flush()

    def without_gc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # parsed records hold no cycles, and looking for them takes a third of the time
        try:
            yield from run(batches)
        finally:
            gc.enable()

    return source.mapInArrow(without_gc, out)


def with_parent(nodes: DataFrame, spec: list[NodeType], name: str) -> DataFrame:
    """The nodes of one type with their parent's label, cut from their own."""
    parent = next(n for n in spec if n.name == name).parent
    depth = label_depth(spec, parent) if parent else 0
    return nodes.where(F.col("path") == name).withColumn("parent_dewey", F.slice("dewey", 1, depth))
