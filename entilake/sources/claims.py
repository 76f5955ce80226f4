"""Claims texts, as different exporters write them, and the snaks in them."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from entilake.operators.shred import NodeType, children, dewey_nodes, parse_json

#: The tree of one entity's claims. The places m, q and refs are the ordinals 0, 1 and 2 in the label.
CLAIM_TREE = [
    NodeType("claim"),
    NodeType("main", "claim", "m", 0, many=False),
    NodeType("qualifier", "claim", "q", 1),
    NodeType("reference", "claim", "refs", 2),
    NodeType("reference_snak", "reference"),
]
SNAK_PATHS = ["main", "qualifier", "reference_snak"]

#: Columns of a node. guid and rank are of claims, all others of snaks. Numbers are texts, as written.
NODE_FIELDS = T.StructType().add("guid", "string").add("rank", "string").add("kind", "string").add("property_id", "integer").add("vtype", "string").add("is_text", "boolean").add("value", "string").add("entity_kind", "string").add("entity_id", "string").add("amount", "string").add("latitude", "string").add("longitude", "string").add("time", "string").add("time_precision", "string")


def claim_list(text: str) -> list | None:
    """The claims in a text in reading order: of a list, or of an object with a list per property. A JSON string that
    holds such a text is opened, and `&quot;` is decoded where it stands for all quotes. None if it is not complete."""
    try:
        for _ in range(3):
            text = text.strip()
            if text.lstrip("[{ \t\r\n").startswith("&quot;"):
                text = text.replace("&quot;", '"')
            value = parse_json(text)
            if not isinstance(value, str):
                break
            text = value
    except ValueError:
        return None
    if isinstance(value, dict):
        return [c for v in value.values() for c in children(v)]
    return value if isinstance(value, list) else None


def _text(value: Any) -> str | None:
    """A scalar as text; NULL for null, objects and lists."""
    if value is None or isinstance(value, (dict, list)):
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def _whole(value: Any) -> int | None:
    try:
        n = int(value) if isinstance(value, (int, str)) and not isinstance(value, bool) else None
    except ValueError:
        return None
    return n if n is not None and -(2**31) <= n < 2**31 else None


def decode_node(path: str, node: Any) -> tuple:
    """NODE_FIELDS of a claim, reference or snak. The compact snaks R, S and T come out in the terms of full ones.
    A snak that is no list has only NULLs."""
    if path == "claim":
        return (_text(node.get("g")), _text(node.get("rank")), *[None] * 12) if isinstance(node, dict) else (None,) * 14
    if path == "reference" or not isinstance(node, list) or not node:
        return (None,) * 14
    tag, size = node[0], len(node)
    prop = _whole(node[1]) if size > 1 else None
    if tag == "S":
        v = node[2] if size > 2 else None
        return (None, None, "value", prop, "string", isinstance(v, str) and type(v) is str, _text(v), *[None] * 7)
    if tag == "R":
        v = node[2] if size > 2 else None
        return (None, None, "value", prop, "wikibase-entityid", False, _text(v), "item", _text(v), *[None] * 5)
    if tag == "T":
        v = node[3] if size > 3 else None
        return (None, None, "value", prop, "time", False, _text(v), None, None, None, None, None, _text(v), _text(node[2] if size > 2 else None))
    if tag != "value":
        return (None, None, _text(tag), prop, *[None] * 10)
    vtype, v = _text(node[2]) if size > 2 else None, node[3] if size > 3 else None
    if not isinstance(v, dict):
        return (None, None, "value", prop, vtype, type(v) is str, _text(v), *[None] * 7)
    get = v.get
    return (None, None, "value", prop, vtype, False, json.dumps(v, ensure_ascii=False), _text(get("entity-type")), _text(get("numeric-id")), _text(get("amount")), _text(get("latitude")), _text(get("longitude")), _text(get("time")), _text(get("precision")))


def decode_reference(path: str, node: Any) -> tuple | None:
    """(entity_kind, entity_id) of a snak that names an entity, entity_id a text as written; None for all other nodes."""
    if not isinstance(node, list) or len(node) < 3:
        return None
    if node[0] == "R":
        return ("item", _text(node[2]))
    if node[0] != "value" or node[2] != "wikibase-entityid" or len(node) < 4 or not isinstance(node[3], dict):
        return None
    return (_text(node[3].get("entity-type")), _text(node[3].get("numeric-id")))


def claim_nodes(df: DataFrame, keys: list[str], claims: str = "claims", only: list[str] | None = None) -> DataFrame:
    """All claim, reference and snak nodes of column `claims` with NODE_FIELDS, labelled (see dewey_nodes)."""
    return dewey_nodes(df, keys, claims, CLAIM_TREE, NODE_FIELDS, decode_node, claim_list, only)


def claim_labels(df: DataFrame, keys: list[str], claims: str = "claims", only: list[str] | None = None) -> DataFrame:
    """The nodes of claim_nodes without their values."""
    return dewey_nodes(df, keys, claims, CLAIM_TREE, T.StructType(), lambda path, node: (), claim_list, only)


def entity_references(df: DataFrame, keys: list[str], claims: str = "claims") -> DataFrame:
    """The snaks of `claims` that name an entity: `keys`, path, dewey, entity_kind, entity_id."""
    fields = T.StructType().add("entity_kind", "string").add("entity_id", "string")
    return dewey_nodes(df, keys, claims, CLAIM_TREE, fields, decode_reference, claim_list, SNAK_PATHS)
