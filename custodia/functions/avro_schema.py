"""Avro record documents compiled to rules over a VARIANT column.

A message counts as valid when it could be encoded with the schema. Messages arrive as JSON, so
logical types are checked on their JSON carriers: decimal as a number or numeric text that fits
precision and scale, date and timestamp-millis as whole numbers. Unknown keys are errors, a missing
key takes the field's default (or null, which only a nullable union accepts).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from custodia.functions.json_schema import Fields, Node, undecodable_rules
from custodia.functions.rules import Rule

INT_RANGE = (-(2**31), 2**31 - 1)


def _decimal_fits(node: Node, precision: int, scale: int) -> Column:
    carrier = node.is_type("number") | node.is_type("string")
    exact = node.text.try_cast("decimal(38,18)")
    return carrier & (exact == exact.try_cast(f"decimal({precision},{scale})"))


def _matches(avro_type: object, node: Node) -> Column:
    if isinstance(avro_type, list):
        ok = F.lit(False)
        for branch in avro_type:
            ok = ok | F.coalesce(_matches(branch, node), F.lit(False))
        return ok
    if isinstance(avro_type, dict):
        if avro_type.get("logicalType") == "decimal":
            return _decimal_fits(node, avro_type["precision"], avro_type.get("scale", 0))
        if avro_type["type"] == "enum":
            return node.is_type("string") & node.text.isin(avro_type["symbols"])
        return _matches(avro_type["type"], node)
    if avro_type in ("string", "null", "boolean"):
        return node.is_type(avro_type)
    if avro_type in ("float", "double"):
        return node.is_type("number")
    if avro_type in ("int", "long"):
        whole = node.json_type == "BIG"
        if avro_type == "long":
            return whole
        return whole & node.whole.between(*INT_RANGE)
    raise ValueError(f"unsupported Avro type {avro_type!r}")


def _accepts_null(avro_type: object) -> bool:
    return avro_type == "null" or (isinstance(avro_type, list) and "null" in avro_type)


def as_properties(schema: dict) -> dict:
    """The record's field names in the form of a JSON Schema."""
    return {"properties": {f["name"]: {} for f in schema["fields"]}}


def avro_rules(schema: dict, fields: Fields) -> list[Rule]:
    """Rules of an Avro record document for a parsed message; ``fields`` stages what they read."""
    if schema.get("type") != "record":
        raise ValueError("only Avro records are supported")
    fields.know(as_properties(schema))
    root = Node(fields, ())
    is_object = root.is_type("object")
    names = F.array(*[F.lit(f["name"]) for f in schema["fields"]])
    rules = [
        *undecodable_rules(fields),
        Rule("$", "type", ~is_object, "not an object"),
        Rule("$", "unknown_field", F.size(F.array_except(F.json_object_keys(fields.value), names)) > 0, "unknown key"),
    ]
    for field in schema["fields"]:
        node = root.child(field["name"])
        wrong = node.present & ~F.coalesce(_matches(field["type"], node), F.lit(False))
        rules.append(Rule(field["name"], "type", is_object & wrong, "value does not fit the type"))
        if "default" not in field and not _accepts_null(field["type"]):
            rules.append(Rule(field["name"], "required", is_object & ~node.present, "key is missing"))
    return rules
