"""Avro schema evolution: what a reader's schema makes of messages written with another one.

``findings`` compares two documents without data, ``compatibility`` gives the verdict on two versions, and
``resolved`` compiles reader against writer into one projection: fields found by name or alias, numbers promoted,
missing fields filled from defaults, symbols that the reader lacks replaced by its enum's default, records, arrays
and maps followed down. Rows that only their own values make unreadable (a null, an unknown symbol) get an error.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

PROMOTIONS = {
    "int": ("long", "float", "double"),
    "long": ("float", "double"),
    "float": ("double",),
    "string": ("bytes",),
    "bytes": ("string",),
}
SQL_TYPES = {"string": "string", "boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double", "bytes": "binary"}
NAMED = ("record", "enum")


@dataclass(frozen=True)
class Finding:
    """Something that a reader cannot take. ``partial``: only rows that hold a certain value are concerned."""

    path: str
    reason: str
    partial: bool = False


def expanded(schema: object, known: dict | None = None, open_: tuple[str, ...] = ()) -> object:
    """The document with names of earlier types replaced by the types; a type inside itself is an error."""
    known = {} if known is None else known
    if isinstance(schema, list):
        return [expanded(s, known, open_) for s in schema]
    if isinstance(schema, str):
        if schema in open_:
            raise ValueError(f"type {schema!r} holds itself")
        if schema not in known and schema not in SQL_TYPES and schema != "null":
            raise ValueError(f"unsupported Avro type {schema!r}")
        return known.get(schema, schema)
    kind = schema["type"]
    if kind == "record":
        fields = [{**f, "type": expanded(f["type"], known, (*open_, schema["name"]))} for f in schema["fields"]]
        known[schema["name"]] = {**schema, "fields": fields}
        return known[schema["name"]]
    if kind == "enum":
        known[schema["name"]] = schema
        return schema
    if kind == "array":
        return {**schema, "items": expanded(schema["items"], known, open_)}
    if kind == "map":
        return {**schema, "values": expanded(schema["values"], known, open_)}
    if "logicalType" in schema:
        return schema
    return expanded(kind, known, open_)


def _kind(avro: object) -> str:
    if isinstance(avro, list):
        return "union"
    return avro["type"] if isinstance(avro, dict) else avro


def _branches(avro: object) -> list:
    return [b for b in avro if b != "null"] if isinstance(avro, list) else [avro]


def _takes_null(avro: object) -> bool:
    return avro == "null" or (isinstance(avro, list) and "null" in avro)


def sql_type(avro: object) -> str:
    """The type of a column that carries values of an expanded Avro type; logical numbers keep their carriers."""
    kind = _kind(avro)
    if kind == "union":
        some = _branches(avro)
        if len(some) != 1:
            raise ValueError(f"a union of several types has no column type: {avro!r}")
        return sql_type(some[0])
    if kind == "record":
        return f"struct<{', '.join(f'`{f["name"]}`: {sql_type(f["type"])}' for f in avro['fields'])}>"
    if kind == "array":
        return f"array<{sql_type(avro['items'])}>"
    if kind == "map":
        return f"map<string, {sql_type(avro['values'])}>"
    if kind == "enum":
        return "string"
    if isinstance(avro, dict) and avro.get("logicalType") == "decimal":
        return f"decimal({avro['precision']},{avro.get('scale', 0)})"
    return SQL_TYPES[kind]


def _same_name(writer: dict, reader: dict) -> bool:
    return writer["name"] in (reader["name"], *reader.get("aliases", ()))


def _written_field(writer: dict, field: dict) -> dict | None:
    """The writer's field that a reader's field reads: by name, else by the reader's aliases in their order."""
    by_name = {f["name"]: f for f in writer["fields"]}
    return next((by_name[n] for n in (field["name"], *field.get("aliases", ())) if n in by_name), None)


def _chosen(writer: object, reader: object) -> object | None:
    """The reader's branch that takes the writer's type: the first of the same kind, else the first that can."""
    some = _branches(reader)
    same = [b for b in some if _kind(b) == _kind(writer) and not _hard(writer, b)]
    return next(iter(same or [b for b in some if not _hard(writer, b)]), None)


def _hard(writer: object, reader: object) -> list[Finding]:
    return [f for f in _compare(writer, reader, "$") if not f.partial]


def _compare(writer: object, reader: object, path: str) -> list[Finding]:
    if isinstance(writer, list):
        found = [f for branch in _branches(writer) for f in _compare(branch, reader, path)]
        if "null" in writer and not _takes_null(reader):
            found.append(Finding(path, "null cannot be read", partial=True))
        return found
    if isinstance(reader, list):
        branch = _chosen(writer, reader)
        if branch is None:
            return [] if writer == "null" and "null" in reader else [Finding(path, "no branch takes the type")]
        return _compare(writer, branch, path)
    kind, other = _kind(writer), _kind(reader)
    if kind != other:
        logical = any(isinstance(t, dict) and t.get("logicalType") == "decimal" for t in (writer, reader))
        if not logical and other in PROMOTIONS.get(kind, ()):
            return []
        return [Finding(path, f"{kind} cannot be read as {other}")]
    if kind in NAMED and not _same_name(writer, reader):
        return [Finding(path, f"{kind} has another name")]
    if kind == "array":
        return _compare(writer["items"], reader["items"], f"{path}[]")
    if kind == "map":
        return _compare(writer["values"], reader["values"], f"{path}{{}}")
    if kind == "enum":
        lost = set(writer["symbols"]) - set(reader["symbols"])
        return [Finding(path, "symbol cannot be read", partial=True)] if lost and "default" not in reader else []
    if kind == "record":
        found = []
        for field in reader["fields"]:
            below, source = f"{path}.{field['name']}", _written_field(writer, field)
            if source is not None:
                found += _compare(source["type"], field["type"], below)
            elif "default" not in field:
                found.append(Finding(below, "field is not written and has no default"))
        return found
    shapes = [(t.get("logicalType"), t.get("precision"), t.get("scale", 0)) if isinstance(t, dict) and t.get("logicalType") == "decimal" else None for t in (writer, reader)]
    return [] if shapes[0] == shapes[1] else [Finding(path, "decimal has another precision or scale")]


def findings(writer: dict, reader: dict) -> list[Finding]:
    """All that keeps ``reader`` from taking every message of ``writer``."""
    return _compare(expanded(writer), expanded(reader), "$")


def compatibility(new: dict, old: dict) -> str:
    """FULL, BACKWARD (the new one reads the old one's messages), FORWARD (the other way round) or NONE."""
    backward, forward = not findings(old, new), not findings(new, old)
    return {(True, True): "FULL", (True, False): "BACKWARD", (False, True): "FORWARD", (False, False): "NONE"}[backward, forward]


def _default(field: dict) -> Column:
    value, kind = field["default"], sql_type(field["type"])
    if isinstance(value, (dict, list)):
        return F.from_json(F.lit(json.dumps(value)), kind)
    return F.lit(value).cast(kind)


def _project(value: Column, writer: object, reader: object, path: str) -> tuple[Column, list[tuple[str, Column]]]:
    """(the value as the reader has it, conditions under which a row cannot be read with their paths)."""
    errors: list[tuple[str, Column]] = []
    if not _takes_null(writer) or not _takes_null(reader):
        errors.append((path, value.isNull()))
    writer = _branches(writer)[0]
    reader = _chosen(writer, reader)
    kind = _kind(writer)
    if kind == "record":
        parts = []
        for field in reader["fields"]:
            source = _written_field(writer, field)
            if source is None:
                part = _default(field)
            else:
                part, below = _project(value[source["name"]], source["type"], field["type"], f"{path}.{field['name']}")
                errors += [(p, value.isNotNull() & c) for p, c in below]
            parts.append(part.alias(field["name"]))
        return F.when(value.isNotNull(), F.struct(*parts)), errors
    if kind in ("array", "map"):
        inner = "items" if kind == "array" else "values"
        below = f"{path}[]" if kind == "array" else f"{path}{{}}"

        def part(x):
            return _project(x, writer[inner], reader[inner], below)[0]

        def wrong(x):
            bad = F.lit(False)
            for _, condition in _project(x, writer[inner], reader[inner], below)[1]:
                bad = bad | F.coalesce(condition, F.lit(False))
            return bad

        if kind == "array":
            return F.transform(value, part), [*errors, (below, F.exists(value, wrong))]
        return F.transform_values(value, lambda _, x: part(x)), [*errors, (below, F.exists(F.map_values(value), wrong))]
    if kind == "enum":
        known = value.isin(reader["symbols"])
        if "default" in reader:
            return F.when(value.isNotNull() & ~known, F.lit(reader["default"])).otherwise(value), errors
        return F.when(known, value), [*errors, (path, value.isNotNull() & ~known)]
    return value.cast(sql_type(reader)), errors


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def resolved(value: Column, writer: dict, reader: dict) -> tuple[Column, Column]:
    """(record as the reader has it, array of the paths that keep a row from being read) of a column that holds
    the writer's record as a struct of ``sql_type``; a document that can read no message at all is an error."""
    writer, reader = expanded(writer), expanded(reader)
    hard = _hard(writer, reader)
    if hard:
        raise ValueError(f"the reader cannot take the writer's messages: {hard}")
    record, errors = _project(value, writer, reader, "$")
    paths = F.array_distinct(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(p)) for p, c in errors])))
    return record, paths


def resolve_messages(message: Column, version: Column, writers: dict[object, dict], reader: dict) -> Column:
    """struct(record, errors) of JSON messages written under several versions; one projection for all of them.

    A message that is no JSON object or null, or of a version that is not known, has the error ``$``; a record with
    errors is null. Each message is parsed once and opened with its own version's type.
    """
    kind = sql_type(expanded(reader))

    def made(value: Column, writer: dict) -> Column:
        record, errors = resolved(value, writer, reader)
        return _bound(errors, lambda found: F.struct(F.when(F.size(found) == 0, record).cast(kind).alias("record"), found.alias("errors")))

    def opened(document: Column) -> Column:
        is_object = F.schema_of_variant(document).startswith("OBJECT")
        out = F.struct(F.lit(None).cast(kind).alias("record"), F.array(F.lit("$")).alias("errors"))
        for name, writer in writers.items():
            typed = F.try_variant_get(document, "$", sql_type(expanded(writer)))
            out = F.when((version == name) & is_object, _bound(typed, partial(made, writer=writer))).otherwise(out)
        return out

    return _bound(F.try_parse_json(message), opened)
