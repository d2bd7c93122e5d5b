"""Avro schema evolution: verdicts, projections and the errors of single rows."""

import pytest
from pyspark.sql import functions as F

from custodia.contracts import builtin
from custodia.functions.schema_evolution import compatibility, expanded, findings, resolve_messages, resolved, sql_type


def record(*fields, name="R"):
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t, **m} for n, t, m in fields]}


def one(kind, **more):
    return record(("a", kind, more))


@pytest.mark.parametrize(
    "writer, reader, readable",
    [
        ("int", "long", True), ("int", "double", True), ("long", "float", True), ("float", "double", True),
        ("long", "int", False), ("double", "float", False), ("string", "int", False), ("boolean", "string", False),
        ("string", "bytes", True), ("string", ["null", "string"], True), (["null", "string"], "string", False),
        (["null", "int"], ["null", "long"], True), ("int", ["null", "string"], False), ("null", ["null", "string"], True),
        ({"type": "array", "items": "int"}, {"type": "array", "items": "long"}, True),
        ({"type": "array", "items": "long"}, {"type": "array", "items": "int"}, False),
        ({"type": "map", "values": "int"}, {"type": "map", "values": "double"}, True),
        ({"type": "map", "values": "int"}, {"type": "array", "items": "int"}, False),
        ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, {"type": "enum", "name": "E", "symbols": ["A"]}, False),
        ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, {"type": "enum", "name": "E", "symbols": ["A"], "default": "A"}, True),
        ({"type": "enum", "name": "E", "symbols": ["A"]}, {"type": "enum", "name": "X", "symbols": ["A"]}, False),
        ({"type": "enum", "name": "E", "symbols": ["A"]}, {"type": "enum", "name": "X", "symbols": ["A"], "aliases": ["E"]}, True),
        ({"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2}, {"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2}, True),
        ({"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2}, {"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 3}, False),
        ({"type": "long", "logicalType": "timestamp-millis"}, "long", True),
        (record(("x", "int", {}), name="I"), record(("x", "long", {}), ("y", "string", {"default": ""}), name="I"), True),
        (record(("x", "int", {}), name="I"), record(("x", "long", {}), ("y", "string", {}), name="I"), False),
    ],
)
def test_types_that_can_be_read(writer, reader, readable):
    assert (not findings(one(writer), one(reader))) == readable


def test_verdicts_of_two_versions():
    old = record(("id", "int", {}), ("name", "string", {}))
    assert compatibility(old, old) == "FULL"
    assert compatibility(record(("id", "int", {}), ("name", "string", {}), ("x", "int", {"default": 0})), old) == "FULL"
    assert compatibility(record(("id", "long", {}), ("name", "string", {})), old) == "BACKWARD"
    assert compatibility(record(("id", "int", {}), ("name", "string", {}), ("x", "int", {})), old) == "FORWARD"
    assert compatibility(record(("id", "string", {}), ("name", "string", {})), old) == "NONE"
    assert [(f.path, f.partial) for f in findings(one(["null", "int"]), one("int"))] == [("$.a", True)]
    customer = builtin("registry_customer.avsc")
    assert compatibility(customer, customer) == "FULL"


def test_names_are_expanded_and_cycles_refused():
    place = record(("street", "string", {}), name="Place")
    doc = record(("home", place, {}), ("work", ["null", "Place"], {"default": None}))
    assert sql_type(expanded(doc)) == "struct<`home`: struct<`street`: string>, `work`: struct<`street`: string>>"
    with pytest.raises(ValueError, match="holds itself"):
        expanded(record(("next", ["null", "R"], {})))
    with pytest.raises(ValueError, match="unsupported"):
        expanded(one("Lost"))


def test_rows_that_cannot_be_read_keep_their_paths(spark):
    symbols = {"type": "enum", "name": "E", "symbols": ["A", "B"]}
    writer = record(("n", ["null", "int"], {}), ("e", symbols, {}), ("l", {"type": "array", "items": symbols}, {}), ("m", {"type": "map", "values": "int"}, {}))
    only = {**symbols, "symbols": ["A"]}
    reader = record(("count", "long", {"aliases": ["n"]}), ("e", only, {}), ("l", {"type": "array", "items": only}, {}), ("m", {"type": "map", "values": "double"}, {}))
    texts = [
        '{"n": 1, "e": "A", "l": ["A"], "m": {"k": 2}}',
        '{"n": null, "e": "B", "l": ["A", "B"], "m": {}}',
        '{"e": "A", "l": [], "m": {"k": null}}',
        '{"n": 1, "e": "A", "m": {}}',
        "[1]", "", "{", None,
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = frame.select("i", resolve_messages(F.col("t"), F.lit("v"), {"v": writer}, reader).alias("o")).orderBy("i").collect()
    assert out[0].o.record.asDict() == {"count": 1, "e": "A", "l": ["A"], "m": {"k": 2.0}} and out[0].o.errors == []
    assert [r.o.errors for r in out[1:]] == [["$.count", "$.e", "$.l[]"], ["$.count", "$.m{}"], ["$.l"], ["$"], ["$"], ["$"], ["$"]]
    assert all(r.o.record is None for r in out[1:])
    unknown = frame.select(resolve_messages(F.col("t"), F.lit("w"), {"v": writer}, reader).alias("o")).first().o
    assert unknown.record is None and unknown.errors == ["$"]


def test_a_reader_that_can_take_nothing_is_an_error(spark):
    with pytest.raises(ValueError, match="cannot take"):
        resolved(F.col("x"), one("string"), one("int"))


def test_a_message_is_parsed_and_opened_once(spark):
    writer = record(*((f"f{i}", "int", {}) for i in range(20)))
    frame = spark.createDataFrame([('{"f0": 1}',)], "t string")
    column = resolve_messages(F.col("t"), F.lit("v"), {"v": writer}, writer)
    plan = frame.select(column.alias("o"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json") == 1 and plan.count("variant_get") == 1
