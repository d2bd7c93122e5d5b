"""JSON Schema documents compiled to rules over a VARIANT column.

The VARIANT keeps the difference between a missing key, a null and a wrongly typed value, which a
struct from ``from_json`` hides. Only the keywords that the documents use are supported; an unknown
keyword stops the job on the driver instead of being skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.parsing import ISO_DATETIME
from custodia.functions.records import EMAIL
from custodia.functions.rules import Rule, evaluated_once

ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
SUPPORTED = {
    "type", "properties", "required", "additionalProperties", "pattern",
    "minLength", "maxLength", "enum", "minimum", "maximum", "format",
}

# What a VARIANT calls the JSON types: STRING, VOID, BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, FLOAT,
# OBJECT<...>, ARRAY<...>. Three letters tell them apart.
VARIANT_TYPES = {
    "string": ["STR"],
    "null": ["VOI"],
    "boolean": ["BOO"],
    "number": ["BIG", "DEC", "DOU", "FLO"],
    "object": ["OBJ"],
    "array": ["ARR"],
}

IPV4 = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.|$)){4}(?<!\.)$"


def python_search(column: Column, pattern: str) -> Column:
    """Regex search where ``$`` knows only ``\\n`` and ``\\s \\d \\w`` are Unicode classes."""
    return column.rlike("(?dU)" + pattern)


def _backticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Fields:
    """Types and values of a message's fields, to be added to the frame before the rules.

    An object is opened once into a struct with a VARIANT per known key, and each type or value is
    read from there once, however many rules look at it.
    """

    def __init__(self, value: str = "value", document: str = "_document"):
        self.value, self.document = value, document
        self._keys: dict[tuple[str, ...], set[str]] = {}
        self._objects: dict[tuple[str, ...], tuple[str, Column]] = {}
        self._leaves: dict[tuple[str, tuple[str, ...]], tuple[str, Column]] = {}
        self._tests: dict[tuple[str, tuple[str, ...]], Column] = {}

    def know(self, schema: dict, keys: tuple[str, ...] = ()) -> None:
        """Note the keys that a JSON Schema names, so that their objects are opened with all of them."""
        names = [*schema.get("properties", {}), *schema.get("required", [])]
        self._keys.setdefault(keys, set()).update(names)
        for key, sub in schema.get("properties", {}).items():
            if "properties" in sub or "required" in sub:
                self.know(sub, (*keys, key))

    def object_of(self, node: Node) -> Column:
        """Struct with the known fields of an object; null when the place holds no object."""
        if node.keys not in self._objects:
            layout = ", ".join(f"{_backticked(key)}: variant" for key in sorted(self._keys[node.keys]))
            opened = F.try_variant_get(node.variant, "$", f"struct<{layout}>")
            self._objects[node.keys] = (f"_object_{len(self._objects)}", opened)
        return F.col(self._objects[node.keys][0])

    def leaf(self, kind: str, keys: tuple[str, ...], build: Callable[[], Column]) -> Column:
        """Reference to a type or value; ``build`` is called on first use."""
        if (kind, keys) not in self._leaves:
            column = build()
            self._leaves[kind, keys] = (f"_{kind}_{len(self._leaves)}", column)
        return F.col(self._leaves[kind, keys][0])

    def test(self, name: str, keys: tuple[str, ...], build: Callable[[], Column]) -> Column:
        """A type test, built once."""
        if (name, keys) not in self._tests:
            self._tests[name, keys] = build()
        return self._tests[name, keys]

    def add_to(self, df: DataFrame) -> DataFrame:
        """The frame with everything the rules read; a filter on their outcome looks nothing up again."""
        df = df.withColumn(self.document, F.try_parse_json(self.value))
        for keys in sorted(self._objects, key=len):
            name, column = self._objects[keys]
            df = df.withColumn(name, column)
        return evaluated_once(df, dict(self._leaves.values())).drop(
            self.document, *[name for name, _ in self._objects.values()]
        )

    @property
    def names(self) -> list[str]:
        """Columns that ``add_to`` leaves in the frame."""
        return [name for name, _ in self._leaves.values()]


class Node:
    """One place in the document: its JSON type and typed values as columns."""

    def __init__(self, fields: Fields, keys: tuple[str, ...]):
        self.fields, self.keys = fields, keys

    def child(self, key: str) -> Node:
        return Node(self.fields, (*self.keys, key))

    @property
    def variant(self) -> Column:
        if not self.keys:
            return F.col(self.fields.document)
        parent = Node(self.fields, self.keys[:-1])
        return self.fields.object_of(parent).getField(self.keys[-1])

    @property
    def json_type(self) -> Column:
        return self.fields.leaf("type", self.keys, self._json_type if self.keys else self._root_type)

    def _json_type(self) -> Column:
        return F.substring(F.schema_of_variant(self.variant), 1, 3)

    def _root_type(self) -> Column:
        # Spelling out the schema of the whole message is dear, and an object shows by its first character.
        opened = F.ltrim(self.fields.value, F.lit(" \t\r\n")).startswith("{")
        document = F.col(self.fields.document)
        whole = F.substring(F.schema_of_variant(document), 1, 3)
        return F.when(opened & document.isNotNull(), VARIANT_TYPES["object"][0]).otherwise(whole)

    @property
    def present(self) -> Column:
        return self.fields.test("present", self.keys, self.json_type.isNotNull)

    @property
    def text(self) -> Column:
        return self.fields.leaf("text", self.keys, lambda: F.try_variant_get(self.variant, "$", "string"))

    @property
    def number(self) -> Column:
        return self.fields.leaf("number", self.keys, lambda: F.try_variant_get(self.variant, "$", "double"))

    @property
    def whole(self) -> Column:
        return self.fields.leaf("whole", self.keys, lambda: F.try_variant_get(self.variant, "$", "bigint"))

    def is_any(self, names: list[str]) -> Column:
        """True when the value has one of the JSON types."""
        plain = [n for n in names if n != "integer"]
        known = self.json_type.isin([v for n in plain for v in VARIANT_TYPES[n]]) if plain else F.lit(False)
        return known | self.is_type("integer") if "integer" in names else known

    def is_type(self, name: str) -> Column:
        return self.fields.test(name, self.keys, lambda: self._type_test(name))

    def _type_test(self, name: str) -> Column:
        if name == "integer":
            whole_number = self.is_type("number") & (self.number == F.floor(self.number))
            return (self.json_type == "BIG") | whole_number
        if name not in VARIANT_TYPES:
            raise ValueError(f"unknown JSON Schema type {name!r}")
        return self.json_type.isin(VARIANT_TYPES[name])


def _format_broken(name: str, text: Column) -> Column:
    if name == "email":
        return ~text.rlike(EMAIL)
    if name == "date":
        return ~text.rlike(r"^\d{4}-\d{2}-\d{2}$") | text.try_cast("date").isNull()
    if name == "date-time":
        return ~text.rlike(ISO_DATETIME) | F.try_to_timestamp(text).isNull()
    if name == "ipv4":
        return ~text.rlike(IPV4)
    raise ValueError(f"unknown format {name!r}")


def _node_rules(schema: dict, node: Node, enforce_formats: bool) -> list[Rule]:
    unknown = set(schema) - SUPPORTED - ANNOTATIONS
    if unknown:
        raise ValueError(f"unsupported JSON Schema keywords: {sorted(unknown)}")
    field = ".".join(node.keys) or "$"
    rules: list[Rule] = []

    def add(code: str, broken: Column, message: str) -> None:
        rules.append(Rule(field, code, broken, message))

    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        add("type", node.present & ~node.is_any(names), f"not of type {' or '.join(names)}")
    if "enum" in schema:
        if not all(isinstance(v, str) for v in schema["enum"]):
            raise ValueError(f"only text values are supported in enum: {field}")
        ok = node.is_type("string") & node.text.isin(schema["enum"])
        add("enum", node.present & ~ok, "not an allowed value")
    is_text = node.is_type("string") if {"pattern", "minLength", "maxLength", "format"} & set(schema) else None
    if "pattern" in schema:
        add("pattern", is_text & ~python_search(node.text, schema["pattern"]), "does not match the pattern")
    if "minLength" in schema:
        add("minLength", is_text & (F.char_length(node.text) < schema["minLength"]), "too short")
    if "maxLength" in schema:
        add("maxLength", is_text & (F.char_length(node.text) > schema["maxLength"]), "too long")
    if "minimum" in schema:
        add("minimum", node.is_type("number") & (node.number < schema["minimum"]), "too small")
    if "maximum" in schema:
        add("maximum", node.is_type("number") & (node.number > schema["maximum"]), "too large")
    if enforce_formats and "format" in schema:
        add("format", is_text & _format_broken(schema["format"], node.text), f"not a valid {schema['format']}")

    nested = {"required", "additionalProperties"} & set(schema)
    is_object = node.is_type("object") if nested else None
    for key in schema.get("required", []):
        child = node.child(key)
        rules.append(Rule(".".join(child.keys), "required", is_object & ~child.present, "key is missing"))
    if schema.get("additionalProperties", True) is False:
        if node.keys:
            raise ValueError("additionalProperties: false is supported at the top level only")
        allowed = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
        extra = F.array_except(F.json_object_keys(node.fields.value), allowed)
        add("additionalProperties", is_object & (F.size(extra) > 0), "unknown key")
    elif schema.get("additionalProperties", True) is not True:
        raise ValueError("additionalProperties must be true or false")
    for key, sub in schema.get("properties", {}).items():
        rules += _node_rules(sub, node.child(key), enforce_formats)
    return rules


def json_schema_rules(schema: dict, fields: Fields, enforce_formats: bool = False) -> list[Rule]:
    """Rules of a document for a parsed message; ``fields`` then stages the columns they read.

    ``format`` is an annotation unless ``enforce_formats`` is set.
    """
    fields.know(schema)
    return [*undecodable_rules(fields), *_node_rules(schema, Node(fields, ()), enforce_formats)]


def undecodable_rules(fields: Fields) -> list[Rule]:
    """A null message and text that is not JSON are invalid."""
    value = F.col(fields.value)
    return [
        Rule("$", "null_message", value.isNull(), "message is null"),
        Rule("$", "undecodable", value.isNotNull() & ~Node(fields, ()).present, "not JSON"),
    ]


def non_empty_object(value: Column) -> Column:
    """True when the text is a JSON object with at least one key; never null."""
    return F.coalesce(F.size(F.json_object_keys(value)) > 0, F.lit(False))
