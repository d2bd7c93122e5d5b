"""Validate messages that name the schema they claim to follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.contracts import AVRO_SUFFIX, JSON_SUFFIX
from custodia.functions.avro_schema import as_properties, avro_rules
from custodia.functions.json_schema import Fields, json_schema_rules
from custodia.functions.rules import Rule, all_hold, validate


def rules_for(schema_path: str, schema: dict, fields: Fields, **options) -> list[Rule]:
    """Rules by the dialect that the path's suffix names."""
    if schema_path.endswith(JSON_SUFFIX):
        return json_schema_rules(schema, fields, **options)
    if schema_path.endswith(AVRO_SUFFIX):
        return avro_rules(schema, fields)
    raise ValueError(f"unknown schema dialect: {schema_path!r}")


def validate_messages(
    df: DataFrame, schema_path: str, schema: dict, value: str = "value", enforce_formats: bool = False
) -> DataFrame:
    """Add ``is_valid`` and ``errors`` for messages that all follow one schema.

    A message is parsed once, each of its fields is looked up once, and the rules read those columns.
    """
    options = {"enforce_formats": enforce_formats} if schema_path.endswith(JSON_SUFFIX) else {}
    fields = Fields(value)
    rules = rules_for(schema_path, schema, fields, **options)
    return validate(fields.add_to(df), rules, once=False).drop(*fields.names)


def validate_by_path(
    df: DataFrame, catalogue: dict[str, dict], value: str = "value", path: str = "schema_path"
) -> DataFrame:
    """Add ``is_valid`` for messages that each name a schema.

    A path without a document, with another suffix, empty or null makes the message invalid.
    Schemas share the looked-up fields, so a field that several of them check is read once.
    """
    fields = Fields(value)
    verdict = F.lit(False)
    for schema_path, schema in catalogue.items():
        fields.know(schema if schema_path.endswith(JSON_SUFFIX) else as_properties(schema))
    for schema_path, schema in catalogue.items():
        rules = rules_for(schema_path, schema, fields)
        verdict = F.when(F.col(path) == schema_path, all_hold(rules)).otherwise(verdict)
    return fields.add_to(df).withColumn("is_valid", verdict).drop(*fields.names)
