"""Registered queries, derived views and scratch folders."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custodia.session import prepare, shared_dir
from workload.views import VIEWS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
_FROM_TABLE = re.compile(r"\bFROM (" + "|".join(TABLES) + r")\b")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES: dict[str, str] = {}


class Data:
    """The given tables and the views derived from them, as frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """SQL over the given tables, read from their files."""
        return self.spark.sql(_FROM_TABLE.sub(lambda m: f"FROM parquet.`{self.sf_dir}/{m[1]}.parquet`", text))

    def view(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])

    def scratch(self) -> str:
        """A new folder that all executors reach."""
        return f"{shared_dir(self.spark).rstrip('/')}/runs/{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query; ``sql`` may use the named views as tables."""

    def register(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Data(spark, sf_dir))
        MODULES[name] = build.__module__.rpartition(".")[2]
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql)
        return build

    return register


def with_views(names: list[str], body: str) -> str:
    """SQL text with the named views in front as common table expressions."""
    body = body.strip()
    if not names:
        return body
    heads = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in names)
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"
