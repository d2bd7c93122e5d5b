"""Queries over messages of several schema versions, made from all orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.functions.schema_evolution import compatibility, findings, resolve_messages
from workload.registry import query


def _record(*fields: dict) -> dict:
    return {"type": "record", "name": "Order", "fields": list(fields)}


def _field(name: str, kind: object, **more: object) -> dict:
    return {"name": name, "type": kind, **more}


def _status(*symbols: str, **more: object) -> dict:
    return {"type": "enum", "name": "Status", "symbols": list(symbols), **more}


_KEY, _CUSTOMER, _PRICE = _field("order_id", "long"), _field("customer_id", "long"), _field("price", "double")
_PLACE = {"type": "record", "name": "Place", "fields": [_field("clerk", "string")]}
_PLACE_NEW = {"type": "record", "name": "Place", "fields": [_field("clerk", "string"), _field("region", "string", default="all")]}
READER = _record(
    _KEY, _field("customer_id", "long", aliases=["cust"]), _PRICE, _field("lines", "long", default=1),
    _field("status", _status("F", "O", default="O")), _field("priority", "string", default="none"),
    _field("place", _PLACE_NEW, default={"clerk": "?", "region": "all"}), _field("tags", {"type": "array", "items": "long"}, default=[]),
)
VERSIONS = {
    1: _record(_KEY, _field("cust", "int"), _PRICE, _field("lines", "int"), _field("status", _status("F", "O", "P"))),
    2: _record(
        _KEY, _CUSTOMER, _PRICE, _field("status", _status("F", "O")), _field("priority", ["null", "string"]),
        _field("place", _PLACE), _field("tags", {"type": "array", "items": "int"}),
    ),
    3: READER,
    4: _record(_KEY, _CUSTOMER, _PRICE),
}


def messages(d):
    """(o_orderkey, version, message): unreadable texts, lost fields and nulls are planted by the key."""
    key = F.col("o_orderkey")
    version = F.when(key % 4 == 0, 4).otherwise(key % 4).cast("int")
    status = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus")).alias("status")
    base = [key.alias("order_id"), F.col("o_totalprice").alias("price")]
    customer = F.col("o_custkey").alias("customer_id")
    tags = F.array(F.col("o_custkey") % 5, key % 7).alias("tags")
    clerk = F.concat(F.lit("c"), F.col("o_custkey") % 9).alias("clerk")
    one = F.struct(*base, F.when(key % 32 != 5, F.col("o_custkey")).alias("cust"), (F.col("o_custkey") % 7).alias("lines"), F.col("o_orderstatus").alias("status"))
    two = F.struct(*base, customer, status, F.when(key % 8 != 2, F.col("o_orderpriority")).alias("priority"), F.struct(clerk).alias("place"), tags)
    three = F.struct(
        *base, customer, (F.col("o_custkey") % 3).alias("lines"), status, F.col("o_orderpriority").alias("priority"),
        F.struct(clerk, F.lit("north").alias("region")).alias("place"), tags,
    )
    text = F.when(version == 1, F.to_json(one)).when(version == 2, F.to_json(two)).when(version == 3, F.to_json(three))
    text = F.when(key % 32 == 1, F.lit("{oops")).otherwise(text.when(version == 4, F.to_json(F.struct(*base, customer))))
    return d.table("orders").select("o_orderkey", version.alias("version"), text.alias("message"))


@query(
    "schema_compatibility",
    """WITH verdicts(version, verdict, n_findings) AS (VALUES (1, 'BACKWARD', 0), (2, 'NONE', 1), (3, 'FULL', 0), (4, 'FORWARD', 1))
    SELECT v.version, v.verdict, CAST(v.n_findings AS INTEGER) AS n_findings, m.messages
    FROM verdicts v JOIN (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 4 ELSE o_orderkey % 4 END AS version, count(*) AS messages
      FROM orders GROUP BY 1) m ON m.version = v.version""",
)
def schema_compatibility(d):
    """How the reader's schema stands to each version, with the messages that were written under it."""
    rows = [(v, compatibility(READER, w), len(findings(w, READER))) for v, w in VERSIONS.items()]
    verdicts = d.spark.createDataFrame(rows, "version int, verdict string, n_findings int")
    counts = messages(d).groupBy("version").agg(F.count("*").alias("messages"))
    return counts.join(F.broadcast(verdicts), "version").select("version", "verdict", "n_findings", "messages")


@query(
    "avro_resolved_messages",
    """WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 4 ELSE o_orderkey % 4 END AS v FROM orders),
    e AS (SELECT *, CASE WHEN o_orderkey % 32 = 1 OR v = 4 THEN '$' WHEN o_orderkey % 32 = 5 THEN '$.customer_id'
      WHEN o_orderkey % 8 = 2 THEN '$.priority' ELSE '' END AS errors FROM o)
    SELECT o_orderkey, errors,
      CASE WHEN errors = '' THEN o_custkey ELSE -1 END AS customer_id, CASE WHEN errors = '' THEN o_totalprice END AS price,
      CASE WHEN errors = '' THEN CASE v WHEN 1 THEN o_custkey % 7 WHEN 2 THEN 1 ELSE o_custkey % 3 END ELSE -1 END AS lines,
      CASE WHEN errors = '' THEN CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END END AS status,
      CASE WHEN errors = '' THEN CASE WHEN v = 1 THEN 'none' ELSE o_orderpriority END END AS priority,
      CASE WHEN errors = '' THEN CASE WHEN v = 1 THEN '?' ELSE concat('c', CAST(o_custkey % 9 AS VARCHAR)) END END AS clerk,
      CASE WHEN errors = '' THEN CASE WHEN v = 3 THEN 'north' ELSE 'all' END END AS region,
      CASE WHEN errors = '' THEN CASE WHEN v = 1 THEN 0 ELSE o_custkey % 5 + o_orderkey % 7 END ELSE -1 END AS tag_sum
    FROM e""",
)
def avro_resolved_messages(d):
    """Messages of all versions as the reader has them; the fourth version cannot be read at all."""
    writers = {v: w for v, w in VERSIONS.items() if all(f.partial for f in findings(w, READER))}
    out = resolve_messages(F.col("message"), F.col("version"), writers, READER)
    read = messages(d).select("o_orderkey", out.alias("out"))
    record = "out.record"
    total = F.aggregate(f"{record}.tags", F.lit(0).cast("bigint"), lambda s, x: s + x)

    def number(c):  # -1 where a record could not be read
        return F.coalesce(c, F.lit(-1).cast("bigint"))

    return read.select(
        "o_orderkey", F.array_join("out.errors", ",").alias("errors"),
        *(F.col(f"{record}.{c}").alias(c) for c in ("price", "status", "priority")),
        *(number(F.col(f"{record}.{c}")).alias(c) for c in ("customer_id", "lines")),
        F.col(f"{record}.place.clerk").alias("clerk"), F.col(f"{record}.place.region").alias("region"), number(total).alias("tag_sum"),
    )
