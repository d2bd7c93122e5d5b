"""Customer views: integration, enrichment, latest state per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the integrated customer view, in order.
INTEGRATED_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone",
    "id_type", "id_number", "verification_status", "risk_level", "verified_at", "updated_at",
]


def integrate(crm: DataFrame, kyc: DataFrame, latest_only: bool = False) -> DataFrame:
    """CRM and KYC records joined on ``customer_id``.

    Two KYC rows of a customer give two rows. ``latest_only`` keeps the newest CRM and KYC row of a
    customer before the join.
    """
    if latest_only:
        crm = latest_per_key(crm, ["customer_id"], [F.col("updated_at")])
        kyc = latest_per_key(kyc, ["customer_id"], [F.col("verified_at"), F.col("id_number")])
    return crm.join(kyc, "customer_id", "inner").select(*INTEGRATED_COLUMNS)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is greatest by ``order``, which must be total within a key.

    An aggregate, not a window: each task first reduces its own rows to one per key, so a key with
    a large share of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    newest = F.max_by(F.struct(*rest), ranked).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def latest_of(df: DataFrame, key: str, value: object, order: list[Column]) -> DataFrame:
    """The newest row of one key."""
    return df.filter(F.col(key) == F.lit(value)).orderBy(*[o.desc() for o in order]).limit(1)


def fold_changes(changes: DataFrame, keys: list[str], order: list[Column], is_delete: Column) -> DataFrame:
    """Current state of a change log: the last change per key, without keys whose last change is a delete."""
    marked = changes.withColumn("_delete", F.coalesce(is_delete, F.lit(False)))
    return latest_per_key(marked, keys, order).filter(~F.col("_delete")).drop("_delete")


def _change_body(text: Column) -> Column:
    wrapped = F.array_contains(F.json_object_keys(text), "after")
    return F.when(wrapped, F.get_json_object(text, "$.after")).otherwise(text)


def _undecodable(text: Column) -> Column:
    """Whether a change is there but neither it nor its new state is a JSON object."""
    body = _change_body(text)
    return (text.isNotNull() & F.json_object_keys(text).isNull()) | (body.isNotNull() & F.json_object_keys(body).isNull())


def rejected_changes(messages: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Change messages that cannot be applied, as they came, with the ``rule`` they break."""
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rule = F.when(_undecodable(F.col(value).cast("string")), "undecodable").when(keyless, "no_key")
    return messages.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def unwrap_change(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """New row state of change messages: the ``after`` image, or the message itself when it is flat.

    A null message is a tombstone and sets ``is_delete``; so does an envelope whose ``after`` is null.
    A message that is no JSON object, or whose ``after`` is none, says nothing about its row and is left
    out; ``rejected_changes`` returns it.
    """
    text = F.col(value).cast("string")
    kept = [c for c in messages.columns if c != value]
    return (
        messages.filter(~_undecodable(text))
        .withColumn("_body", _change_body(text))
        .withColumn("is_delete", F.col("_body").isNull())
        .withColumn("_state", F.from_json("_body", schema))
        .select(*kept, "is_delete", "_state.*")
    )


def enrich(
    customers: DataFrame, responses: DataFrame, key: str, response: str, clock: Column | None = None
) -> DataFrame:
    """Customers with their landed KYC response; customers without one are left out."""
    return (
        customers.join(responses.select(key, response), key, "left")
        .withColumn("enrichment_time", F.current_timestamp() if clock is None else clock)
        .filter(F.col(response).isNotNull())
    )


def enrich_by_lookup(
    customers: DataFrame,
    key: str,
    open_lookup: Callable[[], Callable[[object], str | None]],
    response: str = "kyc_response_json",
    clock: Column | None = None,
) -> DataFrame:
    """Customers with the answer of a lookup service; a failed lookup gives null and drops the row.

    ``open_lookup`` runs once per partition and returns the function that answers one id, so that a
    connection is shared by all rows of the partition. Each distinct id is asked once.
    """
    ids = customers.select(key).distinct()
    schema = T.StructType([ids.schema[key], T.StructField(response, T.StringType())])

    def ask(batches: Iterator) -> Iterator:
        lookup = open_lookup()
        for batch in batches:
            yield batch.assign(**{response: [_quiet(lookup, value) for value in batch[key]]})

    return enrich(customers, ids.mapInPandas(ask, schema), key, response, clock)


def _quiet(lookup: Callable[[object], str | None], value: object) -> str | None:
    try:
        return lookup(value)
    except Exception:  # noqa: BLE001 - any failure of the service counts as no answer
        return None


def http_lookup(url: str, timeout: float = 5.0) -> Callable[[], Callable[[object], str | None]]:
    """Lookup over HTTP GET ``url?customer_id=...``: the JSON body, or null unless the status is 200."""

    def open_lookup() -> Callable[[object], str | None]:
        import json
        from urllib.parse import urlencode
        from urllib.request import urlopen

        def lookup(customer_id: object) -> str | None:
            query = urlencode({"customer_id": customer_id})
            with urlopen(f"{url}?{query}", timeout=timeout) as reply:  # noqa: S310
                return json.dumps(json.load(reply)) if reply.status == 200 else None

        return lookup

    return open_lookup


def notifications(
    customers: DataFrame,
    operation: str = "update",
    status: str = "success",
    source: str = "crm_kyc_ingestion",
    clock: Column | None = None,
) -> DataFrame:
    """One JSON notification per integrated customer, keyed by customer."""
    now = F.current_timestamp() if clock is None else clock
    body = F.struct(
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit(status).alias("validation_status"),
        F.struct(F.col("customer_id"), F.lit(operation).alias("operation_type")).alias("data"),
    )
    return customers.select(F.col("customer_id").alias("key"), F.to_json(body).alias("value"))
