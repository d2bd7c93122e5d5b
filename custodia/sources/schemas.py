"""Declared row schemas, rename maps and column defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "boolean": T.BooleanType(), "bigint": T.LongType(), "int": T.IntegerType(), "money": T.DecimalType(15, 2),
}

# Column names, types and order of the declared rows.
CRM_STREAM = _schema("id string, name string, email string, created_at timestamp")
TRANSACTION_STREAM = _schema(
    "transaction_id string, customer_id string, amount double, currency string, timestamp timestamp"
)
CRM_CSV = _schema(
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "address string, updated_at timestamp"
)
KYC_CSV = _schema(
    "customer_id string, id_type string, id_number string, verification_status string, "
    "risk_level string, verified_at timestamp"
)
KYC_DOCUMENT = _schema(
    "customer_id string, kyc_status string, risk_score double, documents_verified boolean, verification_date bigint"
)
CUSTOMER_TABLE = _schema(
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "address string, registration_date date, status string"
)
TRANSACTION_TABLE = _schema(
    "transaction_id string, customer_id string, amount money, currency string, transaction_type string, "
    "timestamp timestamp, merchant string, category string"
)
SCORING_REQUEST = "customer_id string, features map<string, double>, model_version string"

# Declared lengths and defaults of the relational tables.
CUSTOMER_LENGTHS = {
    "customer_id": 50, "first_name": 100, "last_name": 100, "email": 255, "phone": 50, "status": 20,
}
TRANSACTION_LENGTHS = {
    "transaction_id": 50, "customer_id": 50, "currency": 3, "transaction_type": 20, "merchant": 255, "category": 50,
}
CUSTOMER_DEFAULTS = {"status": "ACTIVE"}
TRANSACTION_DEFAULTS = {"currency": "MAD"}

# Canonical silver names, by the names that sources use.
CRM_RENAMES = {"id": "customer_id", "phone_number": "phone"}


def conform(df: DataFrame, renames: dict[str, str] = CRM_RENAMES) -> DataFrame:
    """Rename source columns to the canonical names."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns and new not in df.columns})


def with_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Table defaults for columns a source left out or left null."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


def to_money(df: DataFrame, column: str = "amount") -> DataFrame:
    """Silver type of an amount: ``decimal(15, 2)``, null when it does not fit."""
    return df.withColumn(column, F.col(column).try_cast("decimal(15,2)"))


def additive_columns(current: T.StructType, incoming: T.StructType) -> list[str]:
    """Columns a write would add; a changed type of an existing column is an error."""
    known = {f.name: f.dataType for f in current.fields}
    changed = [f.name for f in incoming.fields if f.name in known and known[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns change type: {changed}")
    return [f.name for f in incoming.fields if f.name not in known]
