"""Record layouts shared by all stages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The common person record, in output order.
COMMON_COLUMNS = [
    "source_name",
    "source_customer_id",
    "prefix",
    "first_name",
    "middle_name",
    "last_name",
    "generation_qualifier",
    "gender",
    "birth_date",
    "address_line_1",
    "address_line_2",
    "city",
    "state_code",
    "postal_code",
    "country_code",
    "phone",
    "email_address",
    "guest_id",
    "record_created_timestamp",
    "record_last_updated_timestamp",
]

# Common columns that carry no personal feature and keep their name.
UNPREFIXED_COLUMNS = [
    "source_name",
    "source_customer_id",
    "record_created_timestamp",
    "record_last_updated_timestamp",
    "pass_thru_data",
]

KEY_COLUMNS = ["source_name", "source_customer_id"]

# Columns of the common record that describe the person, after prefixing.
PERSON_COLUMNS = [f"ml_{c}" for c in COMMON_COLUMNS if c not in UNPREFIXED_COLUMNS and c != "guest_id"]

HISTORY_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("uxid", T.StringType()),
            T.StructField("uxid_confidence", T.DoubleType()),
            T.StructField("uxid_last_changed_timestamp", T.StringType()),
        ]
    )
)


def strings(names: Iterable[str]) -> T.StructType:
    """An all-string schema, the only kind vendor files have."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def prefixed_name(name: str) -> str:
    """Column name of a common-record field inside the identity tables."""
    if name == "guest_id":
        return "rules_guest_id"
    return name if name in UNPREFIXED_COLUMNS else f"ml_{name}"
