"""Identity-shaped views over the driver's ``events`` table.

One SQL text serves Spark and the oracle.  The view holds nulls, blanks, mixed
case, padded e-mails, repeated keys and equal times on purpose.  The identity
store holds what was known before the cut-off; the batch is everything newer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import top_per_group

CUTOFF = "2024-01-21"

IDENT_SQL = """
SELECT
  event_id AS batch_record_id,
  CASE WHEN event_type IN ('view','click') THEN 'SRC_WEB' WHEN event_type = 'purchase' THEN 'SRC_POS' ELSE 'SRC_APP' END AS source_name,
  concat('c', cast(event_id % 997 AS string)) AS source_customer_id,
  CASE WHEN event_id % 6 = 5 THEN NULL ELSE concat('First', cast(user_id % 30 AS string)) END AS ml_first_name,
  CASE WHEN event_id % 6 = 5 OR user_id % 4 > 0 THEN NULL ELSE concat('M', cast(user_id % 7 AS string)) END AS ml_middle_name,
  CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 11 = 0 THEN concat('Last', cast(user_id % 50 AS string), 'x') ELSE concat('Last', cast(user_id % 50 AS string)) END AS ml_last_name,
  CASE WHEN event_id % 6 = 5 OR event_id % 9 = 0 THEN NULL ELSE concat(cast(1950 + user_id % 50 AS string), '-0', cast(1 + user_id % 9 AS string), '-1', cast(user_id % 10 AS string)) END AS ml_birth_date,
  CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 4 = 0 THEN ' ' ELSE concat(cast(user_id AS string), ' Main St') END AS ml_address_line_1,
  CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 8 = 3 THEN concat('Apt ', cast(user_id % 5 AS string)) ELSE '' END AS ml_address_line_2,
  CASE WHEN event_id % 6 = 5 THEN NULL ELSE lpad(cast(10000 + user_id % 90 AS string), 5, '0') END AS ml_postal_code,
  CASE WHEN event_id % 6 = 5 THEN NULL ELSE concat('555', lpad(cast(user_id AS string), 7, '0')) END AS ml_phone,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 12 = 11 AND event_id % 5 = 1 THEN concat('solo', cast(event_id % 700 AS string), '@ex.com') WHEN event_id % 7 = 1 THEN concat(' USER', cast(user_id % 40 AS string), '@Ex.com ') ELSE concat('user', cast(user_id % 40 AS string), '@ex.com') END AS ml_email_address,
  CASE WHEN event_id % 5 = 0 OR event_id % 6 = 5 THEN NULL ELSE concat('g', cast(cast(floor((user_id + CASE WHEN user_id % 10 = 9 THEN 0 ELSE event_id % 2 END) / 2) AS bigint) AS string)) END AS rules_guest_id,
  CASE WHEN event_id % 3 = 0 OR event_id % 12 = 11 THEN NULL ELSE md5(concat('u', cast(user_id AS string))) END AS uxid,
  CASE WHEN event_id % 3 = 0 OR event_id % 12 = 11 THEN NULL ELSE cast(event_id % 101 AS double) / 100 END AS uxid_confidence,
  CASE WHEN event_id % 3 = 0 OR event_id % 12 = 11 THEN NULL ELSE concat('2024-01-', lpad(cast(1 + event_id % 28 AS string), 2, '0'), 'T', lpad(cast(event_id % 24 AS string), 2, '0'), ':00:00.000Z') END AS id_res_last_updated_timestamp,
  concat(substr(cast(ts AS string), 1, 10), 'T', substr(cast(ts AS string), 12, 8), '.000Z') AS record_last_updated_timestamp
FROM events
"""

# The newest row per key before the cut-off; ties by the higher record id.
STORE_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY source_name, source_customer_id
    ORDER BY record_last_updated_timestamp DESC, batch_record_id DESC) AS rn
  FROM ident WHERE record_last_updated_timestamp < '{CUTOFF}') WHERE rn = 1
"""

BATCH_SQL = f"SELECT * FROM ident WHERE record_last_updated_timestamp >= '{CUTOFF}'"


def ident(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(IDENT_SQL.replace("FROM events", "FROM {events}"), events=events)


def store(ident_df: DataFrame) -> DataFrame:
    return top_per_group(
        ident_df.filter(F.col("record_last_updated_timestamp") < CUTOFF),
        ["source_name", "source_customer_id"],
        [F.col("record_last_updated_timestamp").desc(), F.col("batch_record_id").desc()],
    )


def batch(ident_df: DataFrame) -> DataFrame:
    return ident_df.filter(F.col("record_last_updated_timestamp") >= CUTOFF)


def with_ident(sql: str) -> str:
    """Put the views in front of a query; its own leading WITH is merged in."""
    views = f"WITH RECURSIVE ident AS ({IDENT_SQL}),\nstore AS ({STORE_SQL}),\nbatch AS ({BATCH_SQL})"
    text = sql.strip()
    if text[:5].lower() == "with ":
        rest = text[5:].strip()
        if rest[:10].lower() == "recursive ":
            rest = rest[10:]
        return f"{views},\n{rest}"
    return f"{views}\n{text}"
