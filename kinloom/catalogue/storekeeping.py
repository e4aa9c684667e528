"""Store maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..operators import store
from ..plans.changelog import LoggedTable
from ..session import new_folder
from ..sources import sinks
from .registry import Source, query
from .resolution import CONTEXT, STAMP


@query(
    "up01_upsert_all_columns",
    sql="""SELECT c_custkey, coalesce(CASE WHEN b.k IS NOT NULL THEN b.n ELSE c_name END) AS c_name, CASE WHEN b.k IS NOT NULL THEN b.s ELSE c_mktsegment END AS c_mktsegment
FROM customer c LEFT JOIN (SELECT s_suppkey AS k, s_name AS n, cast(NULL AS varchar) AS s FROM supplier) b ON c_custkey = b.k
UNION ALL SELECT s_suppkey + 10000000, s_name, 'NEW' FROM supplier""",
)
def upsert_all(source: Source):
    base = source.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    supplier = source.table("supplier")
    known = supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"))
    fresh = supplier.select((F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("NEW").alias("c_mktsegment"))
    return store.upsert(base, known.unionByName(fresh), ["c_custkey"]).table


UPSERT_SOME_SQL = """SELECT coalesce(c_custkey, k) AS c_custkey, c_name, CASE WHEN k IS NOT NULL THEN s ELSE c_mktsegment END AS c_mktsegment, extra, k IS NOT NULL AS hit
FROM customer c FULL JOIN (SELECT s_suppkey * 30 AS k, CASE WHEN s_nationkey > 10 THEN s_name END AS s, s_nationkey AS extra FROM supplier) b ON c_custkey = b.k"""


def upsert_some(source: Source):
    base = source.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    batch = source.table("supplier").select(
        (F.col("s_suppkey") * 30).alias("c_custkey"),
        F.when(F.col("s_nationkey") > 10, F.col("s_name")).alias("c_mktsegment"),
        F.col("s_nationkey").alias("extra"),
    )
    return store.upsert(base, batch, ["c_custkey"])


@query("up01_upsert_some_columns", sql=f"SELECT * EXCLUDE (hit) FROM ({UPSERT_SOME_SQL})")
def upsert_some_table(source: Source):
    return upsert_some(source).table


@query("up01_upsert_changes", sql=f"SELECT * EXCLUDE (hit) FROM ({UPSERT_SOME_SQL}) WHERE hit")
def upsert_some_changes(source: Source):
    return upsert_some(source).changes


@query(
    "up02_partial_update",
    sql="""SELECT o_orderkey, CASE WHEN n IS NOT NULL THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN n IS NOT NULL THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_custkey
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
)
def partial_update(source: Source):
    updates = source.table("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    updates = updates.union(source.table("orders").selectExpr("max(o_orderkey) + 5")).withColumns(
        {"o_orderstatus": F.lit("X"), "o_orderpriority": F.lit(None).cast("string")}
    )
    base = source.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    return store.partial_update(base, updates, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"]).table


LISTED = "SELECT concat('user', cast(s_suppkey AS varchar), '@ex.com') FROM supplier WHERE s_nationkey < 12"


def listed(source: Source):
    return source.table("supplier").filter("s_nationkey < 12").select(
        F.concat(F.lit("user"), F.col("s_suppkey").cast("string"), F.lit("@ex.com")).alias("value")
    )


@query(
    "up03_nullify",
    ident=True,
    sql=f"SELECT batch_record_id, CASE WHEN ml_email_address IN ({LISTED}) THEN NULL ELSE ml_email_address END AS ml_email_address FROM ident",
)
def nullify(source: Source):
    rows = source.ident().select("batch_record_id", "ml_email_address")
    return store.nullify(rows, "ml_email_address", listed(source), "batch_record_id").table


@query(
    "up03_nullify_nested",
    ident=True,
    sql=f"""SELECT batch_record_id, ml_first_name AS first_name, CASE WHEN ml_email_address IN ({LISTED}) THEN NULL ELSE ml_email_address END AS email
FROM store""",
)
def nullify_nested(source: Source):
    docs = nested.as_document(source.store())
    done = store.nullify(docs, "record_normalized.ml_email_address", listed(source), "batch_record_id").table
    return done.select(
        "batch_record_id",
        F.col("record_normalized.ml_first_name").alias("first_name"),
        F.col("record_normalized.ml_email_address").alias("email"),
    )


@query(
    "up03_nullify_dry_run",
    ident=True,
    sql=f"SELECT batch_record_id, cast(NULL AS varchar) AS ml_email_address FROM ident WHERE ml_email_address IN ({LISTED})",
)
def nullify_dry_run(source: Source):
    rows = source.ident().select("batch_record_id", "ml_email_address")
    return store.nullify(rows, "ml_email_address", listed(source), "batch_record_id").changes


@query(
    "up04_replace_values",
    sql="""SELECT p_partkey, coalesce(m.new, p_brand) AS p_brand FROM part LEFT JOIN (
  SELECT concat('Brand#', cast(n_nationkey AS varchar)) AS old, n_name AS new FROM nation WHERE n_regionkey < 3) m ON p_brand = m.old""",
)
def replace_values(source: Source):
    mapping = source.table("nation").filter("n_regionkey < 3").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("old"), F.col("n_name").alias("new")
    )
    return store.replace_values(source.table("part").select("p_partkey", "p_brand"), "p_brand", mapping).table


@query(
    "up05_remove_field",
    ident=True,
    sql=f"""SELECT batch_record_id, ml_email_address, CASE WHEN ml_email_address IN ({LISTED}) THEN NULL ELSE ml_phone END AS ml_phone FROM ident""",
)
def remove_field(source: Source):
    rows = source.ident().select("batch_record_id", "ml_email_address", "ml_phone")
    return store.remove_field(rows, "ml_phone", "ml_email_address", listed(source), "batch_record_id").table


THRESHOLD_SQL = f"""SELECT batch_record_id, CASE WHEN hit THEN NULL ELSE ml_email_address END AS ml_email_address, hit, hit AND blanks > 2 AS gone FROM (
  SELECT batch_record_id, ml_email_address, coalesce(ml_email_address IN ({LISTED}), false) AS hit,
    (coalesce(trim(ml_first_name), '') = '')::int + (coalesce(trim(ml_address_line_1), '') = '')::int +
    (coalesce(trim(ml_phone), '') = '')::int + (coalesce(trim(ml_email_address), '') = '')::int AS blanks FROM ident)"""
THRESHOLD_FIELDS = ["ml_first_name", "ml_address_line_1", "ml_phone", "ml_email_address"]


def thresholded(source: Source):
    rows = source.ident().select("batch_record_id", *THRESHOLD_FIELDS)
    return store.null_threshold(rows, "ml_email_address", listed(source), THRESHOLD_FIELDS, 2, "batch_record_id")


@query("up06_null_threshold", ident=True, sql=f"SELECT batch_record_id, ml_email_address FROM ({THRESHOLD_SQL}) WHERE NOT gone")
def null_threshold(source: Source):
    return thresholded(source).table.select("batch_record_id", "ml_email_address")


@query(
    "up06_null_threshold_actions",
    ident=True,
    sql=f"SELECT batch_record_id, CASE WHEN gone THEN 'delete' ELSE 'nullify' END AS action FROM ({THRESHOLD_SQL}) WHERE hit",
)
def null_threshold_actions(source: Source):
    return thresholded(source).changes.select("batch_record_id", "action")


DOC_IDS = """SELECT concat('SRC_WEB_c', cast(c_custkey AS varchar)) FROM customer WHERE c_mktsegment = 'BUILDING'"""


def regenerated(source: Source):
    ids = source.table("customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("SRC_WEB_c"), F.col("c_custkey").cast("string")).alias("doc_id")
    )
    return store.regenerate_ids(source.store(), ids, CONTEXT.job_id, CONTEXT.stamp)


REGEN_SQL = f"""SELECT *, concat_ws('_', source_name, source_customer_id) AS doc,
  concat_ws('_', source_name, source_customer_id) IN ({DOC_IDS}) AS hit FROM store"""
FRESH = f"md5(concat('regen|', '{CONTEXT.job_id}', '|', doc))"


@query(
    "up07_regenerate_ids",
    ident=True,
    sql=f"""SELECT batch_record_id, CASE WHEN hit THEN {FRESH} ELSE uxid END AS uxid,
  CASE WHEN hit THEN 1.0 ELSE uxid_confidence END AS uxid_confidence,
  CASE WHEN hit AND uxid IS NOT NULL THEN uxid END AS past_uxid,
  CASE WHEN hit THEN '{STAMP}' END AS last_updated_timestamp FROM ({REGEN_SQL})""",
)
def regenerate_ids(source: Source):
    return regenerated(source).table.select(
        "batch_record_id",
        "uxid",
        "uxid_confidence",
        F.get("past_uxids", F.lit(0))["uxid"].alias("past_uxid"),
        "last_updated_timestamp",
    )


@query("up07_regenerate_backup", ident=True, sql=f"SELECT batch_record_id, uxid FROM ({REGEN_SQL}) WHERE hit")
def regenerate_backup(source: Source):
    return regenerated(source).backup.select("batch_record_id", "uxid")


@query(
    "up08_duplicate_emails",
    ident=True,
    sql="""WITH e AS (SELECT batch_record_id, lower(trim(ml_email_address)) AS email, record_last_updated_timestamp AS t FROM ident
  WHERE lower(trim(ml_email_address)) <> ''),
r AS (SELECT *, count(*) OVER (PARTITION BY email) AS n, row_number() OVER (PARTITION BY email ORDER BY t DESC NULLS LAST, batch_record_id) AS rn FROM e)
SELECT batch_record_id, CASE WHEN batch_record_id IN (SELECT batch_record_id FROM r WHERE n > 1 AND rn > 1) THEN NULL ELSE ml_email_address END AS ml_email_address FROM ident""",
)
def duplicate_emails(source: Source):
    rows = source.ident().select("batch_record_id", "ml_email_address", "record_last_updated_timestamp")
    return store.clean_duplicate_emails(rows).table.select("batch_record_id", "ml_email_address")


def renamed(source: Source):
    parts = source.table("part").select(
        F.concat("p_brand", F.lit("_"), F.col("p_size").cast("string")).alias("doc_id"), "p_brand", "p_partkey"
    )
    return store.rename_prefix(parts, ["doc_id", "p_brand"], "doc_id", "Brand#1", "Brand#")


RENAME_SQL = """SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN concat('Brand#', substr(p_brand, 8)) ELSE p_brand END AS p_brand,
  CASE WHEN starts_with(p_brand, 'Brand#1') THEN concat('Brand#', substr(p_brand, 8), '_', cast(p_size AS varchar)) ELSE concat(p_brand, '_', cast(p_size AS varchar)) END AS doc_id FROM part"""


@query("up09_rename_prefix", sql=RENAME_SQL)
def rename_prefix(source: Source):
    return renamed(source).table


@query("up09_rename_collisions", sql=f"SELECT doc_id AS key, count(*) AS rows FROM ({RENAME_SQL}) GROUP BY doc_id HAVING count(*) > 1")
def rename_collisions(source: Source):
    return renamed(source).collisions


@query("up10_backup", ident=True, sql=f"SELECT batch_record_id, ml_email_address FROM ident WHERE ml_email_address IN ({LISTED})")
def backup(source: Source):
    """Touched rows in their old form, stored before the change is applied."""
    rows = source.ident().select("batch_record_id", "ml_email_address")
    touched = store.nullify(rows, "ml_email_address", listed(source), "batch_record_id").changes
    folder = new_folder(source.spark, "backup")
    sinks.snapshot(rows.join(touched.select("batch_record_id"), "batch_record_id", "left_semi"), folder, 0, "backup")
    return source.spark.read.parquet(f"{folder}/00_backup")


@query(
    "up03_logged_changes",
    sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 700 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 900 <> 5
UNION ALL SELECT o_orderkey + 1000000000, 'NEW', 'N' FROM orders WHERE o_orderkey % 500 = 2""",
)
def logged_changes(source: Source):
    """Nullified values, replaced values, deletions and new rows as deltas; half of them compacted in between."""
    base = source.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    folder = new_folder(source.spark, "orders-log")
    LoggedTable.create(base, ["o_orderkey"], folder, max_rows=2_000)
    key = F.col("o_orderkey")
    nullified = base.filter(key % 1000 == 1).withColumn("o_orderpriority", F.lit(None).cast("string"))
    LoggedTable.latest(source.spark, folder).change(nullified, None, "nullify")
    fresh = base.filter(key % 500 == 2).select((key + 1_000_000_000).alias("o_orderkey"), F.lit("NEW").alias("o_orderpriority"), F.lit("N").alias("o_orderstatus"))
    LoggedTable.latest(source.spark, folder).change(fresh, base.filter(key % 900 == 5), "delete")
    LoggedTable.latest(source.spark, folder).compact("compact", least=2)
    # The values to replace are those in the table, as the first change left them.
    table = LoggedTable.latest(source.spark, folder)
    replaced = table.lookup(base.filter(key % 700 == 3)).filter(key < 1_000_000_000).withColumn("o_orderstatus", F.lit("X"))
    table.change(replaced, None, "replace")
    return LoggedTable.latest(source.spark, folder).rows()
