"""Projections, predicates, joins, aggregates, windows, dedupe and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, nested, text
from ..operators import aggregates, batches, dedupe, joins, project, rules
from ..operators.groups import attach, top_per_group
from .registry import AS_OF, Source, query
from .resolution import ORDER

# ---- projections ---------------------------------------------------------


def mapped_customers(source: Source):
    mapping = {
        "source_name": F.lit("CRM"),
        "source_customer_id": F.col("c_custkey").cast("string"),
        "last_name": "c_name",
        "country_code": F.col("c_nationkey").cast("string"),
    }
    return project.map_to_common(source.table("customer"), mapping)


MAPPED_SQL = """SELECT 'CRM' AS source_name, cast(c_custkey AS varchar) AS source_customer_id, '' AS prefix,
  '' AS first_name, '' AS middle_name, c_name AS last_name, '' AS generation_qualifier, '' AS gender,
  '' AS birth_date, '' AS address_line_1, '' AS address_line_2, '' AS city, '' AS state_code,
  '' AS postal_code, cast(c_nationkey AS varchar) AS country_code, '' AS phone, '' AS email_address,
  '' AS guest_id, '' AS record_created_timestamp, '' AS record_last_updated_timestamp,
  c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer"""


@query("pr01_required_columns", sql="SELECT c_custkey, c_name FROM customer")
def required_columns(source: Source):
    return project.require(source.table("customer"), ["c_custkey", "c_name"])


@query("pr02_common_schema", sql=MAPPED_SQL)
def common_schema(source: Source):
    return mapped_customers(source)


@query(
    "pr03_positional_map",
    sql="SELECT c_custkey AS customer_id, c_name AS full_name, cast(NULL AS varchar) AS phone FROM customer",
)
def positional_map(source: Source):
    return project.map_positional(
        source.table("customer"), ["c_custkey", "c_name", "c_phone"], ["customer_id", "full_name", "phone"]
    )


@query(
    "pr04_prefixed_columns",
    sql=f"""SELECT source_name, source_customer_id, last_name AS ml_last_name, country_code AS ml_country_code,
  guest_id AS rules_guest_id, email_address AS ml_email_address FROM ({MAPPED_SQL})""",
)
def prefixed_columns(source: Source):
    return project.prefix_columns(mapped_customers(source)).select(
        "source_name", "source_customer_id", "ml_last_name", "ml_country_code", "rules_guest_id", "ml_email_address"
    )


@query(
    "pr05_expanded_json",
    sql="""SELECT event_id, user_id AS original_user_id, event_type AS original_event_type,
  cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events""",
)
def expanded_json(source: Source):
    rows = source.table("events").select("event_id", "user_id", "event_type", "props")
    return project.expand_json(project.mark_original(rows, ["event_id", "props"]), "props", "k bigint")


@query(
    "pr06_pass_through",
    sql=f"""SELECT source_name, source_customer_id, last_name,
  json_object('c_nationkey', c_nationkey, 'c_mktsegment', c_mktsegment)::varchar AS pass_thru_data
FROM ({MAPPED_SQL})""",
)
def pass_through(source: Source):
    rows = mapped_customers(source).select(
        "source_name", "source_customer_id", "last_name", "c_nationkey", "c_mktsegment"
    )
    return project.pass_through(rows)


@query(
    "pr07_state_columns",
    ident=True,
    sql="""SELECT batch_record_id, 'N' AS delete_flag, cast(NULL AS varchar) AS uxid, 1.0::double AS uxid_confidence,
  cast(NULL AS varchar) AS id_res_last_updated_timestamp, 0 AS processing_scenario,
  'b1' AS updated_by_incremental_batch_id, 'incremental' AS updated_by_incremental_batch_description FROM batch""",
)
def state_columns(source: Source):
    return project.add_state_columns(source.batch().select("batch_record_id"), "b1")


@query("pr08_column_last", sql="SELECT p_partkey, p_brand, p_size, p_name FROM part")
def column_last(source: Source):
    return project.column_last(source.table("part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_name")


@query(
    "pr09_blanks_to_null",
    ident=True,
    sql="""SELECT batch_record_id,
  CASE WHEN trim(ml_address_line_1) = '' THEN NULL ELSE ml_address_line_1 END AS ml_address_line_1,
  CASE WHEN trim(ml_address_line_2) = '' THEN NULL ELSE ml_address_line_2 END AS ml_address_line_2,
  ml_email_address FROM ident""",
)
def blanks_to_null(source: Source):
    return text.blanks_to_null(
        source.ident().select("batch_record_id", "ml_address_line_1", "ml_address_line_2", "ml_email_address")
    )


@query(
    "pr10_all_strings",
    sql="""SELECT cast(l_orderkey AS varchar) AS l_orderkey, cast(l_linenumber AS varchar) AS l_linenumber,
  cast(l_quantity AS varchar) AS l_quantity, l_returnflag, cast(l_shipdate AS varchar) AS l_shipdate FROM lineitem""",
)
def all_strings(source: Source):
    return text.all_to_string(
        source.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    )


@query(
    "pr11_nulls_to_blank",
    ident=True,
    sql="""SELECT batch_record_id, coalesce(ml_first_name, '') AS ml_first_name,
  coalesce(ml_email_address, '') AS ml_email_address, coalesce(rules_guest_id, '') AS rules_guest_id FROM ident""",
)
def nulls_to_blank(source: Source):
    return text.nulls_to_blank(
        source.ident().select("batch_record_id", "ml_first_name", "ml_email_address", "rules_guest_id")
    )


@query(
    "pr12_updated_or_created",
    ident=True,
    sql="""SELECT batch_record_id, CASE WHEN coalesce(trim(ml_address_line_1), '') = '' THEN record_last_updated_timestamp
  ELSE ml_address_line_1 END AS filled FROM ident""",
)
def updated_or_created(source: Source):
    return source.ident().select(
        "batch_record_id",
        project.updated_or_created("ml_address_line_1", "record_last_updated_timestamp").alias("filled"),
    )


# ---- predicates ----------------------------------------------------------

SCENARIO_SQL = "1 + batch_record_id % 4 AS processing_scenario, CASE WHEN batch_record_id % 13 = 0 THEN 'Y' ELSE 'N' END AS delete_flag"


def with_scenarios(source: Source):
    return source.ident().select(
        "batch_record_id",
        (F.lit(1) + F.col("batch_record_id") % 4).alias("processing_scenario"),
        F.when(F.col("batch_record_id") % 13 == 0, "Y").otherwise("N").alias("delete_flag"),
    )


@query(
    "fl01_scenario_routes",
    ident=True,
    sql=f"""SELECT route, processing_scenario, count(*) AS records, sum(batch_record_id)::bigint AS id_sum FROM (
  SELECT *, CASE processing_scenario WHEN 1 THEN 'touch' WHEN 3 THEN 'adopt' ELSE 'match' END AS route
  FROM (SELECT batch_record_id, {SCENARIO_SQL} FROM ident) WHERE delete_flag = 'N') GROUP BY ALL""",
)
def scenario_routes(source: Source):
    routes = project.split_scenarios(with_scenarios(source))
    tagged = [df.withColumn("route", F.lit(name)) for name, df in routes.items()]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .unionByName(tagged[2])
        .groupBy("route", "processing_scenario")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("batch_record_id").alias("id_sum"))
    )


@query(
    "fl02_email_only",
    ident=True,
    sql="""SELECT batch_record_id, ml_email_address FROM ident
WHERE coalesce(trim(ml_email_address), '') <> '' AND concat(coalesce(trim(ml_first_name), ''),
  coalesce(trim(ml_middle_name), ''), coalesce(trim(ml_last_name), ''), coalesce(trim(ml_address_line_1), ''),
  coalesce(trim(ml_address_line_2), ''), coalesce(trim(ml_birth_date), ''), coalesce(trim(ml_phone), ''),
  coalesce(trim(rules_guest_id), '')) = ''""",
)
def email_only_rows(source: Source):
    df = source.ident()
    return df.filter(rules.is_email_only(df)).select("batch_record_id", "ml_email_address")


@query(
    "fl03_unconverted_times",
    sql="""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS converted FROM events
WHERE event_type <> 'error'""",
)
def unconverted_times(source: Source):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("ts").cast("string"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    rows = source.table("events").select("event_id", raw.alias("raw"), dates.flexible_iso(raw).alias("converted"))
    return project.drop_unconverted(rows, "raw", "converted")[0].select("event_id", "converted")


@query(
    "fl04_active_contacts",
    sql="""SELECT event_id, event_type AS phone_role FROM events
WHERE lower(trim(event_type)) = 'click' AND (value IS NULL OR value < 50)""",
)
def active_contacts(source: Source):
    ended = F.when(F.col("value") >= 50, F.col("ts").cast("string"))
    rows = source.table("events").select("event_id", F.col("event_type").alias("phone_role"), ended.alias("end_date"))
    return project.active_contacts(rows, "click", "phone_role", "end_date").drop("end_date")


@query("fl05_prefix_filter", sql="SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1')")
def prefix_filter(source: Source):
    return source.table("part").select("p_partkey", "p_brand").filter(F.col("p_brand").startswith("Brand#1"))


@query(
    "fl06_value_list",
    ident=True,
    sql="""SELECT batch_record_id, ml_phone FROM ident WHERE ml_phone IN (
  SELECT concat('555', lpad(cast(c_custkey AS varchar), 7, '0')) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def value_list(source: Source):
    phones = (
        source.table("customer")
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .select(F.concat(F.lit("555"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("phone"))
    )
    return project.value_in(source.ident().select("batch_record_id", "ml_phone"), "ml_phone", phones)


@query(
    "fl07_list_contains",
    ident=True,
    sql="""SELECT batch_record_id FROM ident WHERE lower(trim(ml_email_address)) = 'user7@ex.com'""",
)
def list_contains(source: Source):
    rows = source.ident().select("batch_record_id", nested.text_items("ml_email_address").alias("emails"))
    return rows.filter(project.holds_item("emails", "USER7@ex.com")).select("batch_record_id")


# ---- joins ---------------------------------------------------------------


@query(
    "jn01_star_left",
    sql="""SELECT c_custkey, c_name, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def star_left(source: Source):
    joined = joins.star_join(
        source.table("customer").select("c_custkey", "c_name", "c_nationkey"),
        [
            joins.Dimension(source.table("nation"), "c_nationkey", "n_nationkey"),
            joins.Dimension(source.table("region"), "n_regionkey", "r_regionkey"),
        ],
        row_id="c_custkey",
    )
    return joined.select("c_custkey", "c_name", "n_name", "r_name")


@query(
    "jn02_inner_then_left",
    sql="""SELECT CASE WHEN c_custkey = previous THEN o.o_custkey ELSE c_custkey END AS k, c_name, n_parts, o_orderkey
FROM (SELECT c_custkey, c_name FROM customer) c
JOIN (SELECT l_suppkey AS key2, count(*) AS n_parts FROM lineitem GROUP BY l_suppkey) s ON c.c_custkey = s.key2
LEFT JOIN (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_orderkey END AS previous FROM orders) o ON c.c_custkey = o.o_custkey""",
)
def inner_then_left(source: Source):
    required = source.table("lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("n_parts"))
    optional = source.table("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).otherwise(F.col("o_orderkey")).alias("p"))
    base = source.table("customer").select(F.col("c_custkey").alias("k"), "c_name")
    return joins.inner_then_left(base, required, optional, "k", "p")


LATEST_ORDER_SQL = """SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1"""


def newest_order():
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]


@query(
    "jn03_latest_dimension",
    sql=f"""SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN ({LATEST_ORDER_SQL}) ON c_custkey = o_custkey""",
)
def latest_dimension(source: Source):
    base = source.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    orders = source.table("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    joined = joins.latest_dimension(base, orders, "o_custkey", newest_order())
    return joined.select(F.col("o_custkey").alias("c_custkey"), "c_name", "o_orderkey", "o_totalprice")


@query(
    "jn04_roles_to_columns",
    sql="""SELECT user_id, arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'click') AS click,
  arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY user_id""",
)
def roles_to_columns(source: Source):
    events = source.table("events").select("user_id", "event_id", "event_type", "ts")
    return joins.spread_roles(
        events, "user_id", F.col("event_type"), "event_id", F.struct("ts", "event_id"), ["click", "view"]
    )


@query(
    "jn05_attach_keyed",
    ident=True,
    sql="""SELECT batch_record_id, i.rules_guest_id, new_uxid FROM ident i LEFT JOIN (
  SELECT DISTINCT rules_guest_id, md5(concat('new|', rules_guest_id)) AS new_uxid FROM ident) m
ON i.rules_guest_id = m.rules_guest_id""",
)
def attach_keyed(source: Source):
    from ..functions.keys import stable_id

    rows = source.ident().select("batch_record_id", "rules_guest_id")
    minted = aggregates.distinct_keys(rows, "rules_guest_id", "rules_guest_id").withColumn(
        "new_uxid", stable_id("rules_guest_id")
    )
    return attach(rows, minted, "rules_guest_id", "batch_record_id")


@query(
    "jn06_two_key_join",
    ident=True,
    sql="""SELECT a.batch_record_id, b.batch_record_id AS stored_record_id, b.uxid AS stored_uxid FROM ident a
JOIN store b ON a.source_name = b.source_name AND a.source_customer_id = b.source_customer_id""",
)
def two_key_join(source: Source):
    keys = ["source_name", "source_customer_id"]
    stored = source.store().select(
        *keys, F.col("batch_record_id").alias("stored_record_id"), F.col("uxid").alias("stored_uxid")
    )
    joined = source.ident().select("batch_record_id", *keys).join(stored, keys)
    return joined.select("batch_record_id", "stored_record_id", "stored_uxid")


@query(
    "jn07_history_left_join",
    ident=True,
    sql="""SELECT b.batch_record_id, s.uxid AS past_uxid FROM batch b LEFT JOIN store s
ON concat_ws(':', b.source_name, b.source_customer_id) = concat_ws(':', s.source_name, s.source_customer_id)""",
)
def history_left_join(source: Source):
    key = F.concat_ws(":", "source_name", "source_customer_id").alias("record_key")
    past = source.store().select(key, F.col("uxid").alias("past_uxid"))
    return source.batch().select("batch_record_id", key).join(past, "record_key", "left").drop("record_key")


@query(
    "jn09_fill_missing",
    ident=True,
    sql="""SELECT batch_record_id, coalesce(ml_first_name, v.f) AS ml_first_name, coalesce(ml_last_name, v.l) AS ml_last_name
FROM ident LEFT JOIN (SELECT lower(c_name) AS k0, concat('user', cast(c_custkey AS varchar), '@ex.com') AS k, c_mktsegment AS f, c_name AS l FROM customer) v
ON nullif(lower(trim(ml_email_address)), '') = v.k""",
)
def fill_missing(source: Source):
    values = source.table("customer").select(
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@ex.com")).alias("email_key"),
        F.col("c_mktsegment").alias("ml_first_name"),
        F.col("c_name").alias("ml_last_name"),
    )
    rows = source.ident().select(
        "batch_record_id", text.lookup_key("ml_email_address").alias("email_key"), "ml_first_name", "ml_last_name"
    )
    return joins.fill_missing(rows, values, "email_key", ["ml_first_name", "ml_last_name"], "batch_record_id").drop(
        "email_key"
    )


@query(
    "jn10_missing_keys",
    sql="""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000 AND o_custkey IS NOT NULL)""",
)
def missing_keys(source: Source):
    found = source.table("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing_keys(source.table("customer"), found, "c_custkey")


@query(
    "jn11_only_known",
    sql="SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def only_known(source: Source):
    known = source.table("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.only_known(source.table("customer").select("c_custkey", "c_name"), known, "c_custkey")


@query(
    "jn12_hit_flags",
    sql="""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL) AS has_filled
FROM customer""",
)
def hit_flags(source: Source):
    filled = source.table("orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flag_hits(source.table("customer").select("c_custkey"), filled, "c_custkey", "has_filled")


# ---- aggregates ----------------------------------------------------------


@query("ag01_count_by_source", sql="SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def count_by_source(source: Source):
    return aggregates.count_by(source.table("events"), "event_type")


DUPLICATE_SQL = "SELECT text, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1"


@query("ag02_duplicate_groups", sql=DUPLICATE_SQL)
def duplicate_groups(source: Source):
    return aggregates.duplicate_groups(source.table("documents"), ["text"])


@query(
    "ag03_guests_per_email",
    ident=True,
    sql="""SELECT nullif(lower(trim(ml_email_address)), '') AS email_key, count(DISTINCT rules_guest_id) AS guest_ids
FROM ident WHERE nullif(lower(trim(ml_email_address)), '') IS NOT NULL GROUP BY 1""",
)
def guests_per_email(source: Source):
    rows = source.ident().select(text.lookup_key("ml_email_address").alias("email_key"), "rules_guest_id")
    return (
        rows.filter(F.col("email_key").isNotNull())
        .groupBy("email_key")
        .agg(F.countDistinct("rules_guest_id").alias("guest_ids"))
    )


@query(
    "ag04_first_id_per_email",
    ident=True,
    sql=f"""SELECT ml_email_address, uxid AS existing_uxid FROM (
  SELECT *, row_number() OVER (PARTITION BY ml_email_address ORDER BY {ORDER}) AS rn
  FROM (SELECT * REPLACE (trim(ml_email_address) AS ml_email_address) FROM ident)
  WHERE uxid IS NOT NULL AND coalesce(ml_email_address, '') <> '') WHERE rn = 1""",
)
def first_id_per_email(source: Source):
    return rules.first_id_per_email(source.ident().withColumn("ml_email_address", F.trim("ml_email_address")))


@query(
    "ag05_scenario_counts",
    ident=True,
    sql=f"""SELECT count(*) FILTER (WHERE processing_scenario = 1) AS processing_scenario_1,
  count(*) FILTER (WHERE processing_scenario = 2) AS processing_scenario_2,
  count(*) FILTER (WHERE processing_scenario = 3) AS processing_scenario_3,
  count(*) FILTER (WHERE processing_scenario = 4) AS processing_scenario_4
FROM (SELECT batch_record_id, {SCENARIO_SQL} FROM ident)""",
)
def scenario_counts(source: Source):
    return aggregates.count_cases(with_scenarios(source), "processing_scenario", [1, 2, 3, 4])


@query(
    "ag06_distinct_union",
    sql="""SELECT user_id, event_type, cast(NULL AS varchar) AS props FROM events WHERE event_type IN ('view', 'click')
UNION SELECT user_id, event_type, props FROM events WHERE event_type IN ('click', 'error')""",
)
def distinct_union(source: Source):
    events = source.table("events")
    left = events.filter(F.col("event_type").isin("view", "click")).select("user_id", "event_type")
    right = events.filter(F.col("event_type").isin("click", "error")).select("user_id", "event_type", "props")
    return dedupe.distinct_union(left, right)


@query(
    "ag07_lookup_keys",
    ident=True,
    sql="""SELECT DISTINCT nullif(lower(trim(ml_email_address)), '') AS email_key FROM ident
WHERE nullif(lower(trim(ml_email_address)), '') IS NOT NULL""",
)
def lookup_keys(source: Source):
    return aggregates.distinct_keys(source.ident(), text.lookup_key("ml_email_address"), "email_key")


@query(
    "ag08_circuit_report",
    sql="""SELECT n_out, n_in, CASE WHEN n_in > 0 THEN round(n_out / n_in, 6) END AS ratio,
  coalesce(n_out >= 10000 AND n_out / n_in >= 25, false) AS tripped
FROM (SELECT (SELECT count(*) FROM lineitem) AS n_out, (SELECT count(*) FROM orders) AS n_in)""",
)
def circuit_report(source: Source):
    return aggregates.circuit_report(source.table("lineitem"), source.table("orders"))


@query(
    "ag09_removal_report",
    sql="""SELECT n_before, n_after, n_before - n_after AS n_removed,
  round((n_before - n_after) * 100.0 / n_before, 4) AS percent_removed
FROM (SELECT (SELECT count(*) FROM documents) AS n_before, (SELECT count(DISTINCT text) FROM documents) AS n_after)""",
)
def removal_report(source: Source):
    docs = source.table("documents").select("text")
    return aggregates.removal_report(docs, docs.filter(F.col("text").isNotNull()).distinct())


# ---- windows, dedupe, order ----------------------------------------------


@query("wn03_latest_per_key", sql=LATEST_ORDER_SQL)
def latest_per_key(source: Source):
    orders = source.table("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return top_per_group(orders, ["o_custkey"], newest_order()).drop("o_orderdate")


@query(
    "wn05_full_times",
    sql="""WITH r AS (SELECT user_id, event_type,
    CASE WHEN event_type = 'view' AND value > 5 OR value > 15 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') ELSE strftime(ts, '%Y-%m-%d') END AS t FROM events),
f AS (SELECT *, max(length(t) > 19) OVER (PARTITION BY user_id, event_type) AS any_full FROM r)
SELECT user_id, event_type, CASE WHEN length(t) > 19 THEN t ELSE concat(t, ' 00:00:00.000') END AS t
FROM f WHERE NOT any_full OR length(t) > 19""",
)
def full_times(source: Source):
    exact = ((F.col("event_type") == "view") & (F.col("value") > 5)) | (F.col("value") > 15)
    stamp = F.when(exact, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    rows = source.table("events").select("user_id", "event_type", stamp.alias("t"))
    return dedupe.keep_full_times(rows, "t")


@query(
    "wn06_keep_latest",
    ident=True,
    sql="""SELECT batch_record_id, source_name, source_customer_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_name, source_customer_id
    ORDER BY record_last_updated_timestamp DESC, batch_record_id) AS rn FROM ident) WHERE rn = 1""",
)
def keep_latest(source: Source):
    rows = source.ident().select("batch_record_id", "source_name", "source_customer_id", "record_last_updated_timestamp")
    order = [F.col("record_last_updated_timestamp").desc(), F.col("batch_record_id")]
    return top_per_group(rows, ["source_name", "source_customer_id"], order).drop("record_last_updated_timestamp")


FILES_SQL = """SELECT lpad(cast(o_orderkey AS varchar), 12, '0') AS file_name,
  o_orderpriority AS source, cast(floor(o_totalprice / 100) AS bigint) AS row_count FROM orders"""


def order_files(source: Source):
    """Orders seen as a manifest of vendor files."""
    return source.table("orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("file_name"),
        F.col("o_orderpriority").alias("source"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("row_count"),
    )


def next_batch_sql(where: str) -> str:
    return f"""SELECT file_name, source, row_count, running_rows::bigint AS running_rows, item::int AS item FROM (
  SELECT *, sum(row_count) OVER (ORDER BY file_name) AS running_rows, row_number() OVER (ORDER BY file_name) AS item
  FROM ({FILES_SQL}) {where}) WHERE item <= 150 AND (item = 1 OR running_rows <= 50000)"""


@query("wn07_running_bound", sql=next_batch_sql(""))
def running_bound(source: Source):
    return batches.next_batch(order_files(source))


@query("mb02_next_batch", sql=next_batch_sql("WHERE source IN ('1-URGENT', '2-HIGH')"))
def next_batch(source: Source):
    return batches.next_batch(order_files(source), sources=["1-URGENT", "2-HIGH"])


@query(
    "mb03_mark_files",
    sql=f"""SELECT file_name, source, CASE WHEN row_count < 1000 THEN 'complete' WHEN row_count > 4000 THEN 'failed' ELSE 'ready' END AS status,
  CASE WHEN row_count < 1000 OR row_count > 4000 THEN epoch(TIMESTAMP '2024-02-01 00:00:00')::bigint + 90 * 86400 END AS ttl
FROM ({FILES_SQL})""",
)
def mark_files(source: Source):
    files = order_files(source)
    outcome = files.filter((F.col("row_count") < 1000) | (F.col("row_count") > 4000)).select(
        "file_name", (F.col("row_count") < 1000).alias("ok")
    )
    manifest = files.drop("row_count").withColumns(
        {"status": F.lit(batches.READY), "ttl": F.lit(None).cast("bigint")}
    )
    return batches.mark(manifest, outcome, AS_OF)


@query(
    "mb05_ready_record",
    ident=True,
    sql="""SELECT 'job-1' AS job_id, 'ready-for-load' AS status, count(*) AS record_count, 'out/job-1' AS data_path FROM batch""",
)
def ready_record(source: Source):
    return batches.ready_record(source.batch(), "job-1", "out/job-1")


COPIES_SQL = """SELECT user_id, event_type, cast(floor(value) AS bigint) AS v,
  CASE WHEN value > 45 THEN 'unknown' ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS t, ts FROM events"""


@query(
    "dd01_dedupe_latest",
    sql=f"""SELECT user_id, event_type, v, t FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, v
    ORDER BY try_strptime(t, '%m/%d/%Y %I:%M:%S %p') DESC NULLS LAST, t DESC) AS rn FROM ({COPIES_SQL})) WHERE rn = 1""",
)
def dedupe_latest(source: Source):
    stamp = F.when(F.col("value") > 45, "unknown").otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
    rows = source.table("events").select(
        "user_id", "event_type", F.floor("value").cast("bigint").alias("v"), stamp.alias("t")
    )
    return dedupe.dedupe_latest(rows, "T", ["MM/dd/yyyy hh:mm:ss a"])


@query(
    "dd01_dedupe_drop_invalid",
    sql=f"""SELECT user_id, event_type, v, t FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, v
    ORDER BY try_strptime(t, '%m/%d/%Y %I:%M:%S %p') DESC, t DESC) AS rn FROM ({COPIES_SQL})
  WHERE try_strptime(t, '%m/%d/%Y %I:%M:%S %p') IS NOT NULL) WHERE rn = 1""",
)
def dedupe_drop_invalid(source: Source):
    stamp = F.when(F.col("value") > 45, "unknown").otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
    rows = source.table("events").select(
        "user_id", "event_type", F.floor("value").cast("bigint").alias("v"), stamp.alias("t")
    )
    return dedupe.dedupe_latest(rows, "t", ["MM/dd/yyyy hh:mm:ss a"], drop_invalid=True)


@query(
    "dd02_first_per_key",
    sql="""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem)
WHERE rn = 1""",
)
def first_per_key(source: Source):
    rows = source.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    return dedupe.first_per_key(rows, ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey")])


@query(
    "dd03_collapse_short_times",
    sql="""WITH r AS (SELECT user_id, event_type,
    CASE WHEN value > 15 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') ELSE strftime(ts, '%Y-%m-%d') END AS t FROM events),
f AS (SELECT *, max(length(t) > 19) OVER (PARTITION BY user_id, event_type) AS any_full FROM r),
s AS (SELECT user_id, event_type, CASE WHEN length(t) > 19 THEN t ELSE concat(t, ' 00:00:00.000') END AS t
  FROM f WHERE NOT any_full OR length(t) > 19)
SELECT user_id, event_type, max(t) AS t FROM s GROUP BY user_id, event_type""",
)
def collapse_short_times(source: Source):
    stamp = F.when(F.col("value") > 15, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    rows = source.table("events").select("user_id", "event_type", stamp.alias("t"))
    return dedupe.dedupe_latest(dedupe.keep_full_times(rows, "t"), "t", ["yyyy-MM-dd HH:mm:ss.SSS"])


@query(
    "so01_order_by_count",
    sql="SELECT source, count(*) AS records FROM documents GROUP BY source ORDER BY records DESC, source",
)
def order_by_count(source: Source):
    return aggregates.count_by(source.table("documents"), "source").orderBy(F.col("records").desc(), "source")


@query(
    "so02_oldest_in_status",
    sql="SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey LIMIT 1",
)
def oldest_in_status(source: Source):
    rows = source.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return batches.oldest(rows, "O", "o_orderstatus", ["o_orderdate", "o_orderkey"])


@query(
    "st01_union_parts",
    sql="""SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0""",
)
def union_parts(source: Source):
    customer = source.table("customer")
    first = customer.filter("c_acctbal >= 0").select("c_custkey", "c_name")
    second = customer.filter("c_acctbal < 0").select("c_name", "c_custkey")
    return first.unionByName(second)


@query(
    "st02_union_missing_columns",
    sql="""SELECT c_name AS name, c_mktsegment, cast(NULL AS bigint) AS s_suppkey FROM customer
UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier""",
)
def union_missing_columns(source: Source):
    customer = source.table("customer").select(F.col("c_name").alias("name"), "c_mktsegment")
    supplier = source.table("supplier").select(F.col("s_name").alias("name"), "s_suppkey")
    return customer.unionByName(supplier, allowMissingColumns=True)


@query(
    "st03_aligned_export",
    ident=True,
    sql="""SELECT batch_record_id, source_name, uxid, uxid_confidence FROM store
UNION ALL SELECT batch_record_id, source_name, uxid, NULL FROM batch""",
)
def aligned_export(source: Source):
    target = source.store().select("batch_record_id", "source_name", "uxid", "uxid_confidence")
    bypass = source.batch().select("uxid", F.col("batch_record_id").cast("int"), "source_name", "ml_phone")
    return dedupe.aligned_union(target, bypass)


@query(
    "st04_set_difference",
    ident=True,
    sql="""SELECT batch_record_id FROM ident WHERE batch_record_id NOT IN (SELECT batch_record_id FROM store)""",
)
def set_difference(source: Source):
    return source.ident().select("batch_record_id").join(source.store().select("batch_record_id"), "batch_record_id", "left_anti")
