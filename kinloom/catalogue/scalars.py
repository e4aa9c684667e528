"""Text, key, date and nested-value expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, keys, nested, text
from .registry import AS_OF, Source, query

# ---- text ----------------------------------------------------------------


@query(
    "sc01_trim_case",
    sql="SELECT upper(trim(p_name)) AS p_name, upper(trim(p_brand)) AS p_brand, upper(trim(p_type)) AS p_type FROM part",
)
def trim_case(source: Source):
    return text.trim_upper(source.table("part").select("p_name", "p_brand", "p_type"))


@query(
    "sc02_valid_email",
    ident=True,
    sql="""SELECT batch_record_id, CASE WHEN length(trim(ml_email_address)) <= 13 THEN lower(trim(ml_email_address)) END AS email
FROM ident""",
)
def valid_email(source: Source):
    return source.ident().select("batch_record_id", text.valid_email("ml_email_address", 13).alias("email"))


@query(
    "sc03_upper_but_email",
    ident=True,
    sql="""SELECT cast(batch_record_id AS varchar) AS batch_record_id, upper(trim(ml_first_name)) AS ml_first_name,
  lower(trim(ml_email_address)) AS ml_email_address FROM ident""",
)
def upper_but_email(source: Source):
    rows = source.ident().select(
        F.col("batch_record_id").cast("string").alias("batch_record_id"), "ml_first_name", "ml_email_address"
    )
    return text.upper_but_email(rows, "ml_email_address", measure_raw=True)


@query("sc04_short_postcode", sql="SELECT o_orderkey, substr(o_orderpriority, 1, 5) AS code FROM orders")
def short_postcode(source: Source):
    return source.table("orders").select("o_orderkey", text.short_postcode("o_orderpriority").alias("code"))


@query(
    "sc05_area_source",
    sql="""SELECT p_partkey, CASE substr(trim(p_type), 1, 3) WHEN 'ECO' THEN 'EAST_PARTS' WHEN 'STA' THEN 'WEST_PARTS' END AS source_name
FROM part""",
)
def area_source(source: Source):
    expr = text.area_source("p_type", {"ECO": "EAST", "STA": "WEST"}, "PARTS")
    return source.table("part").select("p_partkey", expr.alias("source_name"))


@query(
    "sc06_row_digest",
    sql="SELECT c_custkey, md5(concat_ws('|', coalesce(c_name, ''), coalesce(cast(c_nationkey AS varchar), ''), coalesce(c_mktsegment, ''))) AS digest FROM customer",
)
def row_digest(source: Source):
    return source.table("customer").select(
        "c_custkey", keys.text_digest(["c_name", "c_nationkey", "c_mktsegment"]).alias("digest")
    )


@query(
    "sc07_email_hash",
    ident=True,
    sql="SELECT batch_record_id, upper(sha256(nullif(lower(trim(ml_email_address)), ''))) AS email_hash FROM ident",
)
def email_hash(source: Source):
    return source.ident().select("batch_record_id", keys.email_hash("ml_email_address").alias("email_hash"))


@query(
    "sc08_email_local_part",
    ident=True,
    sql="SELECT batch_record_id, regexp_extract(ml_email_address, '^([^@]+)@', 1) AS local_part FROM ident",
)
def email_local_part(source: Source):
    return source.ident().select("batch_record_id", text.email_local_part("ml_email_address").alias("local_part"))


SIMILARITY_SQL = """concat_ws(' ', ml_first_name, ml_middle_name, ml_last_name, ml_address_line_1,
  ml_address_line_2, ml_phone, regexp_extract(ml_email_address, '^([^@]+)@', 1))"""


@query("sc09_similarity_text", ident=True, sql=f"SELECT batch_record_id, {SIMILARITY_SQL} AS all_sim FROM ident")
def similarity_text(source: Source):
    df = source.ident()
    return df.select("batch_record_id", text.similarity_text(df).alias("all_sim"))


@query(
    "sc10_first_usable",
    ident=True,
    sql="""SELECT batch_record_id, coalesce(CASE WHEN lower(trim(ml_address_line_1)) NOT IN ('', 'null') THEN ml_address_line_1 END,
  CASE WHEN lower(trim(ml_address_line_2)) NOT IN ('', 'null') THEN ml_address_line_2 END) AS address FROM ident""",
)
def first_usable(source: Source):
    df = source.ident()
    return df.select(
        "batch_record_id", text.first_usable(df, ["street", "ML_ADDRESS_LINE_1", "ml_address_line_2"]).alias("address")
    )


@query(
    "sc11_record_id",
    ident=True,
    sql="SELECT batch_record_id, coalesce(rules_guest_id, concat_ws(':', source_name, source_customer_id)) AS record_id FROM ident",
)
def record_id(source: Source):
    return source.ident().select(
        "batch_record_id", keys.record_id("rules_guest_id", "source_name", "source_customer_id").alias("record_id")
    )


@query(
    "sc12_plain_dashes",
    sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def plain_dashes(source: Source):
    fancy = F.date_format("o_orderdate", "yyyy–MM—dd")
    return source.table("orders").select("o_orderkey", text.plain_dashes(fancy).alias("day"))


@query(
    "sc14_replace_prefix",
    sql="""SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN concat('Label-', substr(p_brand, 8)) ELSE p_brand END AS p_brand
FROM part""",
)
def replace_prefix(source: Source):
    return source.table("part").select("p_partkey", text.replace_prefix("p_brand", "Brand#1", "Label-").alias("p_brand"))


# ---- dates ---------------------------------------------------------------

# Order dates written in many vendor layouts, chosen by order key.
LAYOUTS = [
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("yyyy/MM/dd", "%Y/%m/%d"),
    ("M/d/yyyy", "%-m/%-d/%Y"),
    ("yyyyMMdd", "%Y%m%d"),
    ("MMM d, yyyy", "%b %-d, %Y"),
    ("dd-MMM-yyyy", "%d-%b-%Y"),
    ("MMMM d, yyyy", "%B %-d, %Y"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
]


def written_date():
    expr = F.when(F.col("o_orderkey") % 11 == 8, F.lit("N/A")).when(F.col("o_orderkey") % 11 == 9, F.lit("30-30-2020"))
    for i, (spark_layout, _) in enumerate(LAYOUTS):
        expr = expr.when(F.col("o_orderkey") % 11 == i, F.date_format("o_orderdate", spark_layout))
    return expr.otherwise(F.date_format("o_orderdate", "  yyyy-MM-dd "))


CLEAN_CASE = "o_orderkey % 11 IN (8, 9) OR o_orderdate > TIMESTAMP '2000-06-01'"


@query(
    "dt00_clean_dates",
    sql=f"""SELECT o_orderkey, CASE WHEN {CLEAN_CASE} THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
  CASE WHEN {CLEAN_CASE} THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') END AS order_timestamp FROM orders""",
)
def clean_dates(source: Source):
    raw = source.table("orders").select(
        "o_orderkey", written_date().alias("order_date"), written_date().alias("order_timestamp")
    )
    return dates.clean_dates(raw, as_of="2000-06-01T00:00:00Z")


@query(
    "dt04_clean_listed_dates",
    sql=f"""SELECT o_orderkey, CASE WHEN {CLEAN_CASE} OR year(o_orderdate) < 1996 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS written
FROM orders""",
)
def clean_listed_dates(source: Source):
    raw = source.table("orders").select("o_orderkey", written_date().alias("written"))
    return dates.clean_dates(raw, as_of="2000-06-01T00:00:00Z", columns=["written"], min_year=1996)


@query(
    "dt05_full_timestamp",
    sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00.000') AS t FROM orders",
)
def full_timestamp(source: Source):
    short = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return source.table("orders").select("o_orderkey", dates.full_timestamp(short).alias("t"))


@query(
    "dt06_to_utc",
    sql="""SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') AS est,
  strftime(timezone('UTC', timezone('America/Chicago', date_trunc('second', ts))), '%Y-%m-%dT%H:%M:%S.000Z') AS cst,
  strftime(timezone('UTC', timezone('America/Los_Angeles', date_trunc('millisecond', ts))), '%Y-%m-%dT%H:%M:%S.%gZ') AS pst,
  strftime(date_trunc('millisecond', ts) + INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%S.%gZ') AS offset_value FROM events""",
)
def to_utc(source: Source):
    rows = source.table("events").select(
        "event_id",
        F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("est"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("cst"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("pst"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-04:00")).alias("offset_value"),
    )
    rows = dates.to_utc(rows, ["est"], "UOR_LOEWS")
    rows = dates.to_utc(rows, ["cst"], "USH_TRISEPT")
    rows = dates.to_utc(rows, ["pst"], "USH_DENALI")
    return dates.to_utc(rows, ["offset_value"], "UOR_COMMERCE_CART")


@query(
    "dt07_flexible_iso",
    sql="SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS iso FROM events",
)
def flexible_iso(source: Source):
    raw = (
        F.when(F.col("event_type") == "error", F.lit("no time"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd:HH:mm:ss.SSSSSS"))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return source.table("events").select("event_id", dates.flexible_iso(raw).alias("iso"))


@query(
    "dt08_scrub_birth_date",
    sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
  WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '1904-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dob FROM orders""",
)
def scrub_birth_date(source: Source):
    birth = F.when(F.col("o_orderkey") % 5 == 0, "1901-01-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    updated = F.when(F.col("o_orderstatus") == "F", "2020-01-01").otherwise("2018-01-01")
    return source.table("orders").select("o_orderkey", dates.scrub_birth_date(birth, updated).alias("dob"))


@query(
    "dt09_time_parts",
    sql="""SELECT event_id, year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day, hour(ts)::int AS hour, minute(ts)::int AS minute FROM events""",
)
def time_parts(source: Source):
    return source.table("events").select("event_id", *[c.alias(n) for n, c in dates.time_parts("ts").items()])


@query("dt10_iso_now", sql="SELECT event_id, '2024-02-01T00:00:00.000Z' AS stamped FROM events")
def iso_now(source: Source):
    return source.table("events").select("event_id", dates.iso_millis(dates.instant(AS_OF)).alias("stamped"))


@query(
    "dt11_expiry",
    sql="SELECT o_orderkey, epoch(o_orderdate)::bigint + 90 * 86400 AS ttl FROM orders",
)
def expiry(source: Source):
    return source.table("orders").select(
        "o_orderkey", dates.expiry_epoch(F.col("o_orderdate").cast("timestamp")).alias("ttl")
    )


@query(
    "dt12_future_report",
    sql="""SELECT count(*) AS records, count(*) FILTER (WHERE o_orderdate > TIMESTAMP '2000-06-01') AS future FROM orders""",
)
def future_report(source: Source):
    return source.table("orders").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("o_orderdate") > dates.instant("2000-06-01T00:00:00Z")).alias("future"),
    )


# ---- nested --------------------------------------------------------------


@query(
    "ar01_push_history",
    ident=True,
    sql="""SELECT batch_record_id, uxid AS past_uxid, uxid_confidence AS past_confidence FROM ident
WHERE uxid IS NOT NULL AND uxid <> coalesce(md5(concat('u', rules_guest_id)), '')""",
)
def push_history(source: Source):
    """Push the id a record had before the new one, then list the histories."""
    rows = source.ident().select(
        "batch_record_id",
        nested.push_history(
            F.lit(None).cast("array<struct<uxid:string,uxid_confidence:double,uxid_last_changed_timestamp:string>>"),
            "uxid",
            "uxid_confidence",
            F.lit("2024-02-01T00:00:00.000Z"),
            F.md5(F.concat(F.lit("u"), "rules_guest_id")),
        ).alias("past_uxids"),
    )
    return rows.select("batch_record_id", F.explode("past_uxids").alias("p")).select(
        "batch_record_id", F.col("p.uxid").alias("past_uxid"), F.col("p.uxid_confidence").alias("past_confidence")
    )


@query(
    "ar02_list_items",
    ident=True,
    sql="""SELECT batch_record_id, email FROM (
  SELECT batch_record_id, lower(trim(ml_email_address)) AS email FROM ident WHERE ml_email_address IS NOT NULL
  UNION ALL SELECT batch_record_id, lower(ml_phone) FROM ident WHERE ml_phone IS NOT NULL AND ml_email_address IS NOT NULL) WHERE email <> ''""",
)
def list_items(source: Source):
    df = source.ident()
    listed = F.when(
        F.col("ml_phone").isNotNull(), F.concat(F.lit("['"), "ml_email_address", F.lit("', '"), "ml_phone", F.lit("']"))
    ).otherwise(F.col("ml_email_address"))
    return df.select("batch_record_id", F.explode(nested.text_items(listed)).alias("email"))


@query(
    "ar03_parsed_json",
    sql="SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events",
)
def parsed_json(source: Source):
    return source.table("events").select("event_id", nested.parsed_json("props", "k bigint").alias("p")).select(
        "event_id", "p.k"
    )


@query(
    "ar04_documents",
    ident=True,
    sql="""SELECT concat_ws('_', source_name, source_customer_id) AS doc_id, batch_record_id, uxid, ml_first_name AS first_name,
  ml_email_address AS email_address, rules_guest_id AS guest_id FROM store""",
)
def documents(source: Source):
    doc = nested.as_document(source.store())
    return doc.select(
        "doc_id",
        "batch_record_id",
        "uxid",
        F.col("record_normalized.ml_first_name").alias("first_name"),
        F.col("record_normalized.ml_email_address").alias("email_address"),
        F.col("record_normalized.rules_guest_id").alias("guest_id"),
    )


@query(
    "ar05_blank_count",
    ident=True,
    sql="""SELECT batch_record_id, (coalesce(trim(ml_first_name), '') = '')::int + (coalesce(trim(ml_address_line_1), '') = '')::int
  + (coalesce(trim(ml_email_address), '') = '')::int + (coalesce(trim(ml_phone), '') = '')::int AS blanks FROM store""",
)
def blank_count(source: Source):
    doc = nested.as_document(source.store())
    fields = ["ml_first_name", "ml_address_line_1", "ml_email_address", "ml_phone"]
    return doc.select("batch_record_id", nested.blank_count([f"record_normalized.{f}" for f in fields]).alias("blanks"))
