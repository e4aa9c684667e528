"""Round trips: driver tables written in a vendor format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from ..session import new_folder
from ..sources import readers, sinks
from .registry import AS_OF, Source, query
from .resolution import CONTEXT, EMAIL_ONLY_LOG_SQL
from .tables import SCENARIO_SQL, with_scenarios

# ---- readers -------------------------------------------------------------


@query(
    "src01_csv_group",
    sql="""SELECT cast(c_custkey AS varchar) AS c_custkey, c_name || ', "Jr"' AS c_name, c_mktsegment FROM customer""",
)
def csv_group(source: Source):
    """Three parts, values holding separators and quotes, headers in upper case."""
    folder = new_folder(source.spark, "csv-group")
    rows = source.table("customer").select(
        F.col("c_custkey").cast("string").alias("C_CUSTKEY"),
        F.concat("c_name", F.lit(', "Jr"')).alias("C_NAME"),
        F.col("c_mktsegment").alias("C_MKTSEGMENT"),
    )
    rows.repartition(3, "C_CUSTKEY").write.options(header=True, escape='"').csv(folder)
    return readers.read_csv_group(source.spark, [folder], column_count=3, lower_header=True)


@query(
    "src02_ragged_tsv",
    sql="""SELECT cast(n_nationkey AS varchar) AS n_nationkey, n_name, CASE WHEN n_regionkey = 0 THEN '' ELSE cast(n_regionkey AS varchar) END AS n_regionkey
FROM nation""",
)
def ragged_tsv(source: Source):
    folder = new_folder(source.spark, "ragged")
    line = F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name")
    full = F.concat_ws("\t", line, F.col("n_regionkey").cast("string"))
    text = F.when(F.col("n_regionkey") == 0, line).when(F.col("n_regionkey") == 1, F.concat(full, F.lit("\textra")))
    source.table("nation").select(text.otherwise(full).alias("value")).write.text(folder)
    return readers.read_ragged_tsv(source.spark, [folder], ["n_nationkey", "n_name", "n_regionkey"])


@query(
    "src03_fixed_width",
    sql="SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name, cast(s_nationkey AS varchar) AS s_nationkey FROM supplier",
)
def fixed_width(source: Source):
    folder = new_folder(source.spark, "fixed")
    parts = [F.rpad(F.col(c).cast("string"), n, " ") for c, n in (("s_suppkey", 10), ("s_name", 25), ("s_nationkey", 5))]
    rows = source.table("supplier").select(F.concat(*parts).alias("HEADER ROW"))
    rows.write.options(header=True, quote="", ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False).csv(folder)
    layout = [("s_suppkey", 0, 10), ("s_name", 10, 35), ("s_nationkey", 35, 40)]
    return readers.read_fixed_width(source.spark, [folder], layout, 40)


TABLE_NAMES = ["uo_loews_name", "uo_loews_name_address", "uo_loews_name_phone", "uo_loews_reservation_name"]


def delivered_files(source: Source):
    """File names of a delivery, one per order."""
    names = F.array(*[F.lit(n) for n in [*TABLE_NAMES, "unknown_table"]])
    table = F.element_at(names, (F.col("o_orderkey") % 5 + 1).cast("int"))
    stamp = F.date_format("o_orderdate", "yyyyMMdd000000")
    part = F.when(F.col("o_orderkey") % 2 == 0, "_001_of_002").otherwise("")
    return source.table("orders").select("o_orderkey", F.concat(stamp, F.lit("_"), table, part, F.lit(".csv")).alias("file"))


@query(
    "src04_table_of_file",
    sql="""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'uo_loews_name' WHEN 1 THEN 'uo_loews_name_address'
  WHEN 2 THEN 'uo_loews_name_phone' WHEN 3 THEN 'uo_loews_reservation_name' END AS table_name FROM orders""",
)
def table_of_file(source: Source):
    return delivered_files(source).select("o_orderkey", readers.table_of_file("file", TABLE_NAMES).alias("table_name"))


@query(
    "src05_source_of_file",
    sql="""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'SRC_RED' WHEN contains(lower(p_name), 'small') THEN 'SRC_SMALL'
  ELSE 'SRC_OTHER' END AS source_name FROM part""",
)
def source_of_file(source: Source):
    from ..functions.text import source_from_file_name

    markers = [("red", "SRC_RED"), ("small", "SRC_SMALL")]
    return source.table("part").select("p_partkey", source_from_file_name("p_name", markers, "SRC_OTHER").alias("source_name"))


@query(
    "src06_batch_id",
    sql="""SELECT o_orderstatus, CASE WHEN count(DISTINCT strftime(o_orderdate, '%Y%m%d')) = 1 THEN min(strftime(o_orderdate, '%Y%m%d000000'))
  ELSE '20240201000000' END AS batch_id FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'one', min(strftime(o_orderdate, '%Y%m%d000000')) FROM orders""",
)
def batch_id(source: Source):
    """Per status, whose files carry many times, and for the files of the first day, which carry one."""
    orders = source.table("orders").select(
        "o_orderstatus", F.concat(F.lit("in/"), F.date_format("o_orderdate", "yyyyMMdd000000"), F.lit("_x.csv")).alias("file")
    )
    first = orders.join(orders.agg(F.min("file").alias("file")), "file", "left_semi")
    parts = [
        readers.batch_id(files, "file", AS_OF).select(F.lit(name).alias("o_orderstatus"), "batch_id")
        for name, files in [*((s, orders.filter(F.col("o_orderstatus") == s)) for s in ("F", "O", "P")), ("one", first)]
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    "src07_stage_override",
    ident=True,
    sql=f"""SELECT batch_record_id, md5(concat('new|', rules_guest_id)) AS uxid FROM ident WHERE uxid IS NULL AND rules_guest_id IS NOT NULL""",
)
def stage_override(source: Source):
    """A stage restarted from its stored input instead of the live chain."""
    folder = new_folder(source.spark, "stage")
    sinks.snapshot(source.ident().filter("uxid IS NULL AND rules_guest_id IS NOT NULL"), folder, 3, "after_rules")
    stored = source.spark.read.parquet(f"{folder}/03_after_rules")
    return rules.mint_ids(stored, CONTEXT.stamp).select("batch_record_id", "uxid")


@query("src08_runtime_schema", sql="SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, p_retailprice AS score FROM part")
def runtime_schema(source: Source):
    folder = new_folder(source.spark, "metadata")
    source.table("part").select("p_partkey", "p_name", "p_retailprice").write.options(escape='"').csv(folder)
    schema = readers.metadata_csv_schema(["p_partkey", "p_name"], [("score", "double")])
    return source.spark.read.schema(schema).options(escape='"').csv(folder)


@query(
    "src09_lookup_scan",
    sql="""SELECT c_custkey, c_name FROM customer WHERE lower(trim(cast(c_custkey AS varchar))) IN (
  SELECT lower(trim(cast(o_custkey AS varchar))) FROM orders WHERE o_totalprice > 450000)""",
)
def lookup_scan(source: Source):
    wanted = source.table("orders").filter("o_totalprice > 450000").select("o_custkey")
    return readers.lookup_scan(source.table("customer").select("c_custkey", "c_name"), "c_custkey", wanted, "o_custkey")


# ---- sinks ---------------------------------------------------------------


@query(
    "snk01_partitioned_write",
    sql="""SELECT 2024 AS year, 2 AS month, 1 AS day, 0 AS hour, 0 AS minute, 'run7' AS batch_id, o_orderstatus, count(*) AS records
FROM orders GROUP BY o_orderstatus""",
)
def partitioned_write(source: Source):
    folder = new_folder(source.spark, "orders")
    rows = source.table("orders").withColumn("pass_thru_data", F.lit(None).cast("string"))
    for _ in range(2):  # a repeated run adds nothing
        sinks.write_partitioned(rows, folder, AS_OF, "run7")
    stored = source.spark.read.parquet(folder)
    return stored.groupBy(*sinks.PARTITIONS, "o_orderstatus").agg(F.count(F.lit(1)).alias("records"))


@query(
    "snk02_partition_overwrite",
    sql="""SELECT event_type, CASE WHEN event_type = 'click' THEN 'second' ELSE 'first' END AS run, count(*) AS records,
  sum(event_id)::bigint AS id_sum FROM events WHERE event_type <> 'click' OR value > 10 GROUP BY ALL""",
)
def partition_overwrite(source: Source):
    """A second run with one partition replaces that partition only."""
    folder = new_folder(source.spark, "events")
    events = source.table("events").select("event_id", "event_type", "value")
    sinks.overwrite_partitions(events.withColumn("run", F.lit("first")), folder, ["event_type"])
    again = events.filter("event_type = 'click' AND value > 10").withColumn("run", F.lit("second"))
    sinks.overwrite_partitions(again, folder, ["event_type"])
    return (
        source.spark.read.parquet(folder)
        .groupBy("event_type", "run")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("id_sum"))
    )


@query("snk03_stage_snapshot", ident=True, sql="SELECT batch_record_id, uxid FROM batch")
def stage_snapshot(source: Source):
    folder = new_folder(source.spark, "debug")
    sinks.snapshot(source.batch().select("batch_record_id", "uxid"), folder, 1, "input")
    return source.spark.read.parquet(f"{folder}/01_input")


@query("snk04_json_audit", ident=True, sql=EMAIL_ONLY_LOG_SQL)
def json_audit(source: Source):
    folder = new_folder(source.spark, "audit")
    log = rules.assign_email_only(source.ident(), CONTEXT)[1]
    for _ in range(2):
        sinks.append_json(log, folder, "run7")
    return source.spark.read.schema(log.schema).json(folder).drop("run")


@query(
    "snk05_request_rows",
    ident=True,
    sql="""SELECT 'b7' AS "BATCH_ID", cast(batch_record_id AS varchar) AS "RECORD_ID", nullif(lower(trim(ml_email_address)), '') AS "INPUT_EMAIL_ADDRESS",
  trim(ml_phone) AS "INPUT_PHONE", upper(sha256(nullif(lower(trim(ml_email_address)), ''))) AS "INPUT_EMAIL_HASH",
  sha256(trim(ml_phone)) AS "INPUT_PHONE_HASH" FROM batch""",
)
def request_rows(source: Source):
    folder = new_folder(source.spark, "requests")
    for _ in range(2):
        sinks.append(sinks.request_rows(source.batch(), "b7"), folder, "b7")
        sinks.append(sinks.control_row(source.batch(), "b7", AS_OF), f"{folder}-control", "b7")
    # Requests are taken up by the control rows that say they are complete.
    control = source.spark.read.parquet(f"{folder}-control").filter("STATUS = 'NEW'").select("BATCH_ID")
    return source.spark.read.parquet(folder).drop("run").join(control, "BATCH_ID", "left_semi")


@query(
    "snk06_rejected_rows",
    ident=True,
    sql=f"SELECT batch_record_id, delete_flag FROM (SELECT batch_record_id, {SCENARIO_SQL} FROM ident) WHERE delete_flag = 'Y'",
)
def rejected_rows(source: Source):
    folder = new_folder(source.spark, "rejects")
    for _ in range(2):
        sinks.write_rejects(with_scenarios(source), folder, "run7")
    return source.spark.read.parquet(folder).select("batch_record_id", "delete_flag")


@query("snk07_split_write", sql="SELECT event_id, event_type = 'error' AS skip_ml FROM events")
def split_write(source: Source):
    folder = new_folder(source.spark, "split")
    sinks.write_split(source.table("events").select("event_id", (F.col("event_type") == "error").alias("skip_ml")), folder)
    return source.spark.read.parquet(folder).select("event_id", F.col("skip_ml").cast("boolean").alias("skip_ml"))


@query(
    "snk08_bounded_files",
    sql="SELECT l_returnflag, count(*) AS records, true AS within_bound FROM lineitem GROUP BY l_returnflag",
)
def bounded_files(source: Source):
    folder = new_folder(source.spark, "export")
    sinks.write_export(source.table("lineitem").select("l_orderkey", "l_returnflag"), folder, max_rows=5_000, gzip=True)
    stored = source.spark.read.options(header=True).schema("l_orderkey bigint, l_returnflag string").csv(folder)
    tagged = stored.select("l_returnflag", F.col("_metadata.file_name").alias("file"))
    per_file = tagged.groupBy("file", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_file.groupBy("file").agg(F.sum("n").alias("file_rows"))
    return (
        per_file.join(sizes, "file")
        .groupBy("l_returnflag")
        .agg(F.sum("n").alias("records"), (F.max("file_rows") <= 5_000).alias("within_bound"))
    )
