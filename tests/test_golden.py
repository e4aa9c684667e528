"""Literal inputs and outputs of cleaners, readers and rules."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from kinloom.functions import dates, keys, nested, text
from kinloom.operators import aggregates, dedupe, joins, project, rules, store
from kinloom.schema import HISTORY_TYPE
from kinloom.sources import readers, sinks

AS_OF = "2025-11-01T12:00:00Z"


def one_column(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def outputs(df, name="v"):
    return [r[name] for r in df.orderBy("i").select(name).collect()]


DATE_CASES = {
    "birth_date": [
        ("Aug 06, 2023", "2023-08-06"),
        ("2050-01-01", None),
        ("1899-12-31", None),
        ("2023/02/28", "2023-02-28"),
        (" 2023-05-07 ", "2023-05-07"),
        ("n/a", None),
        ("1-1-1823", None),
        ("10-Aug-22", "2022-08-10"),
        ("null", None),
        ("20230806", "2023-08-06"),
        ("1/1/1823", None),
        ("20-Jul-2000", "2000-07-20"),
        ("2/29/2023", None),
        ("1/1/23 12:00 AM", "2023-01-01"),
        ("na", None),
        ("September 4, 2000", "2000-09-04"),
        ("20-July-2000", "2000-07-20"),
        ("8/1/23 12:00 PM", "2023-08-01"),
        ("NOT NULL", None),
        ("Feb 30, 2023", None),
    ],
    "record_created_timestamp": [
        ("2023-05-06 13:45:00", "2023-05-06T13:45:00.000Z"),
        ("2020/07/15 09:00:00", "2020-07-15T09:00:00.000Z"),
        ("Aug 07, 2023", "2023-08-07T00:00:00.000Z"),
        ("invalid", None),
        ("06-Aug-2023", "2023-08-06T00:00:00.000Z"),
        ("2023-08-06T15:30:00", "2023-08-06T15:30:00.000Z"),
        ("2026-12-31 23:59:59", None),
        ("August 06, 2023", "2023-08-06T00:00:00.000Z"),
        ("", None),
    ],
}


@pytest.mark.parametrize("column", list(DATE_CASES))
def test_clean_dates(spark, column):
    df = one_column(spark, [a for a, _ in DATE_CASES[column]], column)
    assert outputs(dates.clean_dates(df, AS_OF), column) == [b for _, b in DATE_CASES[column]]


def test_clean_dates_is_idempotent(spark):
    df = one_column(spark, [a for a, _ in DATE_CASES["birth_date"]], "birth_date")
    once = dates.clean_dates(df, AS_OF)
    assert once.collect() == dates.clean_dates(once, AS_OF).collect()


@pytest.mark.parametrize(
    ("source", "value", "expected"),
    [
        ("UDX_ADHOC", "2024-07-01 00:00:00.000", "2024-07-01T05:00:00.000Z"),
        ("UDX_ADHOC", "7/1/2024", "2024-07-01T05:00:00.000Z"),
        ("UOR_WIFI", "2024-01-01 00:00:00", "2024-01-01T05:00:00.000Z"),
        ("USH_TRISEPT", "2024-07-01 00:00:00", "2024-07-01T05:00:00.000Z"),
        ("USH_TRISEPT", "2024-01-01 00:00:00", "2024-01-01T06:00:00.000Z"),
        ("USH_WIFI", "2024-07-01 00:00:00", "2024-07-01T07:00:00.000Z"),
        ("USH_WIFI", "2024-01-01 00:00:00", "2024-01-01T08:00:00.000Z"),
        ("UOR_COMMERCE_CART", "2024-10-24T17:47:18.726-04:00", "2024-10-24T21:47:18.726Z"),
        ("UOR_COLORVISION", "7/1/2024 1:05 PM", "2024-07-01T18:05:00.000Z"),
        ("UDX_FNBO", "20240101", "2024-01-01T06:00:00.000Z"),
        ("ELSEWHERE", "2024-01-01", "2024-01-01T00:00:00.000Z"),
        ("UOR_LOEWS", "not a time", None),
    ],
)
def test_to_utc(spark, source, value, expected):
    assert outputs(dates.to_utc(one_column(spark, [value]), ["v"], source)) == [expected]


def test_zone_override(spark):
    df = dates.to_utc(
        one_column(spark, ["2024-07-01 00:00:00"]), ["v"], "UOR_WIFI", {"EST": "America/New_York"}
    )
    assert outputs(df) == ["2024-07-01T04:00:00.000Z"]


def test_flexible_iso(spark):
    df = one_column(
        spark,
        ["2024-10-23:02:54:32.458183", "2024-10-23T02:54:32.458+02:00", "2024-10-23 02:54:32", "", None, "soon"],
    )
    assert outputs(df.withColumn("v", dates.flexible_iso("v"))) == [
        "2024-10-23T02:54:32.458Z",
        "2024-10-23T00:54:32.458Z",
        "2024-10-23T02:54:32.000Z",
        None,
        None,
        None,
    ]


def test_birth_date_scrub(spark):
    df = spark.createDataFrame(
        [(0, "1901-01-01", "2020-01-01"), (1, "1980-02-29", "2020-01-01"), (2, "1980-02-29", "2018-01-01")],
        "i int, v string, u string",
    )
    assert outputs(df.withColumn("v", dates.scrub_birth_date("v", "u"))) == [None, "1904-02-29", "1980-02-29"]


def test_text_cases(spark):
    df = one_column(spark, ["abc@x.y", "noat", "@x"])
    assert outputs(df.withColumn("v", text.email_local_part("v"))) == ["abc", "", ""]
    df = one_column(spark, [" A@b.C ", " ", None])
    digest = hashlib.sha256(b"a@b.c").hexdigest().upper()
    assert outputs(df.withColumn("v", keys.email_hash("v"))) == [digest, None, None]
    df = spark.createDataFrame([("null", "TX")], "State string, state_code string")
    assert df.select(text.first_usable(df, ["state", "STATE_CODE"])).first()[0] == "TX"
    df = one_column(spark, ["2023–01–02", "a−b"])
    assert outputs(df.withColumn("v", text.plain_dashes("v"))) == ["2023-01-02", "a-b"]
    df = one_column(spark, ["UOR_UOR_1", "x_UOR_", None])
    assert outputs(df.withColumn("v", text.replace_prefix("v", "UOR_", "UDX_"))) == ["UDX_UOR_1", "x_UOR_", None]
    df = one_column(spark, ["a@b.c", "a@b", "a@@b.c", "x" * 130 + "@b.c", " A@B.Co "])
    assert outputs(df.withColumn("v", text.clean_email("v"))) == ["a@b.c", None, None, None, "a@b.co"]


def test_email_length_before_or_after_trim(spark):
    long = " " * 120 + "someone@ex.com"
    df = one_column(spark, [long])
    assert outputs(df.withColumn("v", text.valid_email("v"))) == ["someone@ex.com"]
    assert outputs(df.withColumn("v", text.valid_email("v", measure_raw=True))) == [None]


def test_list_items(spark):
    df = one_column(spark, ["['A@x.y', ' b@x.y']", "C@x.y", " ", None])
    rows = df.select("i", F.explode(nested.text_items("v")).alias("v")).orderBy("i", "v").collect()
    assert [r["v"] for r in rows] == ["a@x.y", "b@x.y", "c@x.y"]


# ---- readers and writers -------------------------------------------------


def put(folder, name, content):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(content)
    return path


def test_csv_group(spark, tmp_path):
    paths = [
        put(tmp_path, "t_001_of_002.csv", 'Id,Name\n1,"a ""q"", b"\n2,"two\nlines"\n'),
        put(tmp_path, "t_002_of_002.csv", "Id,Name\n3,\n"),
    ]
    df = readers.read_csv_group(spark, paths, column_count=2, lower_header=True)
    assert {tuple(r) for r in df.collect()} == {("1", 'a "q", b'), ("2", "two\nlines"), ("3", None)}
    with pytest.raises(ValueError, match="2 columns where 3"):
        readers.read_csv_group(spark, paths, column_count=3)


def test_csv_group_checks_every_header(spark, tmp_path):
    paths = [put(tmp_path, "a.csv", "Id,Name\n1,x\n"), put(tmp_path, "b.csv", "Id,Nom\n2,y\n")]
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv_group(spark, paths).collect()


def test_csv_quarantine(spark, tmp_path):
    path = put(tmp_path, "a.csv", "Id,Name\n1,x\n2,y,z\n")
    rows = readers.read_csv_group(spark, [path], multi_line=False, malformed="quarantine").collect()
    assert {r["Id"]: r[readers.BAD_ROW] for r in rows} == {"1": None, "2": "2,y,z"}
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_group(spark, [path], multi_line=False, malformed="fail").collect()


def test_ragged_tsv(spark, tmp_path):
    path = put(tmp_path, "t.csv", "a\tb\na\tb\tc\td\n")
    assert [tuple(r) for r in readers.read_ragged_tsv(spark, [path], ["x", "y", "z"]).collect()] == [
        ("a", "b", ""),
        ("a", "b", "c"),
    ]


def test_fixed_width(spark, tmp_path):
    layout = [("k", 0, 1), ("v", 1, 4)]
    good = put(tmp_path, "g", "HEAD\n1ab \n2\"x,\n")
    other = put(tmp_path, "h", "HEAD\n3cd \n")
    rows = readers.read_fixed_width(spark, [good, other], layout, 4).collect()
    assert {tuple(r) for r in rows} == {("1", "ab"), ("2", '"x,'), ("3", "cd")}
    bad = put(tmp_path, "b", "HEAD\n1ab \n12\n")
    with pytest.raises(Exception, match="line length is not 4: 2"):
        readers.read_fixed_width(spark, [bad], layout, 4).collect()
    rows = readers.read_fixed_width(spark, [bad], layout, 4, on_bad="quarantine").collect()
    assert {tuple(r) for r in rows} == {("1", "ab", None), (None, None, "12")}


def test_routing_and_batch_id(spark):
    names = ["uo_loews_name", "uo_loews_name_phone"]
    path = "s/20240912030006_uo_loews_name_001_of_002.csv"
    assert readers.route_paths([path], names) == {"uo_loews_name": [path]}
    with pytest.raises(ValueError, match="no table"):
        readers.route_paths(["x/other.csv"], names)
    with pytest.raises(ValueError, match="not CSV"):
        readers.csv_only(["a.csv", "b.xlsx"])

    def run(*paths):
        return readers.batch_id(spark.createDataFrame([(p,) for p in paths], "p string"), "p", AS_OF).first()[0]

    assert run(path, "s/20240912030006_b.csv") == "20240912030006"
    assert run(path, "s/20240912030007_b.csv") == "20251101120000"
    assert run("s/none.csv") == "20251101120000"


def test_write_partitioned(spark, tmp_path):
    df = spark.range(5).withColumn("pass_thru_data", F.lit("p")).withColumn("x", F.lit(1))
    path, rows = sinks.write_partitioned(df, str(tmp_path / "o"), AS_OF, "b1")
    assert rows == 5
    assert path.endswith("year=2025/month=11/day=1/hour=12/minute=0/batch_id=b1")
    assert spark.read.parquet(path).columns == ["id", "x", "tx_datetime", "pass_thru_data"]


# ---- operators -----------------------------------------------------------


def test_full_times_win(spark):
    rows = [("a", "9/9/2024"), ("a", "2024-09-09 10:11:12.123"), ("b", "9/9/2024"), ("b", "2024-09-10"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, t string")
    out = {tuple(r) for r in dedupe.keep_full_times(df, "t").collect()}
    assert out == {
        ("a", "2024-09-09 10:11:12.123"),
        ("b", "2024-09-09 00:00:00.000"),
        ("b", "2024-09-10 00:00:00.000"),
        ("c", None),
    }


def test_dedupe_latest_modes(spark):
    rows = [("a", None, "1/2/2024"), ("a", None, "11/1/2023"), ("a", None, "?"), ("b", "x", "?")]
    df = spark.createDataFrame(rows, "K string, n string, T string")
    kept = {tuple(r) for r in dedupe.dedupe_latest(df, "t", ["M/d/yyyy"]).collect()}
    assert kept == {("a", None, "1/2/2024"), ("b", "x", "?")}
    dropped = dedupe.dedupe_latest(df, "t", ["M/d/yyyy"], drop_invalid=True, preserve_case=False)
    assert dropped.columns == ["k", "n", "t"]
    assert {tuple(r) for r in dropped.collect()} == {("a", None, "1/2/2024")}


def test_circuit_breaker(spark):
    aggregates.circuit_breaker(spark.range(9_999), spark.range(1))
    aggregates.circuit_breaker(spark.range(20_000), spark.range(0))
    with pytest.raises(RuntimeError):
        aggregates.circuit_breaker(spark.range(10_000), spark.range(400))


def test_star_join_keys_and_clashes(spark):
    base = spark.createDataFrame([(1, 10), (2, None)], "id int, t int")
    titles = spark.createDataFrame([(10, "Dr")], "k int, title string")
    out = joins.star_join(base, [joins.Dimension(titles, "t", "k")])
    assert {tuple(r) for r in out.collect()} == {(1, 10, "Dr"), (2, None, None)}
    with pytest.raises(ValueError, match="both sides"):
        joins.star_join(base, [joins.Dimension(titles.withColumnRenamed("title", "ID"), "t", "k")])


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="missing columns: b"):
        project.require(spark.range(1).toDF("a"), ["a", "b"])


def test_updated_falls_back_to_created(spark):
    df = spark.createDataFrame([("t1", ""), ("t1", None), ("t1", "t2")], "c string, u string")
    got = sorted(r[0] for r in df.select(project.updated_or_created("u", "c")).collect())
    assert got == ["t1", "t1", "t2"]


IDENT = (
    "batch_record_id long, ml_email_address string, rules_guest_id string, uxid string, "
    "uxid_confidence double, id_res_last_updated_timestamp string"
)
CONTEXT = rules.RunContext("job", AS_OF)


def test_component_election_takes_the_first_row(spark):
    rows = [
        (1, None, "g", "u0", None, None),
        (2, None, "g", "u2", 0.5, "2024-01-02"),
        (3, None, "g", "u1", 0.9, "2024-01-01"),
        (4, None, None, None, None, None),
    ]
    out = rules.guest_id_rule(spark.createDataFrame(rows, IDENT), CONTEXT)
    got = {r["batch_record_id"]: (r["uxid"], r["uxid_confidence"], r["id_res_last_updated_timestamp"]) for r in out.collect()}
    assert got == {1: ("u1", 0.9, "2024-01-01"), 2: ("u1", 0.9, "2024-01-01"), 3: ("u1", 0.9, "2024-01-01"), 4: (None, None, None)}


def test_election_without_values_fails(spark):
    rows = [(1, None, "g", "u0", None, None)]
    with pytest.raises(Exception, match="elected row without value"):
        rules.guest_id_rule(spark.createDataFrame(rows, IDENT), CONTEXT).collect()


def test_null_and_blank_emails_never_meet(spark):
    rows = [
        (1, None, None, "a", 1.0, "t1"),
        (2, None, None, "b", 1.0, "t2"),
        (3, " ", None, "c", 1.0, "t3"),
        (4, "", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, IDENT)
    out = {r["batch_record_id"]: r["uxid"] for r in rules.oldest_email_rule(df, CONTEXT).collect()}
    assert out == {1: "a", 2: "b", 3: "c", 4: None}
    only, log = rules.assign_email_only(df, CONTEXT)
    assert {r["batch_record_id"]: r["uxid"] for r in only.collect()} == out
    assert log.count() == 0


def test_regenerated_history(spark):
    rows = [("S", "1", "o", None, None), ("S", "2", "p", 0.5, None)]
    df = spark.createDataFrame(rows, "source_name string, source_customer_id string, uxid string, uxid_confidence double, x int")
    df = df.withColumn("past_uxids", F.lit(None).cast(HISTORY_TYPE))
    ids = spark.createDataFrame([("S_1",), ("S_9",), ("S_1",)], "doc string")
    out = store.regenerate_ids(df, ids, "job", CONTEXT.stamp)
    by_key = {r["source_customer_id"]: r for r in out.table.collect()}
    assert by_key["2"]["uxid"] == "p" and by_key["2"]["past_uxids"] is None
    new = by_key["1"]
    assert new["uxid"] != "o" and new["uxid_confidence"] == 1.0
    assert [tuple(p) for p in new["past_uxids"]] == [("o", 1.0, "2025-11-01T12:00:00.000Z")]
    assert out.changes.count() == 1 and out.backup.first()["uxid"] == "o"


def test_duplicate_email_keeper_of_any_keeps_all(spark):
    rows = [(1, "['a@x', 'b@x']", "2024-01-01"), (2, "A@x", "2024-01-02"), (3, "b@x", None), (4, "c@x", "2024")]
    df = spark.createDataFrame(rows, "batch_record_id int, ml_email_address string, record_last_updated_timestamp string")
    out = {r[0]: r[1] for r in store.clean_duplicate_emails(df).table.collect()}
    assert out == {1: "['a@x', 'b@x']", 2: "A@x", 3: None, 4: "c@x"}


def test_dashed_id(spark):
    value = spark.range(1).select(keys.stable_id(F.lit("k"), dashed=True)).first()[0]
    assert value.replace("-", "") == hashlib.md5(b"new|k").hexdigest() and value.count("-") == 4
