"""Each known source from small invented files to common records."""

import os

import pytest
from pyspark.sql import functions as F

from kinloom.plans.ingest import ingest, read_table, to_common
from kinloom.schema import COMMON_COLUMNS
from kinloom.sources.specs import SOURCES

AS_OF = "2025-11-01T12:00:00Z"


def put(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def csv(spec, rows, count):
    """Header and rows with the kept columns plus fillers up to the file's width."""
    names = [*spec.keep, *[f"filler{i}" for i in range(count - len(spec.keep))]]
    return [",".join(names), *[",".join(f'"{r.get(n, "")}"' for n in names) for r in rows]]


def records(df):
    return {r["source_customer_id"]: r for r in df.collect()}


def test_registry():
    assert SOURCES.codes() == ["UDX_ADHOC", "UDX_FNBO", "UOR_GALAXY", "UOR_LOEWS", "USH_DENALI", "USH_GALAXY"]
    with pytest.raises(ValueError, match="unknown source"):
        SOURCES.get("NOPE")


def test_adhoc(spark, tmp_path):
    spec = SOURCES.get("UDX_ADHOC").table("udx_adhoc")
    ann = {"FirstName": " ann ", "EmailAddress": " Ann@X.y ", "BirthDate": "2/28/1990", "PostalCode": "1"}
    rows = [
        {**ann, "SourceSystemLastUpdateDate": "9/9/2024"},
        {**ann, "SourceSystemLastUpdateDate": "2024-09-09 10:11:12.123"},
        {**ann, "SourceSystemLastUpdateDate": "2024-09-08 10:11:12.123"},
        {"FirstName": "bob", "SourceSystemLastUpdateDate": "9/9/2024"},
    ]
    path = put(tmp_path, "20240912030006_ush_udx_adhoc_001_of_001.csv", csv(spec, rows, 39))
    out = to_common(spark, "udx_adhoc", [path], AS_OF)
    assert out.columns[:20] == COMMON_COLUMNS
    by_name = {r["first_name"]: r for r in out.collect()}
    assert set(by_name) == {"ANN", "BOB"} and out.count() == 2
    ann = by_name["ANN"]
    assert ann["record_last_updated_timestamp"] == "2024-09-09T15:11:12.123Z"
    assert (ann["email_address"], ann["birth_date"], ann["source_name"]) == ("ann@x.y", "1990-02-28", "USH_ADHOC")
    assert by_name["BOB"]["record_last_updated_timestamp"] == "2024-09-09T05:00:00.000Z"
    assert len(ann["source_customer_id"]) == 32 and ann["guest_id"] == ""


def contact(**extra):
    return {"FirstName": "ann", "AddressID": "a1", "DOB": "1980-02-29", "LastUpdate": "2020-01-01 00:00:00.000", **extra}


def test_denali(spark, tmp_path):
    spec = SOURCES.get("USH_DENALI")
    contacts, addresses = spec.tables
    files = [
        put(tmp_path, "20240101000000_ush_denali_cust_contacts_001_of_002.csv",
            csv(contacts, [contact(CustContactID="1", Email="A@B.c")], 33)),
        put(tmp_path, "20240101000000_ush_denali_cust_contacts_002_of_002.csv",
            csv(contacts, [contact(CustContactID="2", AddressID="zz", LastUpdate="2018-07-01 00:00:00.000")], 33)),
        put(tmp_path, "20240101000000_ush_denali_addresses_001_of_001.csv",
            csv(addresses, [{"AddressID": "a1", "City": "rome", "LastUpdate": "2020-01-01 00:00:00.000"}], 17)),
    ]
    out = records(to_common(spark, "USH_DENALI", files, AS_OF))
    assert (out["1"]["city"], out["1"]["birth_date"], out["1"]["email_address"]) == ("ROME", "1904-02-29", "a@b.c")
    assert (out["2"]["city"], out["2"]["birth_date"]) == (None, "1980-02-29")
    assert out["1"]["record_last_updated_timestamp"] == "2020-01-01T08:00:00.000Z"
    assert out["2"]["record_last_updated_timestamp"] == "2018-07-01T07:00:00.000Z"
    with pytest.raises(ValueError, match="no files for"):
        to_common(spark, "USH_DENALI", files[:2], AS_OF)
    path, rows = ingest(spark, "USH_DENALI", files, str(tmp_path / "out"), AS_OF)
    assert rows == 2 and path.endswith("batch_id=20240101000000")
    stored = spark.read.parquet(path)
    assert {"ml_first_name", "rules_guest_id", "source_name"} <= set(stored.columns)
    assert stored.columns[-1] == "pass_thru_data"
    assert stored.filter(F.col("pass_thru_data").isNotNull()).count() == 0


@pytest.mark.parametrize("source", ["UOR_GALAXY", "USH_GALAXY"])
def test_galaxy(spark, tmp_path, source):
    spec = SOURCES.get(source)
    rows = {
        0: [{"custcontactid": "1", "firstname": "ann", "addressid": "a1", "nametitleid": "t1", "lastupdate": "2020-01-01 00:00:00.000"}],
        1: [{"addressid": "a1", "city": "rome", "lastupdate": "2020-01-01 00:00:00.000"}],
        2: [{"nametitleid": "t1", "nametitle": "dr", "lastupdate": "2020-01-01 00:00:00.000"}],
        3: [{"namesuffixid": "s1", "namesuffix": "jr", "lastupdate": "2020-01-01 00:00:00.000"}],
    }
    files = []
    for i, t in enumerate(spec.tables):
        lines = csv(t, rows[i], t.column_count)
        lines[0] = lines[0].upper()
        files.append(put(tmp_path, f"20240101000000_{t.name}_001_of_001.csv", lines))
    out = records(to_common(spark, source, files, AS_OF))
    assert out["1"]["city"] == "ROME" and out["1"]["prefix"] == ""
    hours = {"UOR_GALAXY": "05", "USH_GALAXY": "08"}[source]
    assert out["1"]["record_last_updated_timestamp"] == f"2020-01-01T{hours}:00:00.000Z"
    if source == "UOR_GALAXY":
        assert out["1"]["nametitle"] == "DR" and out["1"]["namesuffix"] is None


@pytest.mark.parametrize("source", ["UDX_ADHOC", "USH_DENALI", "UOR_GALAXY", "USH_GALAXY"])
def test_quoted_line_breaks_stay_in_their_value(spark, tmp_path, source):
    for t in SOURCES.get(source).tables:
        first, last = t.keep[0], t.keep[-1]
        lines = csv(t, [{first: "1 Main St\nApt 2", last: "end"}, {first: "two"}], t.column_count)
        rows = read_table(spark, t, [put(tmp_path, f"20240101000000_{t.name}_001_of_001.csv", lines)]).collect()
        assert [(r[first], r[last]) for r in rows] == [("1 Main St\nApt 2", "end"), ("two", None)]


def fixed(spec, row):
    line = [" "] * spec.length
    for name, start, end in spec.layout:
        line[start:end] = list(row.get(name, "").ljust(end - start)[: end - start])
    return "".join(line)


def test_fnbo(spark, tmp_path):
    spec = SOURCES.get("UDX_FNBO")
    cif, naf, amf = spec.tables
    files = [
        put(tmp_path, "20240101000000_cif_a.txt", ["H", *[fixed(cif, {"arn": a, "first_name": "ann", "zip_code": "123456789", "account_open_date": "20240101", "email": "A@b.c"}) for a in ("1", "2", "3")]]),
        put(tmp_path, "20240101000000_naf_a.txt", ["H", fixed(naf, {"arn": "1", "agent_sub_agent": "UFL001"}), fixed(naf, {"arn": "2", "agent_sub_agent": "XXX"})]),
        put(tmp_path, "20240101000000_amf_a.txt", ["H", fixed(amf, {"arn": "1", "previous_record_identifier": "9"})]),
    ]
    out = records(to_common(spark, "UDX_FNBO", files, AS_OF))
    assert set(out) == {"1", "2"}
    assert (out["1"]["source_name"], out["2"]["source_name"]) == ("UOR_FNBO", None)
    assert (out["1"]["postal_code"], out["1"]["email_address"], out["1"]["first_name"]) == ("12345", "a@b.c", "ANN")
    assert out["1"]["record_last_updated_timestamp"] == "2024-01-01T06:00:00.000Z"


def test_loews(spark, tmp_path):
    spec = SOURCES.get("UOR_LOEWS")
    columns = {t.name: ["X", *t.keep] for t in spec.tables}

    def lines(table, rows):
        return ["\t".join(r.get(c, "x" if c == "X" else "") for c in columns[table]) for r in rows]

    rows = {
        "uo_loews_reservation_name": [
            {"RESV_NAME_ID": "r1", "NAME_ID": "n1", "INSERT_DATE": "01/01/2024 01:00:00 PM", "UPDATE_DATE": "01/02/2024 01:00:00 AM"},
            {"RESV_NAME_ID": "r2", "NAME_ID": "n2", "UPDATE_DATE": "01/02/2024 01:00:00 AM"},
        ],
        "uo_loews_name": [{"NAME_ID": "n1", "FIRST": "ann", "BIRTH_DATE": "1/2/1990", "UPDATE_DATE": "01/02/2024 01:00:00 AM"}],
        "uo_loews_name_address": [
            {"NAME_ID": "n1", "CITY": "old", "PRIMARY_YN": "Y", "UPDATE_DATE": "12/31/2022 01:00:00 AM"},
            {"NAME_ID": "n1", "CITY": "new", "PRIMARY_YN": "Y", "UPDATE_DATE": "01/01/2024 01:00:00 AM"},
            {"NAME_ID": "n1", "CITY": "other", "PRIMARY_YN": "N", "UPDATE_DATE": "01/01/2025 01:00:00 AM"},
        ],
        "uo_loews_name_phone": [
            {"NAME_ID": "n1", "PHONE_ROLE": "EMAIL", "PHONE_NUMBER": "A@b.c", "PRIMARY_YN": "Y", "UPDATE_DATE": "01/01/2024 01:00:00 AM"},
            {"NAME_ID": "n1", "PHONE_ROLE": "PHONE", "PHONE_NUMBER": "1", "PRIMARY_YN": "Y", "UPDATE_DATE": "12/01/2023 01:00:00 PM"},
            {"NAME_ID": "n1", "PHONE_ROLE": "PHONE", "PHONE_NUMBER": "2", "PRIMARY_YN": "Y", "UPDATE_DATE": "01/01/2024 01:00:00 AM"},
            {"NAME_ID": "n1", "PHONE_ROLE": "PHONE", "PHONE_NUMBER": "3", "PRIMARY_YN": "Y", "END_DATE": "x", "UPDATE_DATE": "01/01/2025 01:00:00 AM"},
        ],
    }
    files = [put(tmp_path, f"20240101000000_{t}.csv", lines(t, r)) for t, r in rows.items()]
    out = records(to_common(spark, "UOR_LOEWS", files, AS_OF, columns))
    assert set(out) == {"r1", "r2"}
    assert (out["r1"]["city"], out["r1"]["phone"], out["r1"]["email_address"]) == ("NEW", "2", "a@b.c")
    assert (out["r1"]["birth_date"], out["r1"]["first_name"]) == ("1990-01-02", "ANN")
    assert out["r1"]["record_created_timestamp"] == "2024-01-01T18:00:00.000Z"
    assert out["r2"]["first_name"] is None
