"""The sources known today.

Table names, column names, slices and codes are fixed values given by the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.dates import parse_any, scrub_birth_date
from ..functions.keys import text_digest
from ..operators.dedupe import keep_full_times
from ..operators.groups import top_per_group
from ..operators.joins import Dimension, inner_then_left, spread_roles, star_join
from .specs import SOURCES, SourceSpec, TableSpec

# ---- single-file CSV with a derived key ----------------------------------

ADHOC_MARKERS = [
    ("uor", "UOR_ADHOC"),
    ("ush", "USH_ADHOC"),
    ("uhu", "UHULV_ADHOC"),
    ("ukr", "UKRFR_ADHOC"),
]
ADHOC_UNHASHED = ["sourcesystemlastupdatedate", "homephonenumber", "mobilephonenumber", "source_name"]


def _adhoc_key(df: DataFrame) -> DataFrame:
    hashed = [c for c in df.columns if c.lower() not in ADHOC_UNHASHED]
    return df.withColumn("source_customer_id", text_digest(hashed))


def _adhoc_clean(df: DataFrame) -> DataFrame:
    name = text.source_from_file_name("_file_name", ADHOC_MARKERS, "UDX_ADHOC")
    return text.upper_but_email(
        df.withColumn("source_name", name).drop("_file_name"), "EmailAddress", measure_raw=True
    )


def _adhoc_mapping(source: str) -> dict[str, str | Column]:
    return {
        "source_name": "source_name",
        "source_customer_id": "source_customer_id",
        "prefix": "TitleName",
        "first_name": "FirstName",
        "last_name": "LastName",
        "gender": "GenderCode",
        "birth_date": "BirthDate",
        "address_line_1": "AddressLineName1",
        "address_line_2": "AddressLineName2",
        "city": "CityName",
        "state_code": "StateCode",
        "postal_code": "PostalCode",
        "country_code": "CountryCode",
        "phone": "HomePhoneNumber",
        "email_address": "EmailAddress",
        "record_last_updated_timestamp": "SourceSystemLastUpdateDate",
    }


ADHOC = SOURCES.add(
    SourceSpec(
        code="UDX_ADHOC",
        tables=[
            TableSpec(
                name="udx_adhoc",
                keep=[
                    "TitleName",
                    "FirstName",
                    "LastName",
                    "SuffixName",
                    "AddressLineName1",
                    "AddressLineName2",
                    "CityName",
                    "StateCode",
                    "PostalCode",
                    "CountryCode",
                    "HomePhoneNumber",
                    "MobilePhoneNumber",
                    "EmailAddress",
                    "BirthDate",
                    "GenderCode",
                    "SourceSystemLastUpdateDate",
                ],
                column_count=39,
                add_file_name=True,
                transform=_adhoc_clean,
                date_columns=["BirthDate"],
                before_dedupe=lambda df: keep_full_times(df, "SourceSystemLastUpdateDate"),
                dedupe_on="SourceSystemLastUpdateDate",
                dedupe_formats=["yyyy-MM-dd HH:mm:ss.SSS"],
                after_dedupe=_adhoc_key,
            )
        ],
        join=lambda tables: tables["udx_adhoc"],
        mapping=_adhoc_mapping,
        clock="UDX_ADHOC",
    )
)

# ---- contacts with addresses (two clocks, one or four tables) ------------


def _contacts_clean(birth: str, updated: str, email: str):
    def clean(df: DataFrame) -> DataFrame:
        return text.upper_but_email(df.withColumn(birth, scrub_birth_date(birth, updated)), email)

    return clean


def _contact_mapping(names: dict[str, str]):
    def mapping(source: str) -> dict[str, str | Column]:
        return {"source_name": F.lit(source), **names}

    return mapping


DENALI = SOURCES.add(
    SourceSpec(
        code="USH_DENALI",
        tables=[
            TableSpec(
                name="ush_denali_cust_contacts",
                keep=[
                    "CustContactID",
                    "FirstName",
                    "MiddleName",
                    "LastName",
                    "Phone",
                    "Email",
                    "DOB",
                    "Gender",
                    "AddressID",
                    "LastUpdate",
                ],
                column_count=33,
                transform=_contacts_clean("DOB", "LastUpdate", "Email"),
                date_columns=["DOB"],
                dedupe_on="LastUpdate",
                dedupe_formats=["yyyy-MM-dd HH:mm:ss.SSS"],
            ),
            TableSpec(
                name="ush_denali_addresses",
                keep=["Street1", "Street2", "City", "State", "Postal", "CountryCode", "AddressID", "LastUpdate"],
                column_count=17,
                transform=text.trim_upper,
                dedupe_on="LastUpdate",
                dedupe_formats=["yyyy-MM-dd HH:mm:ss.SSS"],
                after_dedupe=lambda df: df.drop("LastUpdate"),
            ),
        ],
        join=lambda t: star_join(
            t["ush_denali_cust_contacts"], [Dimension(t["ush_denali_addresses"], "AddressID", "AddressID")]
        ),
        mapping=_contact_mapping(
            {
                "source_customer_id": "CustContactID",
                "first_name": "FirstName",
                "middle_name": "MiddleName",
                "last_name": "LastName",
                "gender": "Gender",
                "birth_date": "DOB",
                "address_line_1": "Street1",
                "address_line_2": "Street2",
                "city": "City",
                "state_code": "State",
                "postal_code": "Postal",
                "country_code": "CountryCode",
                "phone": "Phone",
                "email_address": "Email",
                "record_last_updated_timestamp": "LastUpdate",
            }
        ),
        clock="USH_DENALI",
    )
)

GALAXY_MAPPING = {
    "source_customer_id": "custcontactid",
    "first_name": "firstname",
    "middle_name": "middlename",
    "last_name": "lastname",
    "gender": "gender",
    "birth_date": "dob",
    "address_line_1": "street1",
    "address_line_2": "street2",
    "city": "city",
    "state_code": "state",
    "postal_code": "postal",
    "country_code": "countrycode",
    "phone": "phone",
    "email_address": "email",
    "record_last_updated_timestamp": "lastupdate",
}


def _galaxy_contacts(name: str, extra: list[str]) -> TableSpec:
    return TableSpec(
        name=name,
        keep=[
            "custcontactid",
            "addressid",
            "firstname",
            "middlename",
            "lastname",
            "phone",
            "email",
            "dob",
            "gender",
            "lastupdate",
            *extra,
        ],
        lower_header=True,
        column_count=33,
        transform=_contacts_clean("dob", "lastupdate", "email"),
        date_columns=["dob"],
        dedupe_on="lastupdate",
        dedupe_formats=["yyyy-MM-dd HH:mm:ss.SSS"],
    )


def _galaxy_dimension(name: str, keep: list[str], column_count: int) -> TableSpec:
    return TableSpec(
        name=name,
        keep=[*keep, "lastupdate"],
        lower_header=True,
        column_count=column_count,
        transform=text.trim_upper,
        dedupe_on="lastupdate",
        dedupe_formats=["yyyy-MM-dd HH:mm:ss.SSS"],
        after_dedupe=lambda df: df.drop("lastupdate"),
    )


GALAXY_ADDRESS = ["addressid", "street1", "street2", "city", "state", "postal", "countrycode"]

UOR_GALAXY = SOURCES.add(
    SourceSpec(
        code="UOR_GALAXY",
        tables=[
            _galaxy_contacts("uo_galaxy_custcontacts", ["nametitleid", "namesuffixid"]),
            _galaxy_dimension("uo_galaxy_addresses", GALAXY_ADDRESS, 17),
            _galaxy_dimension("uo_galaxy_name_titles", ["nametitleid", "nametitle"], 7),
            _galaxy_dimension("uo_galaxy_name_suffixes", ["namesuffixid", "namesuffix"], 7),
        ],
        join=lambda t: star_join(
            t["uo_galaxy_custcontacts"],
            [
                Dimension(t["uo_galaxy_addresses"], "addressid", "addressid"),
                Dimension(t["uo_galaxy_name_titles"], "nametitleid", "nametitleid"),
                Dimension(t["uo_galaxy_name_suffixes"], "namesuffixid", "namesuffixid"),
            ],
        ),
        mapping=_contact_mapping(GALAXY_MAPPING),
        clock="UOR_GALAXY",
    )
)

USH_GALAXY = SOURCES.add(
    SourceSpec(
        code="USH_GALAXY",
        tables=[
            _galaxy_contacts("ush_galaxy_cust_contacts", []),
            _galaxy_dimension("ush_galaxy_addresses", GALAXY_ADDRESS, 17),
        ],
        join=lambda t: star_join(
            t["ush_galaxy_cust_contacts"], [Dimension(t["ush_galaxy_addresses"], "addressid", "addressid")]
        ),
        mapping=_contact_mapping(GALAXY_MAPPING),
        clock="USH_GALAXY",
    )
)

# ---- three fixed-width files ---------------------------------------------

CARD_AREAS = {"UFL": "UOR", "USH": "USH"}


def _card_join(t: dict[str, DataFrame]) -> DataFrame:
    joined = inner_then_left(t["cif"], t["naf"], t["amf"], "arn", "previous_record_identifier")
    return joined.withColumns(
        {
            "source_name": text.area_source("agent_sub_agent", CARD_AREAS, "FNBO"),
            "zip_code": text.short_postcode("zip_code"),
        }
    )


def _card_clean(df: DataFrame) -> DataFrame:
    return text.trim_upper(df).withColumn("email", text.valid_email("email"))


FNBO = SOURCES.add(
    SourceSpec(
        code="UDX_FNBO",
        tables=[
            TableSpec(
                name="cif",
                reader="fixed",
                length=550,
                layout=[
                    ("arn", 1, 17),
                    ("last_name", 17, 37),
                    ("first_name", 37, 52),
                    ("middle_initial", 52, 53),
                    ("prefix", 53, 63),
                    ("suffix", 63, 73),
                    ("address_line_1", 73, 113),
                    ("address_line_2", 113, 153),
                    ("city", 153, 173),
                    ("state", 173, 176),
                    ("zip_code", 176, 189),
                    ("phone", 199, 209),
                    ("account_open_date", 209, 217),
                    ("email", 228, 348),
                ],
                keep=[
                    "arn",
                    "last_name",
                    "first_name",
                    "middle_initial",
                    "prefix",
                    "suffix",
                    "address_line_1",
                    "address_line_2",
                    "city",
                    "state",
                    "zip_code",
                    "email",
                    "account_open_date",
                    "phone",
                ],
                transform=_card_clean,
                dedupe_on="account_open_date",
                dedupe_formats=["yyyyMMdd"],
            ),
            TableSpec(
                name="naf",
                reader="fixed",
                length=500,
                layout=[("arn", 1, 17), ("agent_sub_agent", 349, 355)],
                keep=["arn", "agent_sub_agent"],
                after_dedupe=lambda df: top_per_group(df, ["arn"], [F.col("agent_sub_agent").asc_nulls_last()]),
            ),
            TableSpec(
                name="amf",
                reader="fixed",
                length=500,
                layout=[("arn", 1, 17), ("previous_record_identifier", 356, 372)],
                keep=["arn", "previous_record_identifier"],
                after_dedupe=lambda df: top_per_group(
                    df, ["arn"], [F.col("previous_record_identifier").asc_nulls_last()]
                ),
            ),
        ],
        join=_card_join,
        mapping=lambda source: {
            "source_name": "source_name",
            "source_customer_id": "arn",
            "prefix": "prefix",
            "first_name": "first_name",
            "middle_name": "middle_initial",
            "last_name": "last_name",
            "address_line_1": "address_line_1",
            "address_line_2": "address_line_2",
            "city": "city",
            "state_code": "state",
            "postal_code": "zip_code",
            "phone": "phone",
            "email_address": "email",
            "record_last_updated_timestamp": "account_open_date",
        },
        clock="UDX_FNBO",
    )
)

# ---- four ragged tab files -----------------------------------------------

STAY_TIME = ["MM/dd/yyyy hh:mm:ss a"]


def _contact_points(df: DataFrame) -> DataFrame:
    """Latest active e-mail and phone of each name, as two columns."""
    active = df.filter(text.is_blank("END_DATE"))
    order = F.struct("PRIMARY_YN", parse_any("UPDATE_DATE", STAY_TIME), "PHONE_NUMBER")
    wide = spread_roles(
        active, "NAME_ID", F.lower(F.trim("PHONE_ROLE")), "PHONE_NUMBER", order, ["email", "phone"]
    )
    return wide.select("NAME_ID", text.valid_email("email").alias("EMAIL"), F.col("phone").alias("PHONE"))


def _main_address(df: DataFrame) -> DataFrame:
    """The address to use per name: the primary one, then the latest."""
    order = [
        F.col("PRIMARY_YN").desc(),
        parse_any("UPDATE_DATE", STAY_TIME).desc_nulls_last(),
        *[F.col(c) for c in ("ADDRESS1", "ADDRESS2", "CITY", "STATE", "ZIP_CODE", "COUNTRY")],
    ]
    return top_per_group(df, ["NAME_ID"], order).drop("UPDATE_DATE", "PRIMARY_YN")


LOEWS = SOURCES.add(
    SourceSpec(
        code="UOR_LOEWS",
        exact_names=True,
        tables=[
            TableSpec(
                name="uo_loews_reservation_name",
                reader="tsv",
                keep=["RESV_NAME_ID", "NAME_ID", "INSERT_DATE", "UPDATE_DATE"],
                transform=lambda df: df.withColumn("NAME_ID", F.trim("NAME_ID")),
                dedupe_on="UPDATE_DATE",
                dedupe_formats=STAY_TIME,
            ),
            TableSpec(
                name="uo_loews_name",
                reader="tsv",
                keep=["BIRTH_DATE", "FIRST", "MIDDLE", "LAST", "TITLE", "NAME_ID", "UPDATE_DATE"],
                transform=lambda df: text.trim_upper(df, ["NAME_ID"]),
                date_columns=["BIRTH_DATE"],
                dedupe_on="UPDATE_DATE",
                dedupe_formats=STAY_TIME,
                after_dedupe=lambda df: df.drop("UPDATE_DATE"),
            ),
            TableSpec(
                name="uo_loews_name_address",
                reader="tsv",
                keep=[
                    "ADDRESS1",
                    "ADDRESS2",
                    "CITY",
                    "COUNTRY",
                    "STATE",
                    "ZIP_CODE",
                    "NAME_ID",
                    "UPDATE_DATE",
                    "PRIMARY_YN",
                ],
                transform=lambda df: text.trim_upper(df, ["NAME_ID"]),
                after_dedupe=_main_address,
            ),
            TableSpec(
                name="uo_loews_name_phone",
                reader="tsv",
                keep=["PHONE_NUMBER", "NAME_ID", "UPDATE_DATE", "PRIMARY_YN", "END_DATE", "PHONE_ROLE", "PHONE_TYPE"],
                transform=lambda df: text.trim_lower(df, ["NAME_ID"]),
                after_dedupe=_contact_points,
            ),
        ],
        join=lambda t: star_join(
            t["uo_loews_reservation_name"],
            [
                Dimension(t["uo_loews_name"], "NAME_ID", "NAME_ID"),
                Dimension(t["uo_loews_name_address"], "NAME_ID", "NAME_ID"),
                Dimension(t["uo_loews_name_phone"], "NAME_ID", "NAME_ID"),
            ],
        ),
        mapping=lambda source: {
            "source_name": F.lit(source),
            "source_customer_id": "RESV_NAME_ID",
            "prefix": "TITLE",
            "first_name": "FIRST",
            "middle_name": "MIDDLE",
            "last_name": "LAST",
            "birth_date": "BIRTH_DATE",
            "address_line_1": "ADDRESS1",
            "address_line_2": "ADDRESS2",
            "city": "CITY",
            "state_code": "STATE",
            "postal_code": "ZIP_CODE",
            "country_code": "COUNTRY",
            "phone": "PHONE",
            "email_address": "EMAIL",
            "record_created_timestamp": "INSERT_DATE",
            "record_last_updated_timestamp": "UPDATE_DATE",
        },
        clock="UOR_LOEWS",
    )
)
