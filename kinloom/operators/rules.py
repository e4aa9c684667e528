"""Identity rules: mint, fall back, join up by guest id or e-mail, elect one id."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_millis, instant
from ..functions.keys import stable_id
from ..functions.text import is_blank, lookup_key
from ..session import cut_lineage
from .groups import attach, election_order, top_per_group
from .graph import connected_components, star_edges

ID_COLUMNS = ["uxid", "uxid_confidence", "id_res_last_updated_timestamp"]


@dataclass(frozen=True)
class RunContext:
    """What a rule may know about the run it is part of."""

    job_id: str
    as_of: str
    debug_path: str | None = None

    @property
    def stamp(self) -> Column:
        return iso_millis(instant(self.as_of))


# ---- minting and fall-back -----------------------------------------------


def mint_ids(df: DataFrame, stamp: Column, key: str = "rules_guest_id", salt: str = "new") -> DataFrame:
    """Rows with a key but no id get the id derived from the key."""
    fresh = F.col(key).isNotNull() & F.col("uxid").isNull()
    return df.withColumns(
        {
            "uxid": F.when(fresh, stable_id(key, salt)).otherwise(F.col("uxid")),
            "uxid_confidence": F.when(fresh, F.lit(1.0)).otherwise(F.col("uxid_confidence")),
            "id_res_last_updated_timestamp": F.when(fresh, stamp).otherwise(F.col("id_res_last_updated_timestamp")),
        }
    )


def best_id_per_email(df: DataFrame, email_key: Column) -> DataFrame:
    """(email_key, email_uxid): the elected row's id among rows with id and e-mail."""
    rows = df.select(email_key.alias("email_key"), *ID_COLUMNS, "batch_record_id").filter(
        F.col("email_key").isNotNull() & F.col("uxid").isNotNull()
    )
    return top_per_group(rows, ["email_key"], election_order()).select("email_key", F.col("uxid").alias("email_uxid"))


def fill_from_email(df: DataFrame, email: str = "ml_email_address") -> DataFrame:
    """Adds ``candidate_uxid``: the row's own id, else the best id of its e-mail."""
    best = best_id_per_email(df, lookup_key(email))
    needs = F.when(F.col("uxid").isNull(), lookup_key(email))
    filled = attach(df.withColumn("email_key", needs), best, "email_key", "batch_record_id")
    return filled.withColumn("candidate_uxid", F.coalesce("uxid", "email_uxid")).drop("email_key", "email_uxid")


# ---- elections -----------------------------------------------------------


def _checked(winners: DataFrame, group: str) -> DataFrame:
    """Fail the job when an elected row lacks one of the three values."""
    gap = F.concat(F.lit("elected row without value in group "), F.col(group))
    return winners.withColumns(
        {f"elected_{c}": F.coalesce(F.col(f"elected_{c}"), F.raise_error(gap).cast(t)) for c, t in _ID_TYPES.items()}
    )


_ID_TYPES = {"uxid": "string", "uxid_confidence": "double", "id_res_last_updated_timestamp": "string"}


def guest_components(df: DataFrame, id_col: str = "candidate_uxid", key: str = "rules_guest_id") -> DataFrame:
    """(id, component) of the graph in which ids sharing a guest id are linked."""
    return connected_components(*guest_links(df, id_col, key))


def guest_links(
    df: DataFrame, id_col: str = "candidate_uxid", key: str = "rules_guest_id"
) -> tuple[DataFrame, DataFrame]:
    """The vertices (id) and edges (src, dst) of that graph."""
    return df.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull()), star_edges(df, key, id_col)


def elect_component_id(df: DataFrame, components: DataFrame, strict: bool = True) -> DataFrame:
    """Every row of a component takes its first row's id, confidence and time.

    The election runs per candidate id first, so only one row per id meets the
    component labels; the rows themselves are shuffled once, for the final join.
    """
    return _take_elected(df, components, _finalists(df), strict)


def _finalists(df: DataFrame) -> DataFrame:
    """The first row of each candidate id."""
    rows = df.filter(F.col("candidate_uxid").isNotNull())
    return top_per_group(
        rows.select("candidate_uxid", *ID_COLUMNS[1:], "batch_record_id"), ["candidate_uxid"], election_order()
    )


def _take_elected(df: DataFrame, components: DataFrame, finalists: DataFrame, strict: bool) -> DataFrame:
    order = election_order()
    finalists = finalists.join(components.withColumnRenamed("id", "candidate_uxid"), "candidate_uxid")
    winners = top_per_group(finalists, ["component"], order).select(
        "component",
        F.col("candidate_uxid").alias("elected_uxid"),
        *[F.col(c).alias(f"elected_{c}") for c in ID_COLUMNS[1:]],
    )
    if strict:
        winners = _checked(winners, "component")
    by_id = (
        components.join(winners, "component")
        .drop("component")
        .withColumnRenamed("id", "candidate_uxid")
    )
    joined = attach(df, by_id, "candidate_uxid", "batch_record_id")
    return joined.withColumns(
        {c: F.when(F.col("elected_uxid").isNotNull(), F.col(f"elected_{c}")).otherwise(F.col(c)) for c in ID_COLUMNS}
    ).drop("candidate_uxid", *[f"elected_{c}" for c in ID_COLUMNS])


def elect_email_id(df: DataFrame, email: str = "ml_email_address", strict: bool = True) -> DataFrame:
    """Every row of an e-mail takes its oldest row's id.

    Rows without e-mail stay as they are, and so do e-mails no row of which has
    an id yet: a later rule may mint one.
    """
    keyed = df.withColumn("email_key", lookup_key(email))
    winners = top_per_group(
        keyed.filter(F.col("email_key").isNotNull() & F.col("uxid").isNotNull()).select("email_key", *ID_COLUMNS, "batch_record_id"),
        ["email_key"],
        election_order(),
    ).select("email_key", *[F.col(c).alias(f"elected_{c}") for c in ID_COLUMNS])
    if strict:
        winners = _checked(winners, "email_key")
    joined = attach(keyed, winners, "email_key", "batch_record_id")
    has = F.col("elected_uxid").isNotNull()
    return joined.withColumns(
        {c: F.when(has, F.col(f"elected_{c}")).otherwise(F.col(c)) for c in ID_COLUMNS}
    ).drop("email_key", *[f"elected_{c}" for c in ID_COLUMNS])


# ---- e-mail-only records -------------------------------------------------

# Fields that must all be blank for a record to be e-mail-only.
NON_EMAIL_FIELDS = [
    "ml_first_name",
    "ml_middle_name",
    "ml_last_name",
    "ml_address_line_1",
    "ml_address_line_2",
    "ml_birth_date",
    "ml_phone",
    "rules_guest_id",
]


def is_email_only(df: DataFrame, email: str = "ml_email_address") -> Column:
    """E-mail present and every other field blank; absent columns count as blank."""
    out = ~is_blank(email)
    for name in NON_EMAIL_FIELDS:
        if name in df.columns:
            out = out & is_blank(name)
    return out


def first_id_per_email(df: DataFrame, email: str = "ml_email_address") -> DataFrame:
    """(email, existing_uxid) by the election order; blank e-mails have none."""
    rows = df.filter(F.col("uxid").isNotNull() & ~is_blank(email)).select(email, *ID_COLUMNS, "batch_record_id")
    return top_per_group(rows, [email], election_order()).select(email, F.col("uxid").alias("existing_uxid"))


def assign_email_only(
    df: DataFrame, context: RunContext, email: str = "ml_email_address"
) -> tuple[DataFrame, DataFrame]:
    """E-mail-only rows without id reuse the e-mail's id or mint one.

    Returns the rows and the audit log.  Only the rows in need take part in the
    join; the rest pass by untouched.
    """
    rows = df.withColumn(email, F.trim(email))
    need = is_email_only(rows, email) & F.col("uxid").isNull()
    asking = rows.filter(need).join(first_id_per_email(rows, email), email, "left")
    solved = asking.withColumns(
        {
            "uxid": F.coalesce("existing_uxid", stable_id(email, "new")),
            "id_res_last_updated_timestamp": context.stamp,
        }
    )
    log = (
        solved.select(
            F.lit(context.job_id).alias("id_res_job_id"),
            F.col(email).alias("email"),
            F.col("uxid").alias("final_uxid"),
            F.when(F.col("existing_uxid").isNotNull(), "REUSED").otherwise("CREATED").alias("action"),
            context.stamp.alias("logged_at_utc"),
        )
    ).distinct()
    result = rows.filter(~need).unionByName(solved.drop("existing_uxid"))
    return result, log


# ---- whole rules and the ordered rule set --------------------------------


def guest_id_rule(df: DataFrame, context: RunContext, email: str = "ml_email_address") -> DataFrame:
    """Mint by guest id, fall back to the e-mail, join ids by guest id, elect."""
    filled = fill_from_email(mint_ids(df, context.stamp), email)
    # Graph and election read only these columns, several times; the wide rows are
    # read once, for the result.
    votes = cut_lineage(
        filled.filter(F.col("candidate_uxid").isNotNull()).select(
            "candidate_uxid", "rules_guest_id", *ID_COLUMNS[1:], "batch_record_id"
        )
    )
    return _take_elected(filled, guest_components(votes), _finalists(votes), strict=True)


def oldest_email_rule(df: DataFrame, context: RunContext, email: str = "ml_email_address") -> DataFrame:
    return elect_email_id(mint_ids(df, context.stamp), email)


def email_only_rule(df: DataFrame, context: RunContext, email: str = "ml_email_address") -> DataFrame:
    if email not in df.columns:
        return df
    return assign_email_only(df, context, email)[0]


PHASES = ("pre_search", "pre_match", "post_match")


@dataclass(frozen=True)
class Rule:
    """A numbered step of one phase; ``apply`` maps rows to rows."""

    number: int
    phase: str
    apply: Callable[[DataFrame, RunContext], DataFrame]


def run_rules(df: DataFrame, rules: Iterable[Rule], phase: str, context: RunContext) -> DataFrame:
    """Apply a phase's rules in number order.

    A rule reads its input more than once, so lineage is cut between rules;
    otherwise the work of the first one would be repeated by each later one.
    """
    if phase not in PHASES:
        raise ValueError(f"unknown phase {phase!r}; expected one of {PHASES}")
    for i, rule in enumerate(sorted((r for r in rules if r.phase == phase), key=lambda r: r.number)):
        df = (cut_lineage(df) if i else df).transform(rule.apply, context)
    return df


DEFAULT_RULES = [
    Rule(150, "post_match", guest_id_rule),
    Rule(170, "post_match", oldest_email_rule),
    Rule(210, "post_match", email_only_rule),
]


def missing_values(df: DataFrame) -> DataFrame:
    """One row counting rows without id, confidence or time, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ID_COLUMNS])
