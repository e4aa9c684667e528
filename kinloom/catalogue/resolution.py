"""Identity rules: minting, fall-back, components, elections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import lookup_key
from ..operators import graph, rules
from ..operators.groups import attach, election_order, top_per_group
from .registry import AS_OF, Source, query

CONTEXT = rules.RunContext(job_id="20240201000000", as_of=AS_OF)
STAMP = "2024-02-01T00:00:00.000Z"

ORDER = "id_res_last_updated_timestamp ASC NULLS LAST, uxid_confidence DESC NULLS LAST, batch_record_id"

MINTED_CTE = f"""
minted AS (
  SELECT * REPLACE (
    CASE WHEN rules_guest_id IS NOT NULL AND uxid IS NULL THEN md5(concat('new|', rules_guest_id)) ELSE uxid END AS uxid,
    CASE WHEN rules_guest_id IS NOT NULL AND uxid IS NULL THEN 1.0 ELSE uxid_confidence END AS uxid_confidence,
    CASE WHEN rules_guest_id IS NOT NULL AND uxid IS NULL THEN '{STAMP}' ELSE id_res_last_updated_timestamp END AS id_res_last_updated_timestamp)
  FROM ident)
"""

FILLED_CTE = f"""
keyed AS (SELECT *, nullif(lower(trim(ml_email_address)), '') AS email_key FROM minted),
best AS (
  SELECT email_key, uxid AS email_uxid FROM (
    SELECT email_key, uxid, row_number() OVER (PARTITION BY email_key ORDER BY {ORDER}) AS rn
    FROM keyed WHERE email_key IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1),
filled AS (
  SELECT k.*, coalesce(k.uxid, b.email_uxid) AS candidate_uxid
  FROM keyed k LEFT JOIN best b ON k.email_key = b.email_key)
"""

COMPONENT_CTE = """
pairs AS (SELECT DISTINCT rules_guest_id AS g, candidate_uxid AS c FROM filled
          WHERE rules_guest_id IS NOT NULL AND candidate_uxid IS NOT NULL),
links AS (SELECT DISTINCT a.c AS s, b.c AS d FROM pairs a JOIN pairs b ON a.g = b.g),
nodes AS (SELECT DISTINCT candidate_uxid AS id FROM filled WHERE candidate_uxid IS NOT NULL),
reach(id, label) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT links.d, reach.label FROM reach JOIN links ON links.s = reach.id),
components AS (SELECT id, min(label) AS component FROM reach GROUP BY id)
"""

ELECTED_CTE = f"""
placed AS (SELECT f.*, c.component FROM filled f LEFT JOIN components c ON f.candidate_uxid = c.id),
elected AS (
  SELECT component, candidate_uxid AS e_id, uxid_confidence AS e_conf, id_res_last_updated_timestamp AS e_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY component ORDER BY {ORDER}) AS rn
    FROM placed WHERE component IS NOT NULL) WHERE rn = 1),
guest_ruled AS (
  SELECT p.* EXCLUDE (email_key, candidate_uxid, component) REPLACE (
    CASE WHEN e.component IS NULL THEN p.uxid ELSE e_id END AS uxid,
    CASE WHEN e.component IS NULL THEN p.uxid_confidence ELSE e_conf END AS uxid_confidence,
    CASE WHEN e.component IS NULL THEN p.id_res_last_updated_timestamp ELSE e_ts END AS id_res_last_updated_timestamp)
  FROM placed p LEFT JOIN elected e ON p.component = e.component)
"""

GUEST_RULE_CTES = ",".join([MINTED_CTE, FILLED_CTE, COMPONENT_CTE, ELECTED_CTE])


def resolved(source: Source):
    return rules.guest_id_rule(source.ident(), CONTEXT)


@query(
    "id_people",
    ident=True,
    sql=f"""WITH {GUEST_RULE_CTES}
SELECT uxid, count(*) AS records, count(DISTINCT rules_guest_id) AS guest_ids, min(uxid_confidence) AS uxid_confidence
FROM guest_ruled WHERE uxid IS NOT NULL GROUP BY uxid""",
)
def people(source: Source):
    """Flagship: one row per person after the guest-id rule."""
    return (
        resolved(source)
        .filter(F.col("uxid").isNotNull())
        .groupBy("uxid")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.countDistinct("rules_guest_id").alias("guest_ids"),
            F.min("uxid_confidence").alias("uxid_confidence"),
        )
    )


@query(
    "id01_mint",
    ident=True,
    sql=f"""WITH {MINTED_CTE}
SELECT batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp FROM minted""",
)
def mint(source: Source):
    return rules.mint_ids(source.ident(), CONTEXT.stamp).select("batch_record_id", *rules.ID_COLUMNS)


@query(
    "id02_email_fallback",
    ident=True,
    sql=f"""WITH {MINTED_CTE}, {FILLED_CTE}
SELECT batch_record_id, uxid, candidate_uxid FROM filled""",
)
def email_fallback(source: Source):
    minted = rules.mint_ids(source.ident(), CONTEXT.stamp)
    return rules.fill_from_email(minted).select("batch_record_id", "uxid", "candidate_uxid")


@query(
    "gr01_components",
    ident=True,
    sql=f"""WITH {MINTED_CTE}, {FILLED_CTE}, {COMPONENT_CTE}
SELECT id, component FROM components""",
)
def components(source: Source):
    filled = rules.fill_from_email(rules.mint_ids(source.ident(), CONTEXT.stamp))
    return rules.guest_components(filled)


@query(
    "id03_component_election",
    ident=True,
    sql=f"""WITH {GUEST_RULE_CTES}
SELECT batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp FROM guest_ruled""",
)
def component_election(source: Source):
    return resolved(source).select("batch_record_id", *rules.ID_COLUMNS)


EMAIL_RULED = f"""
winners AS (
  SELECT email_key AS w_key, uxid AS e_id, uxid_confidence AS e_conf, id_res_last_updated_timestamp AS e_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY email_key ORDER BY {ORDER}) AS rn
    FROM keyed WHERE email_key IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1)
"""


@query(
    "id04_email_election",
    ident=True,
    sql=f"""WITH {MINTED_CTE},
keyed AS (SELECT *, nullif(lower(trim(ml_email_address)), '') AS email_key FROM minted),
{EMAIL_RULED}
SELECT batch_record_id,
  CASE WHEN w_key IS NULL THEN uxid ELSE e_id END AS uxid,
  CASE WHEN w_key IS NULL THEN uxid_confidence ELSE e_conf END AS uxid_confidence,
  CASE WHEN w_key IS NULL THEN id_res_last_updated_timestamp ELSE e_ts END AS id_res_last_updated_timestamp
FROM keyed LEFT JOIN winners ON email_key = w_key""",
)
def email_election(source: Source):
    return rules.oldest_email_rule(source.ident(), CONTEXT).select("batch_record_id", *rules.ID_COLUMNS)


EMAIL_ONLY_CTES = f"""
trimmed AS (
  SELECT * REPLACE (trim(ml_email_address) AS ml_email_address),
    coalesce(trim(ml_email_address), '') <> '' AND
    coalesce(trim(ml_first_name), '') = '' AND coalesce(trim(ml_middle_name), '') = '' AND
    coalesce(trim(ml_last_name), '') = '' AND coalesce(trim(ml_address_line_1), '') = '' AND
    coalesce(trim(ml_address_line_2), '') = '' AND coalesce(trim(ml_birth_date), '') = '' AND
    coalesce(trim(ml_phone), '') = '' AND coalesce(trim(rules_guest_id), '') = '' AS email_only
  FROM ident),
existing AS (
  SELECT ml_email_address AS x_email, uxid AS existing_uxid FROM (
    SELECT *, row_number() OVER (PARTITION BY ml_email_address ORDER BY {ORDER}) AS rn
    FROM trimmed WHERE uxid IS NOT NULL AND coalesce(ml_email_address, '') <> '') WHERE rn = 1),
asked AS (
  SELECT t.*, existing_uxid, email_only AND uxid IS NULL AS needs
  FROM trimmed t LEFT JOIN existing ON ml_email_address = x_email)
"""


@query(
    "id05_email_only",
    ident=True,
    sql=f"""WITH {EMAIL_ONLY_CTES}
SELECT batch_record_id, ml_email_address,
  CASE WHEN needs THEN coalesce(existing_uxid, md5(concat('new|', ml_email_address))) ELSE uxid END AS uxid,
  CASE WHEN needs THEN '{STAMP}' ELSE id_res_last_updated_timestamp END AS id_res_last_updated_timestamp
FROM asked""",
)
def email_only(source: Source):
    rows, _ = rules.assign_email_only(source.ident(), CONTEXT)
    return rows.select("batch_record_id", "ml_email_address", "uxid", "id_res_last_updated_timestamp")


EMAIL_ONLY_LOG_SQL = f"""WITH {EMAIL_ONLY_CTES}
SELECT DISTINCT '{CONTEXT.job_id}' AS id_res_job_id, ml_email_address AS email,
  coalesce(existing_uxid, md5(concat('new|', ml_email_address))) AS final_uxid,
  CASE WHEN existing_uxid IS NOT NULL THEN 'REUSED' ELSE 'CREATED' END AS action,
  '{STAMP}' AS logged_at_utc
FROM asked WHERE needs"""


@query("id05_email_only_log", ident=True, sql=EMAIL_ONLY_LOG_SQL)
def email_only_log(source: Source):
    return rules.assign_email_only(source.ident(), CONTEXT)[1]


@query(
    "id06_rule_phases",
    ident=True,
    sql=f"""WITH {GUEST_RULE_CTES},
keyed2 AS (SELECT *, nullif(lower(trim(ml_email_address)), '') AS ek FROM guest_ruled),
w2 AS (SELECT ek AS w_key, uxid AS e_id, uxid_confidence AS e_conf, id_res_last_updated_timestamp AS e_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY ek ORDER BY {ORDER}) AS rn FROM keyed2 WHERE ek IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1)
SELECT batch_record_id,
  CASE WHEN w_key IS NULL THEN uxid ELSE e_id END AS uxid,
  CASE WHEN w_key IS NULL THEN uxid_confidence ELSE e_conf END AS uxid_confidence,
  CASE WHEN w_key IS NULL THEN id_res_last_updated_timestamp ELSE e_ts END AS id_res_last_updated_timestamp
FROM keyed2 LEFT JOIN w2 ON ek = w_key""",
)
def rule_phases(source: Source):
    """The default rules, registered out of order, run in number order."""
    shuffled = [rules.DEFAULT_RULES[i] for i in (1, 0)]
    return rules.run_rules(source.ident(), shuffled, "post_match", CONTEXT).select(
        "batch_record_id", *rules.ID_COLUMNS
    )


# ---- windows used by the rules -------------------------------------------


@query(
    "wn01_top_row_per_email",
    ident=True,
    sql=f"""SELECT email_key, batch_record_id, uxid FROM (
  SELECT *, row_number() OVER (PARTITION BY email_key ORDER BY {ORDER}) AS rn FROM (
    SELECT *, nullif(lower(trim(ml_email_address)), '') AS email_key FROM ident)
  WHERE email_key IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1""",
)
def top_row_per_email(source: Source):
    rows = source.ident().select(lookup_key("ml_email_address").alias("email_key"), "batch_record_id", *rules.ID_COLUMNS)
    rows = rows.filter(F.col("email_key").isNotNull() & F.col("uxid").isNotNull())
    return top_per_group(rows, ["email_key"], election_order()).select("email_key", "batch_record_id", "uxid")


@query(
    "wn02_first_value_per_guest",
    ident=True,
    sql=f"""SELECT batch_record_id,
  CASE WHEN rules_guest_id IS NULL THEN uxid ELSE first_value(uxid) OVER w END AS uxid
FROM ident WINDOW w AS (PARTITION BY rules_guest_id ORDER BY {ORDER})""",
)
def first_value_per_guest(source: Source):
    """First row's id for the whole group, without a window over the group."""
    rows = source.ident()
    first = top_per_group(
        rows.filter(F.col("rules_guest_id").isNotNull()).select("rules_guest_id", *rules.ID_COLUMNS, "batch_record_id"),
        ["rules_guest_id"],
        election_order(),
    ).select("rules_guest_id", F.col("uxid").alias("first_uxid"))
    joined = attach(rows.select("batch_record_id", "rules_guest_id", "uxid"), first, "rules_guest_id", "batch_record_id")
    return joined.select(
        "batch_record_id",
        F.when(F.col("rules_guest_id").isNull(), F.col("uxid")).otherwise(F.col("first_uxid")).alias("uxid"),
    )


@query(
    "wn04_group_links",
    ident=True,
    sql="""WITH p AS (SELECT DISTINCT rules_guest_id AS g, uxid FROM ident WHERE rules_guest_id IS NOT NULL AND uxid IS NOT NULL),
m AS (SELECT uxid AS src, min(uxid) OVER (PARTITION BY g) AS dst FROM p)
SELECT DISTINCT src, dst FROM m WHERE src <> dst""",
)
def group_links(source: Source):
    """Links that join a group: each member to the smallest one."""
    return graph.star_edges(source.ident(), "rules_guest_id", "uxid")


@query(
    "jn08_split_groups",
    ident=True,
    sql=f"""WITH {MINTED_CTE}, {FILLED_CTE}, {COMPONENT_CTE}
SELECT f.candidate_uxid, count(DISTINCT c.component) AS n_components
FROM filled f JOIN components c ON f.candidate_uxid = c.id
GROUP BY f.candidate_uxid HAVING count(DISTINCT c.component) > 1""",
)
def split_groups(source: Source):
    filled = rules.fill_from_email(rules.mint_ids(source.ident(), CONTEXT.stamp))
    labels = rules.guest_components(filled).withColumnRenamed("id", "candidate_uxid")
    return graph.split_groups(filled.join(labels, "candidate_uxid"), "candidate_uxid", "component")


@query(
    "jn08_split_guests",
    ident=True,
    sql="""SELECT rules_guest_id, count(DISTINCT uxid) AS n_components FROM ident
WHERE rules_guest_id IS NOT NULL GROUP BY rules_guest_id HAVING count(DISTINCT uxid) > 1""",
)
def split_guests(source: Source):
    """Guest ids whose rows hold several ids: before the rules, so there are some."""
    return graph.split_groups(source.ident(), "rules_guest_id", "uxid")


@query(
    "ag10_missing_values",
    ident=True,
    sql=f"""WITH {GUEST_RULE_CTES}
SELECT count(*) FILTER (WHERE uxid IS NULL) AS null_uxid,
  count(*) FILTER (WHERE uxid_confidence IS NULL) AS null_uxid_confidence,
  count(*) FILTER (WHERE id_res_last_updated_timestamp IS NULL) AS null_id_res_last_updated_timestamp
FROM guest_ruled""",
)
def missing_values(source: Source):
    return rules.missing_values(resolved(source))
