"""Exact, similarity and entity matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import similarity_text
from ..operators import match
from ..plans import resolve
from ..session import cut_lineage
from .registry import Source, query
from .resolution import CONTEXT, GUEST_RULE_CTES, ORDER, STAMP
from .scalars import SIMILARITY_SQL

FEATURES = [
    "ml_first_name",
    "ml_middle_name",
    "ml_last_name",
    "ml_birth_date",
    "ml_address_line_1",
    "ml_address_line_2",
    "ml_postal_code",
    "ml_phone",
    "ml_email_address",
    "rules_guest_id",
]
_VALUES = [f"coalesce(lower(trim({c})), '')" for c in FEATURES]
DIGEST_SQL = f"CASE WHEN length(concat({', '.join(_VALUES)})) > 0 THEN md5(concat_ws('|', {', '.join(_VALUES)})) END"

EXACT_CTES = f"""
d_batch AS (SELECT *, {DIGEST_SQL} AS digest,
  row_number() OVER (PARTITION BY source_name, source_customer_id
    ORDER BY record_last_updated_timestamp DESC NULLS LAST, batch_record_id DESC) AS newness FROM batch),
d_store AS (SELECT *, {DIGEST_SQL} AS digest FROM store),
twins AS (SELECT digest, uxid, uxid_confidence, id_res_last_updated_timestamp FROM (
  SELECT digest, uxid, uxid_confidence, id_res_last_updated_timestamp, row_number() OVER (PARTITION BY digest
    ORDER BY record_last_updated_timestamp, source_name, source_customer_id) AS rn
  FROM d_store WHERE digest IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1),
matched AS (
  SELECT b.*,
    CASE WHEN s.source_name IS NOT NULL AND b.digest IS NOT DISTINCT FROM s.digest THEN 1
         WHEN s.source_name IS NOT NULL THEN 2 WHEN t.digest IS NOT NULL THEN 3 ELSE 4 END AS processing_scenario,
    CASE WHEN (b.newness > 1 AND b.source_name IS NOT NULL AND b.source_customer_id IS NOT NULL) OR coalesce(b.record_last_updated_timestamp < s.record_last_updated_timestamp, false)
         THEN 'Y' ELSE 'N' END AS delete_flag,
    CASE WHEN s.source_name IS NOT NULL THEN s.uxid ELSE t.uxid END AS known_uxid,
    CASE WHEN s.source_name IS NOT NULL THEN s.uxid_confidence ELSE t.uxid_confidence END AS known_confidence,
    CASE WHEN s.source_name IS NOT NULL THEN s.id_res_last_updated_timestamp ELSE t.id_res_last_updated_timestamp END AS known_time
  FROM d_batch b
  LEFT JOIN d_store s ON b.source_name = s.source_name AND b.source_customer_id = s.source_customer_id
  LEFT JOIN twins t ON s.source_name IS NULL AND b.digest = t.digest)
"""


# The batch with incomplete keys: such rows repeat nothing and are known to no store.
PART_KEYED_CTES = """part_keyed AS (SELECT * REPLACE (
  CASE WHEN batch_record_id % 10 = 7 THEN NULL ELSE source_customer_id END AS source_customer_id,
  CASE WHEN batch_record_id % 10 = 3 THEN NULL ELSE source_name END AS source_name) FROM batch),"""
PART_EXACT_CTES = PART_KEYED_CTES + EXACT_CTES.replace("FROM batch)", "FROM part_keyed)")


def part_keyed(batch):
    last = F.col("batch_record_id") % 10
    return batch.withColumns(
        {"source_customer_id": F.when(last != 7, F.col("source_customer_id")), "source_name": F.when(last != 3, F.col("source_name"))}
    )


@query(
    "ex01_exact_match",
    ident=True,
    sql=f"WITH {PART_EXACT_CTES} SELECT batch_record_id, processing_scenario, delete_flag, known_uxid FROM matched",
)
def exact_match(source: Source):
    return match.exact_match(part_keyed(source.batch()), source.store()).select(
        "batch_record_id", "processing_scenario", "delete_flag", "known_uxid"
    )


@query(
    "ex02_routes",
    ident=True,
    sql=f"""WITH {PART_EXACT_CTES}
SELECT route, batch_record_id, uxid FROM (
  SELECT 'reject' AS route, batch_record_id, uxid FROM matched WHERE delete_flag = 'Y'
  UNION ALL SELECT CASE processing_scenario WHEN 1 THEN 'touch' WHEN 3 THEN 'insert' ELSE 'match' END, batch_record_id,
    CASE WHEN processing_scenario IN (1, 3) THEN known_uxid ELSE uxid END FROM matched WHERE delete_flag = 'N')""",
)
def routes(source: Source):
    routed = match.route_exact(match.exact_match(part_keyed(source.batch()), source.store()))
    parts = [
        routed[name].select(F.lit(name).alias("route"), "batch_record_id", "uxid")
        for name in ("touch", "insert", "match", "reject")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def with_text(df):
    return df.withColumn("all_sim", similarity_text(df))


@query("sm01_texts", ident=True, sql=f"SELECT {SIMILARITY_SQL} AS all_sim, min(batch_record_id) AS head FROM store GROUP BY 1")
def texts(source: Source):
    return with_text(source.store()).groupBy("all_sim").agg(F.min("batch_record_id").alias("head"))


SIMILAR_CTES = f"""
bt AS (SELECT batch_record_id AS r, {SIMILARITY_SQL} AS text FROM batch WHERE trim({SIMILARITY_SQL}) <> ''),
st AS (SELECT batch_record_id AS r, {SIMILARITY_SQL} AS text FROM store WHERE trim({SIMILARITY_SQL}) <> ''),
bw AS (SELECT text, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM (SELECT DISTINCT text FROM bt)),
sw AS (SELECT text, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM (SELECT DISTINCT text FROM st)),
scored AS (SELECT bw.text AS b, sw.text AS s, len(list_intersect(bw.w, sw.w)) AS n, len(bw.w) + len(sw.w) AS t
  FROM bw, sw WHERE 3 * len(bw.w) <= 10 * len(sw.w) AND 3 * len(sw.w) <= 10 * len(bw.w)),
best_texts AS (SELECT b, s, round(n / (t - n), 6) AS score FROM scored WHERE 10 * n >= 3 * (t - n)),
ranked AS (SELECT bt.r AS batch_record_id, st.r AS similar_record_id, score,
  row_number() OVER (PARTITION BY bt.r ORDER BY score DESC, st.r) AS rn
  FROM best_texts JOIN bt ON bt.text = b JOIN st ON st.text = s)
"""


@query(
    "sm02_similar_topk",
    ident=True,
    sql=f"WITH {SIMILAR_CTES} SELECT batch_record_id, similar_record_id, score FROM ranked WHERE rn <= 5",
)
def similar_topk(source: Source):
    return match.similar_topk(with_text(source.batch()), with_text(source.store()))


@query(
    "so03_best_similar",
    ident=True,
    sql=f"WITH {SIMILAR_CTES} SELECT batch_record_id, similar_record_id, score FROM ranked WHERE rn = 1",
)
def best_similar(source: Source):
    return match.similar_topk(with_text(source.batch()), with_text(source.store()), k=1)


EXTENDED_SQL = """SELECT * FROM store WHERE
  nullif(lower(trim(ml_email_address)), '') IN (SELECT nullif(lower(trim(ml_email_address)), '') FROM batch WHERE ml_email_address IS NOT NULL)
  OR rules_guest_id IN (SELECT rules_guest_id FROM batch WHERE rules_guest_id IS NOT NULL)
  OR uxid IN (SELECT uxid FROM batch WHERE uxid IS NOT NULL)"""


SIMILAR_IDS_SQL = """
  OR uxid IN (SELECT uxid FROM store WHERE uxid IS NOT NULL AND batch_record_id IN (SELECT similar_record_id FROM ranked WHERE rn <= 5))"""


@query(
    "sm03_extended_lookup",
    ident=True,
    sql=f"WITH {SIMILAR_CTES} SELECT batch_record_id, uxid, ml_email_address FROM ({EXTENDED_SQL} {SIMILAR_IDS_SQL})",
)
def extended_lookup(source: Source):
    similar = match.similar_topk(with_text(source.batch()), with_text(source.store()))
    found = match.extended_lookup(source.batch(), source.store(), similar=similar)
    return found.select("batch_record_id", "uxid", "ml_email_address")


def _key_sql(number: int, rule: match.MatchRule) -> str:
    fixed = [e for e in rule.evidence if e != "name~"]
    stem = ", ".join([f"'{number}'", *fixed])
    there = " AND ".join(f"{e} IS NOT NULL" for e in [*fixed, *(["name"] if "name~" in rule.evidence else [])])
    if "name~" not in rule.evidence:
        return f"SELECT r, {rule.confidence} AS c, concat_ws('~', {stem}) AS k FROM parts WHERE {there}"
    forms = (
        "unnest(list_distinct(list_concat([name], list_transform(range(1, length(name) + 1), "
        "lambda i: concat(substr(name, 1, i - 1), substr(name, i + 1))))))"
    )
    return f"SELECT r, {rule.confidence} AS c, concat_ws('~', {stem}, form) AS k FROM (SELECT *, {forms} AS form FROM parts WHERE {there})"


def entity_ctes(table: str) -> str:
    """Entity matching of ``table`` as CTEs ending in ``entities(r, match_id, confidence)``."""

    def part(*names: str) -> str:
        keys = [f"nullif(lower(trim({n})), '')" for n in names]
        return f"CASE WHEN {' AND '.join(f'{k} IS NOT NULL' for k in keys)} THEN concat_ws(' ', {', '.join(keys)}) END"

    offers = " UNION ALL ".join(_key_sql(i, r) for i, r in enumerate(match.MATCH_RULES))
    return f"""
parts AS (SELECT batch_record_id AS r, {part('ml_first_name', 'ml_last_name')} AS name,
  {part('ml_address_line_1', 'ml_postal_code')} AS address, {part('ml_postal_code')} AS postcode,
  {part('ml_birth_date')} AS birth, {part('ml_email_address')} AS email,
  nullif(regexp_replace(ml_phone, '\\D', '', 'g'), '') AS phone FROM {table}),
offers AS (SELECT r, max(c) AS c, k FROM ({offers}) GROUP BY r, k),
meets AS (SELECT r, c, min(r) OVER (PARTITION BY k) AS first, count(*) OVER (PARTITION BY k) AS n FROM offers),
mlinks AS (SELECT DISTINCT r AS s, first AS d FROM meets WHERE n > 1 AND r <> first),
mboth AS (SELECT s, d FROM mlinks UNION SELECT d, s FROM mlinks),
mreach(id, label) AS (SELECT DISTINCT r, r FROM meets WHERE n > 1 UNION SELECT mboth.d, mreach.label FROM mreach JOIN mboth ON mboth.s = mreach.id),
mlabel AS (SELECT id, min(label) AS match_id FROM mreach GROUP BY id),
mbest AS (SELECT r, max(c) AS confidence FROM meets WHERE n > 1 GROUP BY r),
entities AS (SELECT mbest.r, match_id, confidence FROM mbest JOIN mlabel ON mbest.r = mlabel.id)
"""


@query(
    "er01_entities",
    ident=True,
    sql=f"""WITH {entity_ctes('ident')}
SELECT batch_record_id, match_id AS "MatchID", confidence::double AS "ConfidenceLevel" FROM ident LEFT JOIN entities ON batch_record_id = r""",
)
def entities(source: Source):
    return match.match_entities(source.ident()).select("batch_record_id", "MatchID", "ConfidenceLevel")


@query(
    "er02_skipped_rows",
    ident=True,
    sql=f"""WITH live AS (SELECT * FROM ident WHERE source_name <> 'SRC_POS'), {entity_ctes('live')}
SELECT batch_record_id, source_name = 'SRC_POS' AS skip_ml, match_id AS "MatchID", confidence::double AS "ConfidenceLevel"
FROM ident LEFT JOIN entities ON batch_record_id = r""",
)
def skipped_rows(source: Source):
    rows = source.ident().withColumn("skip_ml", F.col("source_name") == "SRC_POS")
    return match.match_unless_skipped(rows).select("batch_record_id", "skip_ml", "MatchID", "ConfidenceLevel")


@query(
    "er03_with_originals",
    ident=True,
    sql="""SELECT source_name, source_customer_id, ml_email_address AS original_ml_email_address,
  lower(trim(ml_email_address)) AS ml_email_address FROM store""",
)
def with_originals(source: Source):
    store = source.store().select("source_name", "source_customer_id", "ml_email_address")
    normal = store.withColumn("ml_email_address", F.lower(F.trim("ml_email_address")))
    return match.with_originals(store, normal)


# ---- the whole chain -----------------------------------------------------

CLEAN = "* REPLACE (" + ", ".join(
    f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" for c in FEATURES
) + ")"

# Candidates: similar stored rows, rows with their ids, and rows sharing an e-mail, guest id or id.
CANDIDATE_CTES = (
    SIMILAR_CTES.replace("FROM batch WHERE", "FROM to_match WHERE")
    + f""",
pool AS (SELECT * FROM ({EXTENDED_SQL.replace("FROM batch", "FROM to_match")} {SIMILAR_IDS_SQL})
  UNION SELECT * FROM store WHERE batch_record_id IN (SELECT similar_record_id FROM ranked WHERE rn <= 5))
"""
)

RESOLVE_CTES = f"""
raw_batch AS (SELECT * FROM batch),
clean_batch AS (SELECT {CLEAN} FROM raw_batch),
{EXACT_CTES.replace("FROM batch)", "FROM clean_batch)")},
to_match AS (SELECT * EXCLUDE (digest, newness, processing_scenario, delete_flag, known_uxid, known_confidence, known_time)
    REPLACE (CASE WHEN processing_scenario = 2 THEN coalesce(uxid, known_uxid) ELSE uxid END AS uxid),
    CASE WHEN processing_scenario = 2 THEN known_uxid END AS old_id
  FROM matched WHERE delete_flag = 'N' AND processing_scenario IN (2, 4)),
{CANDIDATE_CTES},
together AS (SELECT *, true AS own FROM to_match UNION ALL SELECT *, uxid, false FROM pool),
{entity_ctes('together')},
with_match AS (SELECT t.*, match_id, confidence FROM together t LEFT JOIN entities ON batch_record_id = r),
group_ids AS (SELECT match_id AS g, uxid AS g_uxid FROM (
  SELECT match_id, uxid, row_number() OVER (PARTITION BY match_id ORDER BY {ORDER}) AS rn
  FROM with_match WHERE match_id IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1),
assigned AS (SELECT w.* REPLACE (
    CASE WHEN uxid IS NULL AND match_id IS NOT NULL THEN coalesce(g_uxid, md5(concat('match|', cast(match_id AS varchar)))) ELSE uxid END AS uxid,
    CASE WHEN uxid IS NULL AND match_id IS NOT NULL THEN confidence ELSE uxid_confidence END AS uxid_confidence,
    CASE WHEN uxid IS NULL AND match_id IS NOT NULL THEN '{STAMP}' ELSE id_res_last_updated_timestamp END AS id_res_last_updated_timestamp)
  FROM with_match w LEFT JOIN group_ids ON match_id = g),
{GUEST_RULE_CTES.replace("FROM ident)", "FROM assigned)")},
email_keyed AS (SELECT *, nullif(lower(trim(ml_email_address)), '') AS ek FROM guest_ruled),
email_best AS (SELECT ek AS w_key, uxid AS w_id, uxid_confidence AS w_conf, id_res_last_updated_timestamp AS w_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY ek ORDER BY {ORDER}) AS rn FROM email_keyed WHERE ek IS NOT NULL AND uxid IS NOT NULL) WHERE rn = 1),
email_ruled AS (SELECT k.* REPLACE (coalesce(w_id, uxid) AS uxid,
    CASE WHEN w_key IS NULL THEN uxid_confidence ELSE w_conf END AS uxid_confidence,
    CASE WHEN w_key IS NULL THEN id_res_last_updated_timestamp ELSE w_ts END AS id_res_last_updated_timestamp)
  FROM email_keyed k LEFT JOIN email_best ON ek = w_key),
lone AS (SELECT *, uxid IS NULL AND concat(coalesce(ml_first_name, ''), coalesce(ml_middle_name, ''),
    coalesce(ml_last_name, ''), coalesce(ml_address_line_1, ''), coalesce(ml_address_line_2, ''), coalesce(ml_birth_date, ''),
    coalesce(ml_phone, ''), coalesce(rules_guest_id, '')) = '' AND ml_email_address IS NOT NULL AS only_email FROM email_ruled),
settled AS (SELECT batch_record_id, source_name, source_customer_id, own, old_id, uxid_confidence, record_last_updated_timestamp,
    CASE WHEN only_email THEN md5(concat('new|', trim(ml_email_address))) ELSE uxid END AS uxid,
    CASE WHEN only_email THEN '{STAMP}' ELSE id_res_last_updated_timestamp END AS id_res_last_updated_timestamp FROM lone),
export AS (SELECT batch_record_id, uxid, uxid_confidence FROM settled WHERE own
  UNION ALL SELECT batch_record_id, known_uxid, known_confidence FROM matched WHERE delete_flag = 'N' AND processing_scenario IN (1, 3))
"""


def resolution_of(source: Source):
    return resolve.resolve_batch(source.batch(), cut_lineage(source.store()), CONTEXT)  # a view read many times


@query("id07_resolve_batch", ident=True, sql=f"WITH {RESOLVE_CTES} SELECT batch_record_id, uxid, uxid_confidence FROM export")
def resolve_batch(source: Source):
    return resolution_of(source).export.select("batch_record_id", "uxid", "uxid_confidence")


@query(
    "id08_store_after_batch",
    ident=True,
    sql=f"""WITH {RESOLVE_CTES},
written AS (SELECT source_name, source_customer_id, batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp,
    record_last_updated_timestamp, 'incremental_full_pipeline' AS how, CASE WHEN old_id <> uxid THEN old_id END AS past
  FROM settled WHERE own AND uxid IS NOT NULL
  UNION ALL SELECT source_name, source_customer_id, batch_record_id, known_uxid, known_confidence, known_time,
    record_last_updated_timestamp, 'incremental_exact_s3', NULL FROM matched WHERE delete_flag = 'N' AND processing_scenario = 3),
touched AS (SELECT source_name, source_customer_id, record_last_updated_timestamp AS seen FROM matched
  WHERE delete_flag = 'N' AND processing_scenario = 1),
moved AS (SELECT source_name, source_customer_id, uxid AS m_id, uxid_confidence AS m_conf, id_res_last_updated_timestamp AS m_time,
    CASE WHEN old_id <> uxid THEN old_id END AS m_past FROM settled WHERE NOT own AND uxid IS NOT NULL),
kept AS (SELECT s.source_name, s.source_customer_id, s.batch_record_id,
    CASE WHEN m_id IS NULL THEN s.uxid ELSE m_id END AS uxid,
    CASE WHEN m_id IS NULL THEN s.uxid_confidence ELSE m_conf END AS uxid_confidence,
    CASE WHEN m_id IS NULL THEN s.id_res_last_updated_timestamp ELSE m_time END AS id_res_last_updated_timestamp,
    CASE WHEN t.source_name IS NULL THEN s.record_last_updated_timestamp ELSE t.seen END AS record_last_updated_timestamp,
    CASE WHEN m_id IS NOT NULL THEN 'incremental_full_pipeline' WHEN t.source_name IS NOT NULL THEN 'incremental_exact_s1' END AS how,
    m_past AS past
  FROM store s LEFT JOIN moved m ON s.source_name = m.source_name AND s.source_customer_id = m.source_customer_id
  LEFT JOIN touched t ON s.source_name = t.source_name AND s.source_customer_id = t.source_customer_id
  WHERE NOT EXISTS (SELECT 1 FROM written w WHERE w.source_name = s.source_name AND w.source_customer_id = s.source_customer_id))
SELECT source_name, source_customer_id, batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp,
  record_last_updated_timestamp, CASE WHEN how IS NOT NULL THEN '{CONTEXT.job_id}' END AS updated_by_incremental_batch_id,
  how AS updated_by_incremental_batch_description, past AS past_uxid, CASE WHEN past IS NULL THEN 0 ELSE 1 END AS n_past
FROM (SELECT * FROM written UNION ALL SELECT * FROM kept)""",
)
def store_after_batch(source: Source):
    """Every row of the store after the batch: id, confidence, time, stamps and history."""
    return stored_columns(resolution_of(source).store)


def stored_columns(store):
    past = F.coalesce("past_uxids", F.array().cast("array<struct<uxid:string,uxid_confidence:double,uxid_last_changed_timestamp:string>>"))
    return store.select(
        "source_name",
        "source_customer_id",
        "batch_record_id",
        "uxid",
        "uxid_confidence",
        "id_res_last_updated_timestamp",
        "record_last_updated_timestamp",
        "updated_by_incremental_batch_id",
        "updated_by_incremental_batch_description",
        F.get(past, F.lit(0))["uxid"].alias("past_uxid"),
        F.size(past).alias("n_past"),
    )


@query(
    "er04_match_ids",
    ident=True,
    sql=f"""WITH {RESOLVE_CTES} SELECT batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp FROM assigned WHERE own""",
)
def match_ids(source: Source):
    """Ids taken from match groups, before the rules."""
    found = resolve.match_batch(source.batch(), cut_lineage(source.store()), CONTEXT)
    return found.rows.filter("_own").select(
        "batch_record_id", "uxid", "uxid_confidence", "id_res_last_updated_timestamp"
    )
