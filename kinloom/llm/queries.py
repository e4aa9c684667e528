"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, html_text, langid, lines, minhash, quality, repair, token_files, topk, trie, warc
from .common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op9_minhash_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


LINE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
rep AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, rep.key IS NOT NULL AND k.doc_id <> rep.keeper AS lost
  FROM k LEFT JOIN rep ON k.key = rep.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY r"""


@query("op6_line_dedup", LINE_SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_digests(table(spark, folder, "documents"))


LEAK_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ik AS (SELECT item_id, w, least(len(w), 10) AS k FROM iw WHERE len(w) > 0),
iat AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ik),
pat AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS p FROM iat),
ks AS (SELECT DISTINCT k FROM pat),
dat AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k),
found AS (SELECT DISTINCT r, i, dat.k, item_id FROM dat JOIN pat ON pat.k = dat.k
  AND pat.p = array_to_string(list_slice(w, i, i + dat.k - 1), ' ')),
hit AS (SELECT r, count(DISTINCT word_at) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS word_at FROM found) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM
  (SELECT DISTINCT r, cast(item_id AS varchar) AS s FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)"""


@query("op2_decontaminate", LEAK_SQL)
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_digests(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"))


@query("op8_language")
def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op10_quality")
def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


TOP_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id,
  cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])) AS bigint) AS score
  FROM e q, e d WHERE q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM r WHERE rank <= 10"""


@query("op3_maxscore_top_k", TOP_SQL)
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h),
d AS (SELECT p.page_id, p.h, keeper, sha1(p.h) AS x FROM p JOIN g ON p.h = g.h)
SELECT page_id, cast(strlen(h) AS bigint) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + cast((cast('0x' || substr(x, cast(5 * (i // 4) + 1 AS int), 5) AS bigint)
      >> cast(15 - 5 * (i % 4) AS bigint)) & 31 AS int), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM d"""


@query("op4_warc_round_trip", WARC_SQL)
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query("op5_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op1_tool_call_links")
def tool_call_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.link(chat.with_tool_calls(table(spark, folder, "conversations")), chat.SCHEMAS)
    return rows.withColumns({"errors": F.array_join("errors", "; "), "json": F.sha2(F.col("json").cast("binary"), 256)})


@query("op13_token_files")
def token_file_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.digests(token_files.write(table(spark, folder, "documents")))


# Backward over the rows of a conversation: for each state (e nothing, s, u, a) the least
# (cost, audit, repaired turns) from there on.  o* are the edits of one row, b* put up to two
# insertions before them; more than two never pay.
REPAIR_SQL = """
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_concat([cast(4294967295 AS bigint)], range(0, 8 * length(k))), lambda c, i:
  xor((CASE WHEN i % 8 = 0 THEN xor(c, cast(ascii(substr(k, i // 8 + 1, 1)) AS bigint)) ELSE c END) >> 1,
  ((CASE WHEN i % 8 = 0 THEN xor(c, cast(ascii(substr(k, i // 8 + 1, 1)) AS bigint)) ELSE c END) & 1) * 3988292384)),
  4294967295) % 20 AS e FROM base),
hurt AS (SELECT conv_id, turn, CASE e WHEN 4 THEN 'user' ELSE role END AS role,
  CASE e WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE e WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM crc),
num AS (SELECT conv_id, turn, role, text, left(role, 1) AS ini,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tr,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i,
  count(*) OVER (PARTITION BY conv_id) AS n FROM hurt),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM num),
row_ AS (SELECT *, CASE WHEN tr = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN right(tr, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM ord),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM row_ GROUP BY conv_id),
dp AS (
  SELECT conv_id, max(n) + 1 AS i,
    {'c': 0, 'a': '', 'r': cast([] AS varchar[])} AS be, {'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']} AS bs,
    {'c': 2, 'a': 'I', 'r': ['assistant:']} AS bu, {'c': 0, 'a': '', 'r': cast([] AS varchar[])} AS ba
  FROM row_ GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i,
    list_min([oe, {'c': 2 + ou.c, 'a': 'I' || ou.a, 'r': list_prepend('user:', ou.r)},
      {'c': 4 + oa.c, 'a': 'II' || oa.a, 'r': list_concat(['user:', 'assistant:'], oa.r)}]),
    list_min([os, {'c': 2 + ou.c, 'a': 'I' || ou.a, 'r': list_prepend('user:', ou.r)},
      {'c': 4 + oa.c, 'a': 'II' || oa.a, 'r': list_concat(['user:', 'assistant:'], oa.r)}]),
    list_min([ou, {'c': 2 + oa.c, 'a': 'I' || oa.a, 'r': list_prepend('assistant:', oa.r)}]),
    list_min([oa, {'c': 2 + ou.c, 'a': 'I' || ou.a, 'r': list_prepend('user:', ou.r)}])
  FROM (SELECT conv_id, i,
    list_min(list_filter([{'c': 3 + be.c, 'a': 'D' || be.a, 'r': be.r},
      CASE WHEN ok AND ini = 's' THEN {'c': cut + bs.c, 'a': 'K' || bs.a, 'r': list_prepend(line, bs.r)} END,
      CASE WHEN ok AND ini = 'u' THEN {'c': cut + bu.c, 'a': 'K' || bu.a, 'r': list_prepend(line, bu.r)} END,
      CASE WHEN ok THEN {'c': 2 + cut + bu.c, 'a': 'R' || bu.a, 'r': list_prepend('user:' || text, bu.r)} END],
      lambda x: x IS NOT NULL)) AS oe,
    list_min(list_filter([{'c': 3 + bs.c, 'a': 'D' || bs.a, 'r': bs.r},
      CASE WHEN ok AND ini = 'u' THEN {'c': cut + bu.c, 'a': 'K' || bu.a, 'r': list_prepend(line, bu.r)} END,
      CASE WHEN ok THEN {'c': 2 + cut + bu.c, 'a': 'R' || bu.a, 'r': list_prepend('user:' || text, bu.r)} END],
      lambda x: x IS NOT NULL)) AS os,
    list_min(list_filter([{'c': 3 + bu.c, 'a': 'D' || bu.a, 'r': bu.r},
      CASE WHEN ok AND ini = 'a' THEN {'c': cut + ba.c, 'a': 'K' || ba.a, 'r': list_prepend(line, ba.r)} END,
      CASE WHEN ok THEN {'c': 2 + cut + ba.c, 'a': 'R' || ba.a, 'r': list_prepend('assistant:' || text, ba.r)} END],
      lambda x: x IS NOT NULL)) AS ou,
    list_min(list_filter([{'c': 3 + ba.c, 'a': 'D' || ba.a, 'r': ba.r},
      CASE WHEN ok AND ini = 'u' THEN {'c': cut + bu.c, 'a': 'K' || bu.a, 'r': list_prepend(line, bu.r)} END,
      CASE WHEN ok THEN {'c': 2 + cut + bu.c, 'a': 'R' || bu.a, 'r': list_prepend('user:' || text, bu.r)} END],
      lambda x: x IS NOT NULL)) AS oa
    FROM (SELECT dp.conv_id, w.i, be, bs, bu, ba, ini, text, role || ':' || text AS line,
      fault IN ('', 'truncated') AS ok, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS cut
      FROM dp JOIN row_ w ON w.conv_id IS NOT DISTINCT FROM dp.conv_id AND w.i = dp.i - 1))),
done AS (SELECT conv_id, be FROM dp WHERE i = 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cast(coalesce(be.c, 0) AS bigint) AS cost,
  coalesce(be.a, '') AS audit, sha256(coalesce(array_to_string(be.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op11_conversation_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_digests(repair.damaged(table(spark, folder, "conversations")))


TRIE_SQL = """
WITH base AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS s,
  cast(conv_id AS varchar) AS k FROM base GROUP BY conv_id),
crc AS (SELECT *, xor(list_reduce(list_concat([cast(4294967295 AS bigint)], range(0, 8 * length(k))), lambda c, i:
  xor((CASE WHEN i % 8 = 0 THEN xor(c, cast(ascii(substr(k, i // 8 + 1, 1)) AS bigint)) ELSE c END) >> 1,
  ((CASE WHEN i % 8 = 0 THEN xor(c, cast(ascii(substr(k, i // 8 + 1, 1)) AS bigint)) ELSE c END) & 1) * 3988292384)),
  4294967295) % 6 AS h FROM own),
seq AS (SELECT c.conv_id, list_concat(CASE WHEN b.s IS NULL THEN [] ELSE list_slice(b.s, 1, h) END,
  list_slice(c.s, h + 1, len(c.s))) AS q FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
pre AS (SELECT conv_id, q, unnest(range(0, len(q) + 1)) AS d FROM seq),
node AS (SELECT list_slice(q, 1, d) AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
  string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (len(q) = d) AS e FROM pre GROUP BY ALL),
kid AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
told AS (SELECT node.*, coalesce(kid.n, 0) AS n_children, (n_convs - 1) * coalesce(length(node.k[d].x), 0) AS own
  FROM node LEFT JOIN kid ON kid.k = node.k),
sub AS (SELECT list_slice(k, 1, a) AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM told) GROUP BY ALL)
SELECT told.conv_id, told.d AS depth, up.conv_id AS parent_conv_id, told.n_convs, told.n_children, sub.n_leaves,
  cast(sub.saved AS bigint) AS saved_tokens, sha256(coalesce(told.e, '')) AS ends_sha256
FROM told JOIN sub ON sub.k = told.k LEFT JOIN node up ON told.d > 0 AND up.k = list_slice(told.k, 1, told.d - 1)"""


@query("op12_prefix_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, folder, "conversations")))
