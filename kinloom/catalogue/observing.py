"""Logs, metrics, alarms and the streaming jobs.

Log lines are written from the events: one line per event, its kind giving the
kind of line.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logs, rules
from ..session import new_folder
from ..streaming import loop, observe, requests, timers
from . import identity
from .registry import Source, query
from .resolution import CONTEXT, MINTED_CTE

JOB_SQL = "concat('20240101000000_', CASE WHEN user_id % 2 = 0 THEN 'exact' ELSE 'similar' END, '_search_u', cast(user_id AS varchar))"
NUMBER_SQL = "cast(json_extract_string(props, '$.k') AS bigint)"
FIELDS_SQL = f"""SELECT event_id, ts, CASE WHEN event_type <> 'signup' THEN {JOB_SQL} END AS job_id,
  CASE WHEN event_type <> 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'exact' ELSE 'similar' END END AS job_type,
  CASE WHEN event_type IN ('error', 'click') THEN {NUMBER_SQL} END AS retry_count,
  CASE WHEN event_type = 'purchase' THEN ({NUMBER_SQL} + 0.5)::double END AS retry_delay,
  CASE WHEN event_type IN ('view', 'click') THEN {NUMBER_SQL} END AS done,
  CASE WHEN event_type IN ('view', 'click') THEN 100 END::bigint AS total FROM events"""


def log_lines(source: Source, events=None):
    events = source.table("events") if events is None else events
    k = F.get_json_object("props", "$.k")
    kind = F.when(F.col("user_id") % 2 == 0, "exact").otherwise("similar")
    job = F.concat(F.lit("20240101000000_"), kind, F.lit("_search_u"), F.col("user_id").cast("string"))
    retry = F.concat(F.lit("opensearch_client_error_retry_count is #"), k)
    done = F.concat(F.lit("msearch: done "), k, F.lit(" of 100"))
    message = (
        F.when(F.col("event_type") == "error", F.concat_ws(" ", job, retry))
        .when(F.col("event_type") == "click", F.concat_ws(" ", job, done, retry))
        .when(F.col("event_type") == "view", F.concat_ws(" ", job, done))
        .when(
            F.col("event_type") == "purchase",
            F.concat_ws(" ", job, F.concat(F.lit("next opensearch_client_retry#0 in "), k, F.lit(".5 seconds"))),
        )
        .otherwise(F.concat(F.lit("started "), F.col("user_id").cast("string")))
    )
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", message.alias("message"))


@query("lg01_log_fields", sql=f"SELECT * EXCLUDE (ts) FROM ({FIELDS_SQL})")
def log_fields(source: Source):
    return logs.extract_fields(log_lines(source)).drop("ts", "message", "user_id")


@query(
    "lg02_retry_summary",
    sql=f"""SELECT job_id, job_type, max(retry_count) AS max_retry_count,
  arg_max(retry_delay, (ts, retry_delay)) FILTER (WHERE retry_delay IS NOT NULL) AS retry_delay_secs
FROM ({FIELDS_SQL}) WHERE job_id IS NOT NULL GROUP BY job_id, job_type""",
)
def retry_summary(source: Source):
    return logs.retry_summary(logs.extract_fields(log_lines(source)).filter("job_id IS NOT NULL"))


BINS_SQL = f"""SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS bin, job_id, max(done) AS last_done,
  max(total) AS total, max(retry_count) AS max_retry_count FROM ({FIELDS_SQL}) WHERE done IS NOT NULL GROUP BY ALL"""


def as_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query("lg03_minute_bins", sql=BINS_SQL)
def minute_bins(source: Source):
    bins = logs.minute_bins(logs.extract_fields(log_lines(source)).filter("done IS NOT NULL"))
    return bins.select(as_text("bin"), "job_id", "last_done", "total", "max_retry_count")


@query(
    "lg03_minute_bins_stream",
    sql=f"""SELECT b.* FROM ({BINS_SQL}) b, (SELECT max(ts) AS top FROM ({FIELDS_SQL}) WHERE done IS NOT NULL) t
WHERE strptime(bin, '%Y-%m-%d %H:%M:%S') + INTERVAL 1 MINUTE <= top - INTERVAL 10 MINUTE""",
)
def minute_bins_stream(source: Source):
    """The same bins from a stream, as far as the watermark has closed them."""
    folder = new_folder(source.spark, "bins")
    events = loop.file_stream(source.spark, source.folder, source.table("events").schema, pattern="events.parquet")
    fields = logs.extract_fields(log_lines(source, events)).filter("done IS NOT NULL")
    loop.run_available(observe.closed_bins(fields), loop.write_batches(f"{folder}/out"), f"{folder}/progress")
    bins = source.spark.read.parquet(f"{folder}/out").drop("batch")
    return bins.select(as_text("bin"), "job_id", "last_done", "total", "max_retry_count")


@query(
    "lg04_span_durations",
    sql="""SELECT user_id, date_diff('millisecond', date_trunc('millisecond', min(ts)), date_trunc('millisecond', max(ts))) AS duration_ms,
  round(date_diff('millisecond', date_trunc('millisecond', min(ts)), date_trunc('millisecond', max(ts))) / 3600000, 6) AS duration_hours
FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY user_id""",
)
def span_durations(source: Source):
    spans = logs.span_durations(log_lines(source), ["^started", "next opensearch_client_retry"], by=["user_id"])
    return spans.select("user_id", "duration_ms", F.round(F.col("duration_ms") / 3_600_000, 6).alias("duration_hours"))


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


@query(
    "lg05_period_average",
    sql="""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS period, event_type,
  round(sum(cast(value AS decimal(18,2)))::double / count(value) * 100, 3) AS value FROM events GROUP BY ALL""",
)
def period_average(source: Source):
    events = source.table("events").select("event_type", "ts", money("value").cast("decimal(28,12)").alias("value"))
    stat = logs.period_statistic(events, "value", "1 hour", ["event_type"], "avg", "percent", digits=3)
    return stat.select(as_text("period"), "event_type", "value")


@query(
    "lg05_period_sum",
    sql="""SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS period, event_type,
  round(sum(cast(value AS decimal(18,2)))::double / 1000, 6) AS value FROM events GROUP BY ALL""",
)
def period_sum(source: Source):
    events = source.table("events").select("event_type", "ts", money("value").alias("value"))
    stat = logs.period_statistic(events, "value", "1 day", ["event_type"], "sum", "seconds")
    return stat.select(as_text("period"), "event_type", "value")


# Busy enough to alarm on the driver data: the largest value per half hour.
PEAK = logs.Alarm("peak value", "max", ">", 30, m=2, n=4, period="1800 seconds", missing_breaches=True)


def alarm_sql(alarm: logs.Alarm, only: str = "true") -> str:
    """States over the periods that satisfy ``only`` (a test on their start ``p``)."""
    seconds = alarm.period.split()[0]
    return f"""WITH s AS (SELECT * FROM (SELECT time_bucket(INTERVAL {seconds} SECOND, ts) AS p, event_type AS k, max(value) AS v FROM events GROUP BY ALL) WHERE {only}),
g AS (SELECT k, unnest(generate_series(min(p), max(p), INTERVAL {seconds} SECOND)) AS p FROM s GROUP BY k),
f AS (SELECT g.k, g.p, coalesce(v {alarm.comparison} {alarm.threshold}, {str(alarm.missing_breaches).lower()}) AS b FROM g LEFT JOIN s ON g.k = s.k AND g.p = s.p),
w AS (SELECT k, p, sum(b::int) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN {alarm.n - 1} PRECEDING AND CURRENT ROW)::int AS breaches FROM f)
SELECT k AS event_type, strftime(p, '%Y-%m-%d %H:%M:%S') AS period, breaches, CASE WHEN breaches >= {alarm.m} THEN 'ALARM' ELSE 'OK' END AS state FROM w"""


@query("lg06_alarm_states", sql=alarm_sql(PEAK))
def alarm_states(source: Source):
    states = logs.alarm_states(source.table("events").select("event_type", "ts", "value"), PEAK, "value", "event_type")
    return states.select("event_type", as_text("period"), "breaches", "state")


CLOSED = "p + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


# A stream knows the periods the watermark has closed; gaps behind the last one
# of a key are filled once another one arrives.
@query("lg06_alarm_stream", sql=alarm_sql(PEAK, CLOSED))
def alarm_stream(source: Source):
    """Two streams: closed periods into a table, then states from that table."""
    folder = new_folder(source.spark, "alarm")
    events = loop.file_stream(source.spark, source.folder, source.table("events").schema, pattern="events.parquet")
    rows = events.select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    periods = observe.closed_periods(rows, PEAK, "value", "event_type")
    loop.run_available(periods, loop.write_batches(f"{folder}/periods"), f"{folder}/progress-1")
    closed = loop.file_stream(source.spark, f"{folder}/periods/*", periods.schema)
    states = observe.alarm_stream(closed, PEAK, "event_type")
    loop.run_available(states, loop.write_batches(f"{folder}/states"), f"{folder}/progress-2")
    out = source.spark.read.parquet(f"{folder}/states").drop("batch")
    return out.select("event_type", as_text("period"), "breaches", "state")


# Users come and go: six hours without any event breach, two days of them end a user's watch.
SILENCE = logs.Alarm("silence", "max", ">", 95, m=3, n=4, period="21600 seconds", missing_breaches=True)
DEAD_AFTER = 8

SILENCE_SQL = f"""WITH over_ AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events),
s AS (SELECT * FROM (SELECT time_bucket(INTERVAL 21600 SECOND, ts) AS p, user_id AS k, max(value) AS v FROM events GROUP BY ALL)
  WHERE p + INTERVAL 21600 SECOND <= (SELECT wm FROM over_)),
b AS (SELECT *, CASE WHEN lag(p) OVER (PARTITION BY k ORDER BY p) + {DEAD_AFTER} * INTERVAL 21600 SECOND < p THEN 1 ELSE 0 END AS anew FROM s),
i AS (SELECT *, sum(anew) OVER (PARTITION BY k ORDER BY p) AS life FROM b),
l AS (SELECT k, life, min(p) AS lo, least(max(p) + {DEAD_AFTER} * INTERVAL 21600 SECOND,
  time_bucket(INTERVAL 21600 SECOND, (SELECT wm FROM over_) - INTERVAL 21600 SECOND)) AS hi FROM i GROUP BY ALL),
g AS (SELECT k, life, unnest(generate_series(lo, hi, INTERVAL 21600 SECOND)) AS p FROM l),
f AS (SELECT g.*, coalesce(v > {SILENCE.threshold}, true) AS breach FROM g LEFT JOIN s ON s.k = g.k AND s.p = g.p),
w AS (SELECT k, p, sum(breach::int) OVER (PARTITION BY k, life ORDER BY p ROWS BETWEEN {SILENCE.n - 1} PRECEDING AND CURRENT ROW)::int AS breaches FROM f)
SELECT k AS user_id, strftime(p, '%Y-%m-%d %H:%M:%S') AS period, breaches, CASE WHEN breaches >= {SILENCE.m} THEN 'ALARM' ELSE 'OK' END AS state FROM w"""


@query("lg06_silent_keys_stream", sql=SILENCE_SQL)
def silent_keys(source: Source):
    """Alarms of users by timer, also for those of whom nothing comes any more."""
    folder = new_folder(source.spark, "silence")
    events = loop.file_stream(source.spark, source.folder, source.table("events").schema, pattern="events.parquet")
    rows = events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    with loop.settings(source.spark, {"spark.sql.streaming.stateStore.providerClass": timers.PROVIDER}):
        states = timers.silent_alarms(rows, SILENCE, "value", "user_id", DEAD_AFTER)
        loop.run_available(states, loop.write_batches(f"{folder}/states"), f"{folder}/progress")
    out = source.spark.read.parquet(f"{folder}/states").drop("batch")
    return out.select("user_id", as_text("period"), "breaches", "state")


# Clicks are requests; three in four get a result, 0 to 900 seconds later.
REQUESTED_SQL = """WITH q AS (SELECT event_id, ts AS asked FROM events WHERE event_type = 'click'),
r AS (SELECT event_id, ts + to_seconds(event_id % 10 * 100) AS answered FROM events WHERE event_type = 'click' AND event_id % 4 <> 0),
w AS (SELECT least((SELECT max(asked) FROM q), (SELECT max(answered) FROM r)) - INTERVAL 10 MINUTE AS wm),
j AS (SELECT q.event_id, asked, answered FROM q LEFT JOIN r ON r.event_id = q.event_id AND answered <= asked + INTERVAL 600 SECOND),
s AS (SELECT strftime(asked, '%Y-%m-%d') AS batch_id,
  CASE WHEN answered IS NULL THEN 'unanswered' WHEN answered <= asked + INTERVAL 300 SECOND THEN 'answered' ELSE 'late' END AS status
  FROM j WHERE answered IS NOT NULL OR asked + INTERVAL 600 SECOND < (SELECT wm FROM w))
SELECT batch_id, count(*) FILTER (status = 'answered') AS answered, count(*) FILTER (status = 'late') AS late,
  count(*) FILTER (status = 'unanswered') AS unanswered,
  CASE WHEN count(*) FILTER (status = 'unanswered') = 0 THEN 'DONE' ELSE 'INCOMPLETE' END AS "STATUS" FROM s GROUP BY 1"""


@query("en02_requested_stream", sql=REQUESTED_SQL)
def requested_stream(source: Source):
    """Requests and results as streams that meet; one control row per day of requests."""
    folder = new_folder(source.spark, "requests")

    def clicks():
        schema = source.table("events").schema
        events = loop.file_stream(source.spark, source.folder, schema, pattern="events.parquet").filter("event_type = 'click'")
        return events.select("event_id", F.col("ts").cast("timestamp").alias("asked_at"))

    delay = F.make_dt_interval(secs=(F.col("event_id") % 10 * 100).cast("decimal(18,6)"))
    results = clicks().filter("event_id % 4 <> 0").select("event_id", (F.col("asked_at") + delay).alias("answered_at"))
    joined = requests.with_results(clicks(), results, "event_id", grace="600 seconds")
    loop.run_available(joined, loop.write_batches(f"{folder}/rows"), f"{folder}/progress")
    rows = source.spark.read.parquet(f"{folder}/rows").withColumn("batch_id", F.date_format("asked_at", "yyyy-MM-dd"))
    return requests.control(rows, "batch_id")


@query(
    "mb01_incremental_stream",
    ident=True,
    sql=f"""WITH {MINTED_CTE}
SELECT batch_record_id, uxid, uxid_confidence, id_res_last_updated_timestamp FROM minted""",
)
def incremental_stream(source: Source):
    """Micro-batches of event files, minted and written; equal to the batch run."""
    folder = new_folder(source.spark, "incremental")
    events = loop.file_stream(source.spark, source.folder, source.table("events").schema, pattern="events.parquet")
    write = loop.write_batches(f"{folder}/out")

    def handle(batch, number):
        write(rules.mint_ids(identity.ident(batch), CONTEXT.stamp).select("batch_record_id", *rules.ID_COLUMNS), number)

    loop.run_available(events, handle, f"{folder}/progress")
    return source.spark.read.parquet(f"{folder}/out").drop("batch")
