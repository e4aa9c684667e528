"""Streams equal their batch forms, over several files and after a failure."""

import pytest
from pyspark.sql import functions as F

from kinloom.catalogue import identity
from kinloom.operators import logs, rules
from kinloom.operators.batches import READY
from kinloom.plans.incremental import read_store, resolving_handler, run_incremental, update_store, write_store
from kinloom.plans.resolve import resolve_batch
from kinloom.streaming import loop, observe, requests, timers

CONTEXT = rules.RunContext("job", "2024-02-01T00:00:00Z")


@pytest.fixture(scope="module")
def ident(spark, sf_dir):
    return identity.ident(spark.read.parquet(f"{sf_dir}/events.parquet"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_loop_resumes_after_a_failure(spark, ident, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    ident.repartition(4, "batch_record_id").write.parquet(source)
    stream = loop.file_stream(spark, source, ident.schema, max_files=1)
    write = loop.write_batches(out)

    def failing(df, number):
        if number == 2:
            raise RuntimeError("third batch fails")
        write(df.select("batch_record_id", "uxid"), number)

    with pytest.raises(Exception, match="third batch fails"):
        loop.run_available(stream, failing, progress)
    loop.run_available(stream, lambda df, n: write(df.select("batch_record_id", "uxid"), n), progress)
    done = spark.read.parquet(out)
    assert done.select("batch").distinct().count() == 4
    assert rows(done.drop("batch")) == rows(ident.select("batch_record_id", "uxid"))


def test_incremental_resolution_versions_the_store(spark, ident, tmp_path):
    store_folder, exports, source = (str(tmp_path / n) for n in ("store", "export", "in"))
    write_store(identity.store(ident), store_folder)
    batch = identity.batch(ident)
    batch.coalesce(1).write.parquet(source)
    handler = resolving_handler(spark, store_folder, exports, CONTEXT)
    loop.run_available(loop.file_stream(spark, source, batch.schema), handler, str(tmp_path / "progress"))
    expected = resolve_batch(batch, identity.store(ident), CONTEXT)
    got = read_store(spark, store_folder, 1)
    names = ["source_name", "source_customer_id", "uxid"]
    assert rows(got.select(names)) == rows(expected.store.select(names))
    handler(batch, 0)  # a retry adds nothing
    assert rows(read_store(spark, store_folder, 1).select(names)) == rows(expected.store.select(names))
    ready = spark.read.json(f"{exports}-ready").collect()
    assert [r["record_count"] for r in ready] == [expected.export.count()]


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, ident, tmp_path):
    folder = tmp_path / "store"
    store = identity.store(ident)
    write_store(store, str(folder), buckets=16)
    files = lambda: {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("data/**/part-*")}
    before = files()
    one = store.limit(1).select("source_name", "source_customer_id", "batch_record_id")
    new = store.join(one.withColumn("hit", F.lit(True)), ["source_name", "source_customer_id", "batch_record_id"], "left")
    new = new.withColumn("uxid", F.when(F.col("hit"), "new").otherwise(F.col("uxid"))).drop("hit")
    for _ in range(2):  # the retry writes the same
        assert len(update_store(new, one, str(folder), 0, buckets=16)) == 1
        assert rows(read_store(spark, str(folder), 1).select(*new.columns)) == rows(new)
        assert {p: t for p, t in files().items() if p in before} == before
        assert len({p.parent for p in files()} - {p.parent for p in before}) == 1
    assert rows(read_store(spark, str(folder), 0).select(*store.columns)) == rows(store)


def test_loop_over_a_manifest_marks_complete_and_failed(spark, ident, tmp_path):
    batch = identity.batch(ident).withColumn("part", F.col("batch_record_id") % 4)
    files = [(f"f{i}", READY, 10, None) for i in range(4)]
    manifest = spark.createDataFrame(files, "file_name string, status string, row_count long, ttl long")
    write, seen = loop.write_batches(str(tmp_path / "out")), []

    def handle(df, number):
        seen.append(number)
        if df.filter("part = 2").count():
            raise RuntimeError("bad file")
        write(df.select("batch_record_id"), number)

    read = lambda chosen: batch.filter(F.concat(F.lit("f"), F.col("part").cast("string")).isin(list(chosen)))
    done = run_incremental(spark, manifest, read, handle, CONTEXT.as_of, max_items=1)
    assert [r.status for r in done.orderBy("file_name").collect()] == ["complete", "complete", "failed", "complete"]
    assert done.filter("ttl IS NULL").count() == 0 and seen == [0, 1, 2, 2]
    out = spark.read.parquet(str(tmp_path / "out")).select("batch_record_id")
    assert rows(out) == rows(batch.filter("part <> 2").select("batch_record_id"))


def test_alarm_stream_over_many_files(spark, tmp_path):
    alarm = logs.Alarm("a", "max", ">", 5, m=2, n=3, period="60 seconds", missing_breaches=True)
    minutes = [(0, 9.0), (1, 1.0), (2, 7.0), (5, 1.0), (6, 1.0), (9, 8.0), (10, 1.0)]
    start = 1_700_000_040  # a full minute
    periods = spark.createDataFrame([(k, start + 60 * m, v) for k in ("x", "y") for m, v in minutes], "k string, s long, value double")
    periods = periods.select(F.timestamp_seconds("s").alias("period"), "k", "value")
    folder = str(tmp_path / "p")
    for i in range(0, 11, 4):
        part = periods.filter(F.unix_timestamp("period").between(start + 60 * i, start + 60 * (i + 3)))
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = loop.file_stream(spark, folder, periods.schema, max_files=1)
    out = str(tmp_path / "o")
    loop.run_available(observe.alarm_stream(stream, alarm, "k"), loop.write_batches(out), str(tmp_path / "c"))
    got = spark.read.parquet(out).select("k", "period", "breaches", "state")
    raw = periods.withColumnRenamed("period", "ts")
    batch = logs.alarm_states(raw, alarm, "value", "k").select("k", "period", "breaches", "state")
    assert rows(got) == rows(batch)


def test_every_alarm_definition_runs(spark):
    df = spark.range(50).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 200).alias("ts"), F.lit("q").alias("k"), (F.col("id") * 3.0).alias("v")
    )
    for alarm in logs.ALARMS:
        states = logs.alarm_states(df, alarm, "v", "k")
        assert states.filter("state = 'ALARM'").count() > 0


def test_late_periods_change_nothing_and_long_gaps_are_filled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(observe, "PIECE", 7)
    alarm = logs.Alarm("a", "max", ">", 5, m=2, n=3, period="60 seconds", missing_breaches=False)
    start = 1_700_000_040
    folder = tmp_path / "p"
    for i, minutes in enumerate([[(0, 9.0), (1, 9.0)], [(1, 0.0), (0, 0.0), (40, 9.0)], [(39, 9.0), (41, 9.0), (41, 9.0)]]):
        part = spark.createDataFrame([("x", start + 60 * t, v) for t, v in minutes], "k string, s long, value double")
        part = part.select(F.timestamp_seconds("s").alias("period"), "k", "value")
        part.coalesce(1).write.parquet(str(folder / f"{i}"))
    stream = loop.file_stream(spark, str(folder / "*"), part.schema, max_files=1)
    loop.run_available(observe.alarm_stream(stream, alarm, "k"), loop.write_batches(str(tmp_path / "o")), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "o")).select(((F.unix_timestamp("period") - start) / 60).cast("int"), "breaches", "state")
    want = {0: 1, 1: 2, 2: 2, 3: 1, 40: 1, 41: 2}
    assert rows(got) == sorted(((t, want.get(t, 0), "ALARM" if want.get(t, 0) >= 2 else "OK") for t in range(42)), key=str)


def silent_brute_force(events, alarm, dead_after, watermark, step):
    """States of (key, second, value) events by walking every key's periods."""
    values = {}
    for key, at, value in events:
        values.setdefault(key, {}).setdefault(at // step * step, []).append(value)
    out = []
    for key, found in values.items():
        last, flags, at = None, [], min(found)
        while at + step <= watermark:
            if at in found:
                if last is not None and at - last > dead_after * step:
                    flags = []
                last = at
            if at - last <= dead_after * step:
                flags = [*flags, max(found[at]) > alarm.threshold if at in found else alarm.missing_breaches][-alarm.n :]
                out.append((key, at, sum(flags), "ALARM" if sum(flags) >= alarm.m else "OK"))
            at += step
    return sorted(out)


@pytest.mark.parametrize("files", [1, 6])
def test_silent_keys_alarm_by_timer(spark, tmp_path, files):
    """A key that falls silent alarms and is forgotten, whether its events come at once or file by file."""
    step, hour = 600, 3600
    alarm = logs.Alarm("quiet", "max", ">", 5, m=2, n=3, period="600 seconds", missing_breaches=True)
    events = [("busy", t, 1.0) for t in range(0, 12 * hour, 300)]
    events += [("silent", t, 1.0) for t in range(0, hour, 200)] + [("back", t, 9.0) for t in (0, 700, 5 * hour, 5 * hour + 650)]
    events += [("pause", t, 1.0) for t in (0, 3 * step, 7 * step + 1)]
    for number in range(files):
        part = [e for e in events if e[1] * files // (12 * hour) == number]
        frame = spark.createDataFrame(part, "k string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = loop.file_stream(spark, str(tmp_path / "in"), frame.schema, max_files=1)
    with loop.settings(spark, {"spark.sql.streaming.stateStore.providerClass": timers.PROVIDER}):
        states = timers.silent_alarms(stream, alarm, "value", "k", dead_after=4, lateness="0 seconds")
        query = loop.run_available(states, loop.write_batches(str(tmp_path / "out")), str(tmp_path / "progress"))
    got = spark.read.parquet(str(tmp_path / "out")).select("k", F.unix_timestamp("period"), "breaches", "state").collect()
    assert sorted(map(tuple, got)) == silent_brute_force(events, alarm, 4, max(e[1] for e in events), step)
    quiet = [r for r in sorted(map(tuple, got)) if r[0] == "silent"]
    assert quiet[-1][1] == hour - step + 4 * step and quiet[-1][3] == "ALARM"
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 3  # the states of dead keys are gone


EPOCH = 1_000_000  # a stream takes times up to its first watermark, 1970, for late


def test_requests_wait_for_their_results(spark, tmp_path):
    """Results in time, late, too late, early, repeated, unknown and missing, over several files."""
    asked = [("a", 0), ("b", 0), ("c", 10), ("d", 20), ("e", 30), (None, 40), ("f", 100_000)]
    answered = [("a", 300), ("b", 301), ("c", 700), ("d", 5), ("e", 60), ("e", 400), ("ghost", 50), (None, 60), ("z", 100_001)]
    for name, rows, at in (("q", asked, "asked_at"), ("r", answered, "answered_at")):
        frame = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds(F.col("s") + EPOCH).alias(at))
        for part in (frame.filter(F.unix_timestamp(at) < EPOCH + 350), frame.filter(F.unix_timestamp(at) >= EPOCH + 350)):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    left, right = (loop.file_stream(spark, str(tmp_path / n), f"k string, {c} timestamp", max_files=1) for n, c in (("q", "asked_at"), ("r", "answered_at")))
    joined = requests.with_results(left, right, "k", grace="600 seconds", lateness="0 seconds")
    query = loop.run_available(joined, loop.write_batches(str(tmp_path / "out")), str(tmp_path / "progress"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got) == sorted([("a", 300, "answered"), ("b", 301, "late"), ("c", None, "unanswered"), ("d", None, "unanswered"), ("e", 60, "answered"), ("e", 400, "late"), (None, None, "unanswered")], key=str)
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 2  # what can still meet, and nothing older
    found = requests.control(got.withColumn("batch", F.lit("x")), "batch").first()
    assert (found.answered, found.late, found.unanswered, found.STATUS) == (2, 2, 3, "INCOMPLETE")


def rows_of(joined):
    return sorted(((r.k, r.s, r.status) for r in joined.select("k", (F.unix_timestamp("answered_at") - EPOCH).alias("s"), "status").collect()), key=str)
