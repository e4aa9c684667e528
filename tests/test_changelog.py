"""Deltas over buckets: equal to a rewritten table before and after compaction, and as small as the change."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from kinloom.plans.changelog import LoggedTable
from kinloom.plans.manifest import Conflict

SCHEMA = "a long, b string, v string, n int"


def model(df):
    return {(r.a, r.b): (r.v, r.n) for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)


def test_random_changes_equal_a_dictionary(spark, tmp_path):
    draw = random.Random(2)
    key = lambda: (draw.choice([*range(12), None]), draw.choice(["x", "y"]))
    expected = {key(): (f"v{i}", i) for i in range(20)}
    folder = str(tmp_path / "t")
    LoggedTable.create(frame(spark, expected), ["a", "b"], folder, max_rows=4)
    history = [dict(expected)]
    for step in range(5):
        table = LoggedTable.latest(spark, folder)
        if step == 3:
            table.compact("compacted", least=2)
        else:
            new = {key(): (draw.choice([None, "w"]), step) for _ in range(6)}
            gone = {key() for _ in range(3)} - {k for k in expected if k[0] is None}
            gone = {k for k in gone if k[0] is not None}
            deletes = spark.createDataFrame(sorted(gone), "a long, b string") if step != 1 else None
            table.change(frame(spark, new), deletes, f"c{step}")
            expected = {k: v for k, v in expected.items() if step == 1 or k not in gone} | new
        history.append(dict(expected))
        assert model(LoggedTable.latest(spark, folder).rows()) == expected
    for version, rows in enumerate(history):
        assert model(LoggedTable(spark, folder, version).rows()) == rows
    LoggedTable.latest(spark, folder).roll_back(2, "back")
    latest = LoggedTable.latest(spark, folder)
    assert latest.version == 6 and model(latest.rows()) == history[2]
    latest.compact("all")
    assert model(LoggedTable.latest(spark, folder).rows()) == history[2] and not LoggedTable.latest(spark, folder).deltas
    with pytest.raises(Conflict):
        latest.change(frame(spark, {(1, "x"): ("late", 0)}), None, "late")


def test_a_small_change_writes_only_deltas(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(20_000).select(F.col("id").alias("a"), F.lit("k").alias("b"), F.col("id").cast("string").alias("v"), F.lit(1).alias("n"))
    table = LoggedTable.create(rows, ["a", "b"], folder, max_rows=500)
    files = set(glob.glob(f"{folder}/data/**/*.parquet", recursive=True))
    some = rows.filter("a % 1000 = 7").withColumn("v", F.lit(None).cast("string"))
    touched = table.change(some, None, "nulls")
    assert len(touched) <= 20 < len(table.tables["base"].buckets)
    assert set(glob.glob(f"{folder}/data/**/*.parquet", recursive=True)) == files
    latest = LoggedTable.latest(spark, folder)
    assert latest.rows().filter("v IS NULL").count() == 20 and latest.rows().count() == 20_000
    assert model(latest.lookup(some.limit(3))) == model(some.limit(3))
    written = latest.compact("compact")
    assert sorted(written) == touched
    done = LoggedTable.latest(spark, folder)
    assert done.rows().exceptAll(latest.rows()).isEmpty() and done.rows().count() == 20_000


def test_buckets_split_when_compacted_and_empty_changes(spark, tmp_path):
    folder = str(tmp_path / "t")
    empty = spark.createDataFrame([], SCHEMA)
    table = LoggedTable.create(empty, ["a", "b"], folder, max_rows=10)
    assert table.rows().isEmpty() and table.compact("nothing") == [] and table.change(empty, None, "none") == []
    many = spark.range(200).select(F.col("id").alias("a"), F.lit("k").alias("b"), F.lit("v").alias("v"), F.lit(1).alias("n"))
    LoggedTable.latest(spark, folder).change(many, None, "many")
    LoggedTable.latest(spark, folder).compact("split")
    done = LoggedTable.latest(spark, folder)
    assert len(done.tables["base"].buckets) >= 16 and done.rows().count() == 200


def test_a_small_change_of_a_large_table_is_one_folder(spark, tmp_path):
    """Its rows lie in very many buckets; folders follow the rows."""
    rows = spark.range(200_000).selectExpr("id AS k", "'old' AS v")
    table = LoggedTable.create(rows, ["k"], str(tmp_path), max_rows=100)
    touched = table.change(rows.filter("k % 1000 = 7").selectExpr("k", "'new' AS v"), rows.filter("k % 1000 = 8"), "one")
    assert len(touched) > 100
    assert len(list(tmp_path.glob("delta/*/_part=*"))) == 1
    after = LoggedTable.latest(spark, str(tmp_path)).rows().groupBy("v").count().collect()
    assert dict(after) == {"old": 199_600, "new": 200}
