"""Components kept across batches against one full run and against union-find."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kinloom.catalogue import growing
from kinloom.catalogue.registry import Source
from kinloom.operators.graph import connected_components
from kinloom.plans import components
from kinloom.plans.components import ComponentStore, add_edges


def union_find(vertices, edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in vertices:
        root(v)
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {v: root(v) for v in parent}


@pytest.mark.parametrize("parts", [16, 0])
def test_batch_after_batch_equals_one_run(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(components, "PARTS", parts)
    draw = random.Random(7)
    folder = str(tmp_path / "c")
    ComponentStore.create(spark, folder, "long", max_rows=6)
    vertices, edges, told = [], [], {}
    for number in range(4):
        some = [(draw.randrange(60, 100),) for _ in range(3)] + [(None,)]
        pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(14)] + [(1, None), (None, 2), (5, 5)]
        vertices += [v for (v,) in some if v is not None]
        edges += [(a, b) for a, b in pairs if a is not None and b is not None]
        changes = add_edges(spark, folder, spark.createDataFrame(some, "id long"), spark.createDataFrame(pairs, "src long, dst long"), f"b{number}")
        for r in changes.labels.collect():
            assert told.get(r.id) == r.before
            told[r.id] = r.component
        expected = union_find(vertices, edges)
        assert told == expected
        labels = {r.id: r.component for r in ComponentStore.latest(spark, folder).labels().collect()}
        assert labels == expected
        members = ComponentStore.latest(spark, folder).whole("members")
        assert sorted((r.id, r.component) for r in members.collect()) == sorted(expected.items())
    whole = connected_components(spark.createDataFrame([(v,) for v in expected], "id long"), spark.createDataFrame(edges, "src long, dst long"))
    assert {r.id: r.component for r in whole.collect()} == expected
    assert ComponentStore(spark, folder, 1).labels().count() < len(expected)
    assert add_edges(spark, folder, spark.range(1), spark.createDataFrame([], "src long, dst long"), "b2") is None


def test_untouched_components_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "c")
    ComponentStore.create(spark, folder, "long", max_rows=8)
    pairs = spark.range(400).select((F.col("id") * 5).alias("src"), (F.col("id") * 5 + 1).alias("dst"))
    add_edges(spark, folder, spark.range(0), pairs, "all")
    store = ComponentStore.latest(spark, folder)
    assert len(store.tables["labels"].buckets) >= 64
    changes = add_edges(spark, folder, spark.range(0), spark.createDataFrame([(6, 11), (2000, 1996)], "src long, dst long"), "few")
    assert {tuple(r) for r in changes.labels.collect()} == {(10, 10, 5), (11, 10, 5), (2000, None, 1995)}
    assert len(changes.read["labels"]) <= 4 and len(changes.read["members"]) == 1
    assert len(changes.written["labels"]) <= 6 and len(changes.written["members"]) <= 6
    after, before = (ComponentStore(spark, folder, v).tables["labels"].buckets for v in (2, 1))
    assert sum(after[n].path != b.path for n, b in before.items() if n in after) <= 3


def test_a_giant_component_is_many_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(components, "PARTS", 2)
    folder = str(tmp_path / "c")
    ComponentStore.create(spark, folder, "long", max_rows=50)
    add_edges(spark, folder, spark.range(0), spark.range(1, 1000).select("id", F.lit(0).cast("long")).toDF("src", "dst"), "star")
    store = ComponentStore.latest(spark, folder)
    assert sum(b.rows > 0 for b in store.tables["members"].buckets.values()) >= 8
    changes = add_edges(spark, folder, spark.range(0), spark.createDataFrame([(2000, 500)], "src long, dst long"), "one")
    assert changes.labels.collect() == [(2000, None, 0)] and len(changes.written["members"]) <= 4
    assert ComponentStore.latest(spark, folder).labels().filter("component <> 0").isEmpty()


def test_the_links_of_the_rule_are_computed_once(spark, monkeypatch):
    """Vertices and links come from one pass over the events."""
    scans, cut = [], growing.cut_lineage

    def counted(df):
        scans.append("FileScan parquet" in df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(growing, "cut_lineage", counted)
    assert growing.batched_components(Source(spark, "/root/testdata/sf0.001")).count()
    assert sum(scans) == 1
