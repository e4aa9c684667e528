"""Connected components that are kept from batch to batch.

Every known vertex has its label, the smallest id of its component, in buckets of the
vertex, and every component its members, in buckets of the component.  A batch of edges
reads the labels of its ends, replaces them by their components and finds the components
of that contracted graph, which has no more vertices than the batch has ends.  Only
components that merge into one of a smaller id are relabelled; their members are read and
written, all other buckets stay as they are.

A component that holds a third of all vertices is many buckets: beyond 2 ** ``PARTS`` buckets
its members part by their own hash, so one that gains a vertex rewrites one of them.  It is
relabelled as a whole only when a smaller id joins it, as the label is the smallest id.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import cut_lineage
from .buckets import MAX_ROWS, BucketStore
from .manifest import Conflict

PARTS = 16


def _by_component(component: str = "component") -> Column:
    return F.xxhash64(component).bitwiseAND(F.lit((1 << PARTS) - 1).cast("long"))


def _by_member() -> Column:
    return F.shiftleft(F.xxhash64("id"), PARTS).bitwiseOR(_by_component())


class Changes(NamedTuple):
    """``labels``: (id, before, component) of every vertex that is new or relabelled."""

    labels: DataFrame
    read: dict[str, list[str]]
    written: dict[str, list[str]]


class ComponentStore(BucketStore):
    """One version of the components; ``add`` commits the next one."""

    @classmethod
    def create(cls, spark: SparkSession, folder: str, id_type: str = "string", max_rows: int = MAX_ROWS) -> ComponentStore:
        """Version 0: no vertices."""
        none = spark.createDataFrame([], f"id {id_type}, component {id_type}")
        tables = {"labels": (none, F.xxhash64("id")), "members": (none, _by_member())}
        return cls.first(spark, folder, tables, max_rows)

    def labels(self) -> DataFrame:
        """(id, component) of all vertices."""
        return self.whole("labels")

    def add(self, vertices: DataFrame, edges: DataFrame, batch_id: str) -> Changes:
        """Takes in vertices (id) and edges (src, dst); the ends of edges are vertices too.

        Null ids and edges with a null end are left out.  Raises ``Conflict`` when another
        job committed this version first.
        """
        links = cut_lineage(edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL").distinct())
        ends = vertices.select("id").union(links.select("src")).union(links.select("dst")).filter("id IS NOT NULL").distinct()
        ends = cut_lineage(ends.withColumn("h", F.xxhash64("id")))
        read: dict[str, list[str]] = {}
        known = self.read("labels", self.note("labels", ends, "h", read)).join(ends, "id", "left_semi")
        mapped = ends.select("id").join(known, "id", "left").withColumn("new", F.col("component").isNull())
        mapped = cut_lineage(mapped.withColumn("root", F.coalesce("component", "id")).select("id", "root", "new"))
        roots = mapped.select("id", "root")
        short = links.join(roots.toDF("src", "a"), "src").join(roots.toDF("dst", "b"), "dst")
        short = short.filter("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
        joined = cut_lineage(connected_components(mapped.select(F.col("root").alias("id")).distinct(), short).toDF("root", "component"))
        moved = joined.filter("root <> component").join(mapped.filter("NOT new").select("root"), "root", "left_semi")
        moved = cut_lineage(moved.withColumn("h", _by_component("root")))
        found = self.tables["members"].names(moved, "h", PARTS)
        read["members"] = found
        gone = self.read("members", found).withColumnRenamed("component", "root").join(moved.drop("h"), "root")
        fresh = mapped.filter("new").join(joined, "root").select("id", F.lit(None).cast(mapped.schema["id"].dataType).alias("before"), "component")
        labels = gone.select("id", F.col("root").alias("before"), "component").unionByName(fresh)
        labels = cut_lineage(labels)
        tables, written = {}, {}
        if not labels.isEmpty():
            after = labels.select("id", "component")
            touched = self.tables["labels"].names(after.select(F.xxhash64("id").alias("h")), "h")
            rest = self.read("labels", touched).join(after, "id", "left_anti")
            tables["labels"], written["labels"] = self.rewritten("labels", touched, rest, after, F.xxhash64("id"))
            touched = sorted({*found, *self.tables["members"].names(after.select(_by_member().alias("h")), "h")})
            rest = self.read("members", touched).join(moved.select(F.col("root").alias("component")), "component", "left_anti")
            tables["members"], written["members"] = self.rewritten("members", touched, rest, after, _by_member())
        self.commit(tables, batch_id)
        return Changes(labels, read, written)


def add_edges(
    spark: SparkSession, folder: str, vertices: DataFrame, edges: DataFrame, batch_id: str, attempts: int = 5
) -> Changes | None:
    """``add`` to the latest version, again when another job was faster; None for a batch taken before."""
    for attempt in range(attempts):
        store = ComponentStore.latest(spark, folder)
        if store.applied(batch_id):
            return None
        try:
            return store.add(vertices, edges, batch_id)
        except Conflict:
            if attempt + 1 == attempts:
                raise
    return None
