"""Shape of the physical plans: what must hold at any data size."""

import pytest

import __spark_entry__ as entry
from kinloom.catalogue import QUERIES, identity
from kinloom.functions.text import lookup_key
from kinloom.operators import rules

# Streams and the loop run while the frame is built; nothing of them is left in the plan.  Queries on the
# indexed store and on kept components end in the operators of their namesakes.
NAMES = sorted(n for n in QUERIES if not any(word in n for word in ("stream", "loop", "indexed", "batched")))
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", NAMES)
def test_no_pair_products_and_no_python(name, spark, sf_dir):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in FORBIDDEN:
        assert operator not in plan, plan


def test_elections_limit_groups_before_the_shuffle(spark, sf_dir):
    df = identity.ident(spark.read.parquet(f"{sf_dir}/events.parquet"))
    best = rules.best_id_per_email(df, lookup_key("ml_email_address"))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit"), "one limit must lie below the shuffle"


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = entry.queries()["jn12_hit_flags"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
