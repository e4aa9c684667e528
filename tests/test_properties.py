"""Random inputs against brute force, and invariants."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinloom.catalogue import identity
from kinloom.operators import graph, match, rules
from kinloom.plans.resolve import match_batch, resolve_batch


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(120)]
    edges = [tuple(rng.sample(nodes, 2)) for _ in range(70)]
    edges += [(nodes[i], nodes[i + 1]) for i in range(0, 25)]  # a chain
    edges += [(nodes[60], n) for n in nodes[61:90]]  # a hub
    edges += [(nodes[5], nodes[5])]
    got = graph.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "src string, dst string")
    )
    assert {r["id"]: r["component"] for r in got.collect()} == roots(nodes, edges)


def test_components_without_edges(spark):
    vertices = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    edges = spark.createDataFrame([], "src string, dst string")
    assert {tuple(r) for r in graph.connected_components(vertices, edges).collect()} == {("a", "a"), ("b", "b")}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75])
def test_similar_texts_equal_brute_force(spark, threshold):
    rng = random.Random(7)
    words = ["the"] * 12 + ["st"] * 6 + [f"w{i}" for i in range(14)]

    def texts(n, start):
        return [(start + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))) for i in range(n)]

    batch, stored = texts(60, 0), texts(70, 1000)
    stored += [(2000, batch[0][1]), (2001, "  "), (2002, batch[0][1])]
    got = match.similar_topk(
        spark.createDataFrame(batch, "batch_record_id long, all_sim string"),
        spark.createDataFrame(stored, "batch_record_id long, all_sim string"),
        k=4,
        threshold=threshold,
    )

    def records(rows):
        return [(i, set(t.split())) for i, t in rows if t.strip()]

    expected = set()
    for i, x in records(batch):
        scored = [(-round(len(x & y) / len(x | y), 6), j) for j, y in records(stored) if len(x & y) / len(x | y) >= threshold - 1e-9]
        expected |= {(i, j, -s) for s, j in sorted(scored)[:4]}
    assert {tuple(r) for r in got.collect()} == expected


def near(a, b):
    forms = [{s} | {s[:i] + s[i + 1 :] for i in range(len(s))} for s in (a, b)]
    return bool(forms[0] & forms[1])


def test_entities_equal_brute_force(spark):
    rng = random.Random(3)
    names = ["ann lee", "ann le", "bob ray", "rob ray", "anne lee"]
    rows = []
    for i in range(90):
        first, last = rng.choice(names).split()
        pick = lambda *v: rng.choice([*v, None])
        rows.append((i, first, last, pick("1990-01-01", "1991-02-02"), pick("1 Main", "2 Oak"), pick("10001", "10002"),
                     pick("555-1", "555-2", "555-3", "555-4"), pick("a@x.y", "b@x.y", "c@x.y", "d@x.y")))
    schema = ("batch_record_id long, ml_first_name string, ml_last_name string, ml_birth_date string, "
              "ml_address_line_1 string, ml_postal_code string, ml_phone string, ml_email_address string")

    def value(r, e):
        part = {
            "name": [r[1], r[2]], "name~": [r[1], r[2]], "birth": [r[3]], "address": [r[4], r[5]],
            "postcode": [r[5]], "phone": [r[6].replace("-", "") if r[6] else None], "email": [r[7]],
        }[e]
        return None if any(p is None for p in part) else " ".join(part).lower()

    def agrees(a, b, rule):
        for e in rule.evidence:
            x, y = value(a, e), value(b, e)
            if x is None or y is None or not (near(x, y) if e == "name~" else x == y):
                return False
        return True

    edges, best = [], {}
    for a, b in itertools.combinations(rows, 2):
        for rule in match.MATCH_RULES:
            if agrees(a, b, rule):
                edges.append((a[0], b[0]))
                for r in (a, b):
                    best[r[0]] = max(best.get(r[0], 0), rule.confidence)
    label = roots([r[0] for r in rows], edges)
    expected = {r[0]: (label[r[0]], best[r[0]]) if r[0] in best else (None, None) for r in rows}
    got = match.match_entities(spark.createDataFrame(rows, schema)).collect()
    assert {r["batch_record_id"]: (r["MatchID"], r["ConfidenceLevel"]) for r in got} == expected


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


CONTEXT = rules.RunContext("job", "2024-02-01T00:00:00Z")


def ids_of(df):
    return {r["batch_record_id"]: r["uxid"] for r in df.select("batch_record_id", "uxid").collect()}


def test_rules_ignore_row_order_and_settle(spark, events):
    ident = identity.ident(events)
    once = rules.guest_id_rule(ident, CONTEXT)
    shuffled = rules.guest_id_rule(ident.repartition(5, "ml_phone").sortWithinPartitions(F.desc("batch_record_id")), CONTEXT)
    assert ids_of(once) == ids_of(shuffled)
    assert ids_of(rules.guest_id_rule(once, CONTEXT)) == ids_of(once)


def test_a_hot_key_changes_nothing_else(spark, events):
    """A third of all rows get one guest id and one e-mail."""
    hot = F.col("batch_record_id") % 3 == 1
    ident = identity.ident(events).withColumns(
        {
            "rules_guest_id": F.when(hot, F.lit("hot")).otherwise(F.col("rules_guest_id")),
            "ml_email_address": F.when(hot, F.lit("none@none.zz")).otherwise(F.col("ml_email_address")),
        }
    )
    out = rules.guest_id_rule(ident, CONTEXT)
    assert out.count() == ident.count()
    assert out.filter(hot).select("uxid").distinct().count() == 1
    assert graph.split_groups(out.withColumn("c", F.col("uxid")), "rules_guest_id", "c").count() == 0


def test_resolving_a_batch_again_changes_no_id(spark, events):
    ident = identity.ident(events)
    batch = identity.batch(ident)
    first = resolve_batch(batch, identity.store(ident), CONTEXT)
    again = resolve_batch(batch, first.store, CONTEXT)
    # What was stored is now known and unchanged; only rows left without id stay new.
    new = again.export.filter("processing_scenario <> 1").select("batch_record_id")
    assert new.join(first.export.filter("uxid IS NOT NULL"), "batch_record_id", "left_semi").count() == 0
    assert again.store.count() == first.store.count()
    repeated = first.store.groupBy("source_name", "source_customer_id").count().filter("count > 1")
    assert repeated.count() == 0
    assert first.export.count() + first.rejects.count() == batch.count()
    before, after = ids_of(first.export), ids_of(again.export)
    assert all(after[i] == before[i] for i in before if before[i] is not None)


def test_export_keeps_unresolved_rows(spark, events):
    ident = identity.ident(events)
    result = resolve_batch(identity.batch(ident), identity.store(ident), CONTEXT)
    missing = result.export.filter("uxid IS NULL").count()
    # Stored candidates carry the stamp as well; of the batch's keys all but those without id do.
    stamped = result.store.filter("updated_by_incremental_batch_id = 'job'")
    written = stamped.join(result.export, ["source_name", "source_customer_id"], "left_semi").count()
    assert written == result.export.count() - missing


def test_a_batch_leaves_one_id_per_email_in_the_store(spark, sf_dir):
    ident = identity.ident(spark.read.parquet(f"{sf_dir}/events.parquet"))
    result = resolve_batch(identity.batch(ident), identity.store(ident), CONTEXT)
    email = F.lower(F.trim("ml_email_address")).alias("email")
    met = result.export.filter("processing_scenario IN (2, 4) AND uxid IS NOT NULL").select(email).distinct()
    adopted = result.export.filter("processing_scenario = 3").select("source_name", "source_customer_id")
    rows = result.store.join(adopted, ["source_name", "source_customer_id"], "left_anti")
    spans = rows.filter("uxid IS NOT NULL").select(email, "uxid").join(met, "email").groupBy("email").agg(F.countDistinct("uxid").alias("n"))
    assert spans.count() > 0 and spans.filter("n > 1").count() == 0


def test_rows_without_full_key_are_never_superseded(spark, sf_dir):
    ident = identity.ident(spark.read.parquet(f"{sf_dir}/events.parquet"))
    batch = identity.batch(ident).withColumn("source_customer_id", F.lit(None).cast("string"))
    result = resolve_batch(batch, identity.store(ident), CONTEXT)
    assert result.rejects.count() == 0 and result.export.count() == batch.count()


def test_a_computed_batch_is_computed_once(spark):
    """Whatever a caller derives its batch by is not repeated for every reader of the batch."""
    ident = identity.ident(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    batch = identity.batch(ident)
    rows = match_batch(batch.withColumn("ml_first_name", counted("ml_first_name")), identity.store(ident), CONTEXT).rows
    assert rows.count() and seen.value <= 2 * batch.count()


def test_forms_of_a_name_are_offered_once(spark, monkeypatch):
    """Equal names under one e-mail go on as one, however many profiles have them; near names still meet."""
    rows = [(i, "a@x", f"55{i}", ("Anna", "Anne", "Bob")[i % 3], "Lee") for i in range(300)] + [(300, "b@x", "1", "Zoe", "Lee")]
    names = "batch_record_id long, ml_email_address string, ml_phone string, ml_first_name string, ml_last_name string"
    offered, grouped = [], match._grouped

    def counted(keyed):
        offered.append(keyed.count())
        return grouped(keyed)

    monkeypatch.setattr(match, "_grouped", counted)
    found = {r.batch_record_id: (r.MatchID, r.ConfidenceLevel) for r in match.match_entities(spark.createDataFrame(rows, names)).collect()}
    assert found == {i: (2 if i % 3 == 2 else 0, 0.95) for i in range(300)} | {300: (None, None)}
    assert sum(offered) < 1_200
