"""The indexed identity store: what a batch reads and writes, splits, versions, races."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from kinloom.catalogue import growing, identity
from kinloom.functions.text import similarity_text
from kinloom.operators.rules import RunContext
from kinloom.plans import indexed, manifest
from kinloom.plans.buckets import Bucket, Directory
from kinloom.plans.indexed import IndexedStore, key_hash, resolve_into
from kinloom.plans.resolve import Resolution, resolve_batch

CONTEXT = RunContext(job_id="20240201000000", as_of="2024-02-01T00:00:00Z")


def people(spark, begin, end, tag=""):
    """Rows that share nothing with each other."""
    name = F.concat(F.lit(f"n{tag}"), F.col("id").cast("string"))
    return spark.range(begin, end).select(
        F.col("id").alias("batch_record_id"), F.lit("S").alias("source_name"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("source_customer_id"),
        name.alias("ml_first_name"), F.concat(F.lit("l"), name).alias("ml_last_name"), F.concat(name, F.lit("@x.org")).alias("ml_email_address"),
        F.concat(F.lit("g"), name).alias("rules_guest_id"), F.md5(name).alias("uxid"), F.lit(0.5).alias("uxid_confidence"),
        F.lit("2024-01-01T00:00:00.000Z").alias("id_res_last_updated_timestamp"), F.lit("2024-01-02T00:00:00.000Z").alias("record_last_updated_timestamp"),
    )


def cheap(monkeypatch):
    """Resolution that only writes the batch; for tests of what surrounds it."""

    def resolve(batch, known, context, rule_set):
        keys = batch.select("source_name", "source_customer_id")
        rows = known.join(keys, ["source_name", "source_customer_id"], "left_anti").unionByName(batch)
        return Resolution(batch, rows, batch.limit(0), batch.select("source_name", "source_customer_id", "batch_record_id"))

    monkeypatch.setattr(indexed, "resolve_batch", resolve)


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def paths(store, table):
    return {b.name: b.path for b in store.tables[table].buckets.values()}


def test_a_small_batch_touches_only_its_buckets(spark, tmp_path, monkeypatch):
    cheap(monkeypatch)
    store = IndexedStore.create(people(spark, 0, 2000), str(tmp_path / "s"), max_rows=16)
    assert len(store.tables["rows"].buckets) >= 128 and len(store.tables["index"].buckets) >= 256
    batch = people(spark, 100, 120).withColumn("ml_last_name", F.lit("Changed")).withColumn("record_last_updated_timestamp", F.lit("2024-02-01T00:00:00.000Z"))
    before, files = paths(store, "rows"), set(glob.glob(f"{tmp_path}/s/data/**/*.parquet", recursive=True))
    done = resolve_into(spark, store.folder, batch, CONTEXT, "b1")
    assert len(done.read["rows"]) <= 20 and len(done.written["rows"]) <= 40 and len(done.read["index"]) < len(store.tables["index"].buckets)
    later = IndexedStore.latest(spark, store.folder)
    after = paths(later, "rows")
    assert {n for n in after if after[n] != before.get(n)} <= set(done.written["rows"])
    new = set(glob.glob(f"{tmp_path}/s/data/**/*.parquet", recursive=True)) - files
    assert len([f for f in new if "bucket=" in f]) <= 40 + len(done.written["index"]) + 8
    assert later.rows().count() == 2000 and later.rows().filter("ml_last_name = 'Changed'").count() == 20
    assert plain(IndexedStore(spark, store.folder, 0).rows()) == plain(people(spark, 0, 2000))


def test_an_unchanged_row_leaves_the_index_alone(spark, tmp_path, monkeypatch):
    cheap(monkeypatch)
    store = IndexedStore.create(people(spark, 0, 300), str(tmp_path / "s"), max_rows=16)
    batch = people(spark, 7, 8).withColumn("record_last_updated_timestamp", F.lit("2024-03-01T00:00:00.000Z"))
    done = resolve_into(spark, store.folder, batch, CONTEXT, "b1")
    assert set(done.written) == {"rows"} and len(done.written["rows"]) == 1
    row = IndexedStore.latest(spark, store.folder).rows().filter("batch_record_id = 7").first()
    assert row.record_last_updated_timestamp == "2024-03-01T00:00:00.000Z"


def test_buckets_split_and_old_versions_stay(spark, tmp_path, monkeypatch):
    cheap(monkeypatch)
    store = IndexedStore.create(people(spark, 0, 10), str(tmp_path / "s"), max_rows=10)
    assert list(store.tables["rows"].buckets) == ["0-0"]
    for number, (begin, end) in enumerate([(10, 60), (60, 64), (64, 200)]):
        resolve_into(spark, store.folder, people(spark, begin, end), CONTEXT, f"b{number}")
    latest = IndexedStore.latest(spark, store.folder)
    assert latest.version == 3 and len({b.depth for b in latest.tables["index"].buckets.values()}) > 1
    for version, rows in enumerate([10, 60, 64, 200]):
        old = IndexedStore(spark, store.folder, version)
        assert old.rows().count() == rows == sum(b.rows for b in old.tables["rows"].buckets.values())
    labelled = latest.rows().select(latest.tables["rows"].name_of(key_hash()).alias("b"))
    assert labelled.filter("b IS NULL").isEmpty()


def test_directory_covers_every_hash_once(spark):
    directory, names = Directory([Bucket(0, 0, "p", 10)]).grown({"0-0": 30}, 10)
    assert sorted(names) == ["2-0", "2-1", "2-2", "2-3"]
    directory, names = directory.grown({"2-1": 15}, 10)
    assert sorted(names) == ["3-1", "3-5"]
    h = spark.range(-50, 50).select(F.xxhash64("id").alias("h"))
    found = {(r.h, r.b) for r in h.select("h", directory.name_of(F.col("h")).alias("b")).collect()}
    for value, name in found:
        depth, code = map(int, name.split("-"))
        assert name in directory.buckets and value & ((1 << depth) - 1) == code


def test_many_buckets_of_several_depths(spark):
    """Codes beyond the number that is compared one by one."""
    directory = Directory.sized(256, 1)
    directory, _ = directory.grown({f"8-{code}": 2 for code in range(0, 256, 2)}, 1)
    assert sorted({b.depth for b in directory.buckets.values()}) == [8, 9]
    h = spark.range(-3000, 3000).select(F.xxhash64("id").alias("h"))
    found = h.select("h", directory.name_of(F.col("h")).alias("b")).collect()
    assert {r.b for r in found} == set(directory.buckets)
    for value, name in found:
        depth, code = map(int, name.split("-"))
        assert value & ((1 << depth) - 1) == code


def test_files_follow_the_rows_and_not_the_buckets(spark, tmp_path):
    store = IndexedStore.create(people(spark, 0, 2000), str(tmp_path / "s"), max_rows=4)
    buckets = sum(len(d.buckets) for d in store.tables.values())
    assert buckets > 3000 and len(glob.glob(f"{tmp_path}/s/data/**/*.parquet", recursive=True)) < 30
    some = sorted(store.tables["rows"].buckets)[:100]
    wanted = store.whole("rows").filter(store.tables["rows"].name_of(F.col("_h")).isin(some))
    assert plain(store.read("rows", some)) == plain(wanted) and wanted.count() > 100
    assert plain(store.read("rows", some[:1])) == plain(wanted.filter(store.tables["rows"].name_of(F.col("_h")) == some[0]))


@pytest.fixture(scope="module")
def view(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = spark.sql(growing.GROWING_SQL.replace("FROM events", "FROM {events}"), events=events)
    return identity.store(rows), identity.batch(rows)


def test_batch_after_batch_equals_the_whole_store(spark, tmp_path, view):
    stored, batch = view
    folder = str(tmp_path / "s")
    IndexedStore.create(stored, folder, max_rows=40)
    for number in range(2):
        part = batch.filter(F.col("batch_record_id") % 2 == number)
        whole = resolve_batch(part, stored, CONTEXT)
        done = resolve_into(spark, folder, part, CONTEXT, f"b{number}")
        assert plain(done.resolution.export) == plain(whole.export)
        stored = spark.createDataFrame(whole.store.collect(), whole.store.schema)
        names = stored.columns
        assert plain(IndexedStore.latest(spark, folder).rows().select(names)) == plain(stored)


def test_two_jobs_lose_no_batch(spark, tmp_path, monkeypatch):
    """While one job resolves its batch, another commits: the first starts again from that."""
    cheap(monkeypatch)
    store = IndexedStore.create(people(spark, 0, 50), str(tmp_path / "s"), max_rows=16)
    update, others = IndexedStore.update, [("b2", people(spark, 60, 70)), ("b3", people(spark, 45, 55, "x"))]

    def slow(self, *args):
        if others:
            name, rows = others.pop()
            resolve_into(spark, store.folder, rows, CONTEXT, name)
        return update(self, *args)

    monkeypatch.setattr(IndexedStore, "update", slow)
    done = resolve_into(spark, store.folder, people(spark, 50, 60), CONTEXT, "b1")
    latest = IndexedStore.latest(spark, store.folder)
    assert done.version == latest.version == 3 and sorted(latest.content["batches"]) == ["b1", "b2", "b3"]
    assert latest.rows().count() == 70
    again = resolve_into(spark, store.folder, people(spark, 50, 60), CONTEXT, "b2")
    assert again.resolution is None and manifest.versions(spark, store.folder) == [0, 1, 2, 3]


def test_a_version_is_committed_once(spark, tmp_path):
    folder = str(tmp_path / "m")
    manifest.commit(spark, folder, 0, {"a": "é"})
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, folder, 0, {"a": 2})
    assert manifest.load(spark, folder, 0) == {"a": "é"} and manifest.versions(spark, folder) == [0]
    assert manifest.versions(spark, str(tmp_path / "none")) == []


def test_nulls_blanks_and_empty_batches(spark, tmp_path, monkeypatch):
    cheap(monkeypatch)
    odd = people(spark, 0, 4).withColumns({c: F.lit(None).cast("string") for c in ("ml_first_name", "ml_last_name", "ml_email_address", "rules_guest_id")})
    odd = odd.withColumn("source_customer_id", F.when(F.col("batch_record_id") != 3, F.col("source_customer_id")))
    store = IndexedStore.create(odd.unionByName(people(spark, 10, 20)), str(tmp_path / "s"), max_rows=4)
    assert store.lookup(people(spark, 0, 0)).rows.count() == 0
    assert store.lookup(odd).rows.count() == 4
    with pytest.raises(ValueError, match="lacks"):
        store.lookup(people(spark, 0, 1).drop("ml_last_name"))
    empty = IndexedStore.create(people(spark, 0, 0), str(tmp_path / "e"))
    resolve_into(spark, empty.folder, people(spark, 0, 3), CONTEXT, "b")
    assert IndexedStore.latest(spark, empty.folder).rows().count() == 3


def test_an_exact_look_up_reads_keys_and_digests_only(spark, tmp_path):
    """Rows that share an e-mail or a text with the batch stay unread; without signatures nothing similar can be asked."""
    shared = people(spark, 0, 200).withColumn("ml_email_address", F.lit("all@x.org"))
    store = IndexedStore.create(shared, str(tmp_path / "s"), max_rows=16, texts=False)
    batch = shared.filter("batch_record_id < 3").withColumn("source_customer_id", F.lit("new"))
    batch = batch.unionByName(shared.filter("batch_record_id = 9").withColumn("ml_last_name", F.lit("Changed")))
    assert sorted(r.batch_record_id for r in store.known(batch).rows.collect()) == [0, 1, 2, 9]
    assert sum(b.rows for b in store.tables["index"].buckets.values()) <= 4 * 200
    with pytest.raises(ValueError, match="without texts"):
        store.lookup(batch)


def test_an_update_signs_only_texts_that_changed(spark, tmp_path, monkeypatch):
    """Of 40 rows one changes its name and one its id; the index is that of the new rows."""
    store = IndexedStore.create(people(spark, 0, 40), str(tmp_path / "s"), max_rows=16)
    before = store.whole("rows")
    after = before.withColumn("ml_first_name", F.when(F.col("batch_record_id") == 7, "Zoe").otherwise(F.col("ml_first_name")))
    after = after.withColumn("uxid", F.when(F.col("batch_record_id") == 9, "new").otherwise(F.col("uxid")))
    signed, real = [], indexed._signed

    def counted(rows, *more):
        signed.append(rows.count())
        return real(rows, *more)

    monkeypatch.setattr(indexed, "_signed", counted)
    store.update(before, after, "b1")
    assert signed == [1, 1]
    latest = IndexedStore.latest(spark, store.folder)
    entries = indexed._entries(latest.whole("rows"), latest.features, latest.whole("words"))
    assert set(latest.whole("index").collect()) == set(entries.select(latest.whole("index").columns).collect())


def similar(batch, stored):
    """Pairs of record ids whose texts share at least 0.3 of their words."""
    words = {side: {r.batch_record_id: set((r.t or "").lower().split()) for r in df.withColumn("t", similarity_text(df)).collect()} for side, df in (("x", batch), ("y", stored))}
    return {(i, j) for i, x in words["x"].items() for j, y in words["y"].items() if x and y and len(x & y) / len(x | y) >= 0.3}


def mixed(spark, begin, end, tag):
    """Rows whose texts share frequent and rare words with others, and hold words of their own."""
    n = F.col("batch_record_id")
    rows = people(spark, begin, end, tag).withColumn("ml_address_line_1", F.concat((n % 13).cast("string"), F.lit(" Main St")))
    rows = rows.withColumn("ml_last_name", F.concat(F.lit("l"), (n % 29).cast("string"))).withColumn("ml_phone", F.concat(F.lit("p"), (n % 17).cast("string")))
    return rows.withColumn("ml_first_name", F.when(n % 11 > 0, F.col("ml_first_name"))).withColumn("ml_email_address", F.when(n % 3 > 0, F.col("ml_email_address")))


@pytest.mark.parametrize("share", [1, 12, 10**6])
def test_similar_rows_are_found_whatever_words_are_rare(share, spark, tmp_path, monkeypatch):
    """Words of the first version and of later ones, rare and frequent: the look-up misses no similar row."""
    cheap(monkeypatch)
    monkeypatch.setattr(indexed, "_RARE_SHARE", share)
    store = IndexedStore.create(mixed(spark, 0, 90, "a"), str(tmp_path / "s"), max_rows=16)
    resolve_into(spark, store.folder, mixed(spark, 70, 120, "b"), CONTEXT, "b1")
    latest = IndexedStore.latest(spark, store.folder)
    texts = latest.rows().withColumn("t", similarity_text(latest.rows())).collect()
    assert {w for r in texts for w in r.t.lower().split()} <= {r.w for r in latest.whole("words").collect()}
    entries = indexed._entries(latest.whole("rows"), latest.features, latest.whole("words"))
    assert set(latest.whole("index").collect()) == set(entries.select(latest.whole("index").columns).collect())
    batch = mixed(spark, 100, 140, "b").withColumn("source_customer_id", F.concat(F.lit("x"), F.col("source_customer_id")))
    batch = batch.withColumns({c: F.lit(None).cast("string") for c in ("uxid", "rules_guest_id")})
    wanted, known = similar(batch, latest.rows()), {r.batch_record_id for r in latest.lookup(batch).rows.collect()}
    assert len(wanted) > 100 and {j for _, j in wanted} <= known


def test_rare_words_make_few_index_entries(spark, tmp_path, monkeypatch):
    """A rare word is one entry and not one for each word behind it; words that no stored text has make none."""
    rows, sizes = mixed(spark, 0, 120, "a"), []
    for share in (10**6, 1):
        monkeypatch.setattr(indexed, "_RARE_SHARE", share)
        store = IndexedStore.create(rows, str(tmp_path / f"s{share}"), max_rows=16)
        sizes.append(store.whole("index").filter("n IS NOT NULL").count())
    assert sizes[1] * 3 < sizes[0] * 2
    strange = people(spark, 500, 520, "z")
    assert indexed._signed(strange, "batch_record_id", store._frequency(strange, {})).isEmpty()


def test_a_store_of_other_signatures_is_refused(spark, tmp_path):
    store = IndexedStore.create(people(spark, 0, 5), str(tmp_path / "s"))
    manifest.commit(spark, store.folder, 1, {k: v for k, v in store.content.items() if k != "signatures"})
    with pytest.raises(ValueError, match="another version"):
        IndexedStore.latest(spark, store.folder)
