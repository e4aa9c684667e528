"""An identity store that a batch looks up instead of scanning.

Rows lie in buckets by the hash of their key; an index table, in buckets by the hash of a
value, leads from e-mails, guest ids, ids, person digests and text signatures to the keys
of the rows that have them.  A bucket is named by (depth, code): it holds the hashes whose
``depth`` low bits are ``code``.  One that outgrows ``max_rows`` splits into deeper ones
(extendible hashing), so the number of buckets, of files and of write tasks follows the
store; depths differ from bucket to bucket and nothing else is ever rewritten.  All buckets
of a version are named in its manifest (``manifest``): a batch writes the buckets it
changes and a new manifest, so old versions stay readable across splits.

``lookup`` gives every stored row that ``resolve_batch`` could need for a batch, and
possibly more: rows with its keys, digests, e-mails, guest ids or ids, rows of similar text,
and rows that share the id of any of these.  Index entries hold 64-bit hashes: two values
that collide only add rows.  As more rows than needed change no result, resolving against
the looked-up rows equals resolving against the whole store.

Similar texts meet under rare words, or pairs of words, out of their prefixes (``operators.match``).
Both sides must order words alike, so what a word counts for is settled by the version that has it
first and kept with the store (``words``); a word that becomes frequent later costs speed with time
but no pair.  Words of a batch that the store does not have are shared with no stored text and make
no signatures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import person_digest
from ..functions.text import blanks_to_null, lookup_key, similarity_text
from ..operators import match, rules
from ..operators.rules import Rule, RunContext
from ..session import cut_lineage, drop_unused
from . import manifest
from .buckets import MAX_ROWS, BucketStore, dealt
from .resolve import Resolution, resolve_batch

THRESHOLD = 0.3
# A word is rare if its share of the texts that it was counted in is at most one in so many, and RARE_WORDS at most.
_RARE_SHARE = 5_000
_SIGNATURES = 2  # what the index holds of texts; stores of another kind are refused


# ---- entries ---------------------------------------------------------------


def key_hash(record: str = "batch_record_id") -> Column:
    """Where a row lies; a row without full key is dealt by its record id."""
    return F.xxhash64(F.coalesce(match.record_key(), F.col(record).cast("string")))


def _values(features: Sequence[str], columns: Sequence[str], only: str | None = None) -> Column:
    """Array of the hashes under which a row can be found, texts apart, with nulls; those of one kind with ``only``."""
    kinds = {
        "email": lookup_key("ml_email_address"),
        "guest": F.col("rules_guest_id"),
        "uxid": F.col("uxid"),
        "twin": person_digest(features),
    }
    present = {"email": "ml_email_address", "guest": "rules_guest_id", "uxid": "uxid"}
    kinds = {k: c for k, c in kinds.items() if only in (None, k) and (present.get(k, "uxid") in columns or k == "twin")}
    return F.array(*[F.when(c.isNotNull(), F.xxhash64(F.lit(k), c)) for k, c in kinds.items()])


def _word_counts(rows: DataFrame, texts: int) -> DataFrame:
    """(w, common, df): the words of the person texts of ``rows``, of which there are ``texts``."""
    found = rows.select(F.explode(F.array_distinct(F.split(F.lower(similarity_text(rows)), r"\s+"))).alias("w"))
    counts = found.filter("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    return counts.select("w", (F.col("df") > min(match.RARE_WORDS, texts // _RARE_SHARE)).alias("common"), "df")


def _text_sets(rows: DataFrame, head: str, frequency: DataFrame) -> DataFrame:
    """(side, head, n, tokens, rare): the words of the person text of each row that ``frequency`` has."""
    texts = rows.select(F.lit("").alias("side"), F.col(head).alias("head"), similarity_text(rows).alias("text"))
    sets = match._token_sets(texts.filter(F.trim("text") != ""), frequency)
    # A text that can share fewer words than any partner asks for has none.
    return sets.filter(F.size("tokens") >= match._shared_words(F.col("n"), THRESHOLD))


def _signatures(sets: DataFrame) -> DataFrame:
    """(head, v, n, at, rest, words, wide): the signatures of texts, of ``words`` words, with ``rest`` that may be shared behind.

    One word is enough where it is rare, or where one of two texts is so short; without ``wide`` it has to be the other one.
    """
    lone = match._shared_words(F.col("n"), THRESHOLD) < 2
    # A partner of a one-word text has at most 1 / t times its words.
    small = F.col("n") * F.lit(THRESHOLD * THRESHOLD) <= F.lit(1 + match._EPS)
    rare = F.col("at") <= F.col("rare")
    single = match._single_signatures(sets.filter(small | (F.col("rare") > 0)), THRESHOLD).filter(small | rare)
    pairs = match._pair_signatures(sets.filter(~lone), THRESHOLD)

    def named(signed: DataFrame, kind: str, words: int, wide: Column) -> DataFrame:
        return signed.select(
            "head", F.xxhash64(F.lit(kind), F.col("signature")).alias("v"), "n", F.col("at").cast("int").alias("at"),
            (F.size("tokens") - F.col("at")).cast("int").alias("rest"), F.lit(words).alias("words"), wide.alias("wide"),
        )

    return named(single, "word", 1, lone | rare).unionByName(named(pairs, "pair", 2, F.lit(True)))


def _signed(rows: DataFrame, head: str, frequency: DataFrame) -> DataFrame:
    """The signatures of the person text of each row."""
    return _signatures(_text_sets(rows, head, frequency))


class Lookup(NamedTuple):
    """``rows``: what the store knows of a batch, with the hash ``_h``; ``read``: the buckets that were read."""

    rows: DataFrame
    read: dict[str, list[str]]


class IndexedStore(BucketStore):
    """One version of a store.  ``update`` commits the next one."""

    def __init__(self, spark: SparkSession, folder: str, version: int):
        super().__init__(spark, folder, version)
        self.features = self.content["features"]
        self.texts = self.content.get("texts", True)
        if self.texts and self.content.get("signatures") != _SIGNATURES:
            raise ValueError(f"the index of {self.folder} was made by another version: create the store anew from its rows")

    @classmethod
    def create(cls, rows: DataFrame, folder: str, max_rows: int = MAX_ROWS, texts: bool = True) -> IndexedStore:
        """Version 0 of a store from whole rows, one per key.

        Most index entries are signatures of texts; a store without ``texts`` has none of them
        and answers ``known`` only.
        """
        spark, rows = rows.sparkSession, cut_lineage(rows.withColumn("_h", key_hash()))
        features = match.feature_columns(rows)
        schemas, written = {"rows": rows.schema}, {"rows": dealt(rows, F.col("_h"), folder, max_rows)}

        def stored(table: str) -> DataFrame:
            return written[table].read(spark, schemas[table], written[table].buckets)

        # What follows reads the tables as they lie in the store.
        rows = stored("rows")
        size = sum(b.rows for b in written["rows"].buckets.values())
        words = cut_lineage(_word_counts(rows if texts else rows.limit(0), size))
        schemas["words"], written["words"] = words.schema, dealt(words, F.xxhash64("w"), folder, max_rows)
        sets = cut_lineage(_text_sets(rows, "_h", stored("words"))) if texts else None
        entries = _values_of(rows, features)
        entries = entries.unionByName(_of_texts(_signatures(sets))) if texts else entries
        schemas["index"], written["index"] = entries.schema, dealt(entries, F.col("v"), folder, max_rows)
        begun = cls.begun(spark, folder, schemas, written, max_rows, features=features, texts=texts, signatures=_SIGNATURES)
        del rows, words, sets, entries
        drop_unused(spark)
        return begun

    # ---- reading

    def rows(self) -> DataFrame:
        """The whole store."""
        return self.whole("rows").drop("_h")

    def _frequency(self, rows: DataFrame, read: dict) -> DataFrame:
        words = F.explode(F.array_distinct(F.split(F.lower(similarity_text(rows)), r"\s+")))
        wanted = rows.select(words.alias("w")).distinct().withColumn("h", F.xxhash64("w"))
        return self.read("words", self.note("words", wanted, "h", read))

    def known(self, batch: DataFrame, record: str = "batch_record_id") -> Lookup:
        """The stored rows that ``match.exact_match`` needs for ``batch``: those of its keys and digests."""
        self._check(batch)
        read: dict[str, list[str]] = {}
        keys = cut_lineage(batch.select(key_hash(record).alias("h"), _values(self.features, batch.columns, "twin").alias("vs")))
        asked = cut_lineage(keys.select(F.explode("vs").alias("v")).filter("v IS NOT NULL").distinct())
        twins = self.read("index", self.note("index", asked, "v", read)).filter("n IS NULL").join(asked, "v", "left_semi")
        hashes = cut_lineage(keys.select("h").union(twins.select("h")).distinct())
        rows = self.read("rows", self.note("rows", hashes, "h", read)).join(hashes, F.col("_h") == F.col("h"), "left_semi")
        return Lookup(cut_lineage(rows), read)

    def _check(self, batch: DataFrame) -> None:
        missing = [c for c in self.features if c not in batch.columns]
        if missing:
            raise ValueError(f"the batch lacks columns that the store's digests hold: {missing}")

    def lookup(self, batch: DataFrame, record: str = "batch_record_id") -> Lookup:
        """Everything stored that resolving ``batch`` may need."""
        self._check(batch)
        if not self.texts:
            raise ValueError("the store was created without texts: it cannot say which rows are similar")
        read: dict[str, list[str]] = {}
        # Keys and values of the batch, and the signatures of its texts.
        keys = cut_lineage(batch.select(key_hash(record).alias("h"), _values(self.features, batch.columns).alias("vs")))
        asked = keys.select(F.explode("vs").alias("v")).filter("v IS NOT NULL").distinct()
        signed = _signed(batch, record, self._frequency(batch, read)).groupBy("v", "n", "words", "wide").agg(F.max("rest").alias("rest"))
        signed = cut_lineage(signed)
        near = self.note("index", signed.select("v").union(asked), "v", read)
        index = self.read("index", near)
        by_value = index.filter("n IS NULL").join(asked, "v", "left_semi").select("h")
        mine = signed.select(F.col("v"), F.col("n").alias("nx"), F.col("rest").alias("rx"), "words", "wide")
        meets = index.filter("n IS NOT NULL").join(mine, "v").filter(F.col("wide") | (match._shared_words(F.col("n"), THRESHOLD) < 2))
        # The same arithmetic as for two frames: what can still be shared behind the signature.
        possible = F.col("words") + F.least(F.col("rx"), F.col("n") - F.col("at"))
        enough = (F.col("nx") + F.col("n")) * F.lit(THRESHOLD / (1 + THRESHOLD)) - F.lit(match._EPS)
        hashes = keys.select("h").union(by_value).union(meets.filter(possible >= enough).select("h"))
        hashes = cut_lineage(hashes.distinct())
        first = self.read("rows", self.note("rows", hashes, "h", read)).join(hashes, F.col("_h") == F.col("h"), "left_semi")
        # Rows that share the id of any of these.
        ids = cut_lineage(first.filter("uxid IS NOT NULL").select(F.xxhash64(F.lit("uxid"), F.col("uxid")).alias("v")).distinct())
        kin = self.read("index", self.note("index", ids, "v", read)).filter("n IS NULL").join(ids, "v", "left_semi")
        hashes = cut_lineage(hashes.union(kin.select("h")).distinct())
        rows = self.read("rows", self.note("rows", hashes, "h", read)).join(hashes, F.col("_h") == F.col("h"), "left_semi")
        return Lookup(cut_lineage(rows), read)

    # ---- writing

    def update(self, before: DataFrame, after: DataFrame, batch_id: str) -> dict[str, list[str]]:
        """Commits the next version: ``after`` replaces the stored rows of its keys.

        ``before`` holds the stored rows of these keys (with ``_h``), as ``lookup`` gave
        them; the index entries that differ between the two are taken out and put in.  Texts are
        signed only where those of a hash are not the same before and after.
        Words that the store did not have are counted over the texts that are new.
        Returns the buckets written.  Raises ``manifest.Conflict`` when another job was first.
        """
        after = cut_lineage(after.drop("_h").withColumn("_h", key_hash()))
        changed = cut_lineage(after.select("_h").distinct())
        before = before.join(changed, "_h", "left_semi")
        words, fresh_words, signed = None, None, (before, after)
        if self.texts:
            moved = cut_lineage(_differing(*[r.select("_h", similarity_text(r).alias("t")) for r in (before, after)]).select("_h").distinct())
            signed = [r.join(moved, "_h", "left_semi") for r in (before, after)]
            words = self._frequency(signed[0].unionByName(signed[1], allowMissingColumns=True), {})
            fresh_words = cut_lineage(_word_counts(signed[1], moved.count()).join(words.select("w"), "w", "left_anti"))
            words = words.unionByName(fresh_words)
        entries = [_entries(r, self.features, words, texts) for r, texts in zip((before, after), signed, strict=True)]
        differing = cut_lineage(_differing(*entries))
        gone, fresh = (differing.filter(F.col("_later") == later).drop("_later") for later in (False, True))
        known = self.schemas["rows"]
        columns = [*known.fields, *[f for f in after.schema.fields if f.name not in known.names]]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns])
        tables, written = {}, {}
        for table, column, added, removed in (("rows", "_h", after, changed), ("index", "v", fresh, gone)):
            touched = self.tables[table].names(added.select(column).union(removed.select(column)), column)
            if touched:
                rest = self.read(table, touched).join(removed, "_h", "left_anti") if table == "rows" else self._without(touched, removed)
                tables[table], written[table] = self.rewritten(table, touched, rest, added, F.col(column))
        if fresh_words is not None:
            touched = self.tables["words"].names(fresh_words.select(F.xxhash64("w").alias("h")), "h")
            if touched:
                tables["words"], _ = self.rewritten("words", touched, self.read("words", touched), fresh_words, F.xxhash64("w"))
        self.commit(tables, batch_id, schemas=self.content["schemas"] | {"rows": schema.jsonValue()})
        return written

    def _without(self, touched: list[str], removed: DataFrame) -> DataFrame:
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("v", "h", "n", "at")]
        return self.read("index", touched).alias("l").join(removed.alias("r"), same[0] & same[1] & same[2] & same[3], "left_anti")


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """The distinct rows of just one of two frames; ``_later`` marks those of ``after``."""
    sides = before.withColumn("_later", F.lit(False)).unionByName(after.withColumn("_later", F.lit(True)))
    seen = sides.groupBy(*before.columns).agg(F.min("_later").alias("_first"), F.max("_later").alias("_later"))
    return seen.filter(F.col("_first") == F.col("_later")).drop("_first")


def _entries(rows: DataFrame, features: Sequence[str], words: DataFrame | None, texts: DataFrame | None = None) -> DataFrame:
    """(v, h, n, at): the index entries of stored rows; n and at are those of a text signature, which need ``words``.

    Only the rows ``texts`` are signed, if given.  Rows of one hash may repeat an entry.
    """
    values = _values_of(rows, features)
    if words is None:
        return values
    return values.unionByName(_of_texts(_signed(rows if texts is None else texts, "_h", words)))


def _values_of(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    none = F.lit(None).cast("int")
    values = rows.select(F.explode(_values(features, rows.columns)).alias("v"), F.col("_h").alias("h"), none.alias("n"), none.alias("at"))
    return values.filter("v IS NOT NULL")


def _of_texts(signed: DataFrame) -> DataFrame:
    return signed.select("v", F.col("head").alias("h"), "n", "at")


class Outcome(NamedTuple):
    """``resolution`` is None for a batch that the store had already taken."""

    resolution: Resolution | None
    version: int
    read: dict[str, list[str]]
    written: dict[str, list[str]]


def resolve_into(
    spark: SparkSession,
    folder: str,
    batch: DataFrame,
    context: RunContext,
    batch_id: str,
    rule_set: Sequence[Rule] = tuple(rules.DEFAULT_RULES),
    attempts: int = 5,
    before_commit: Callable[[Resolution], None] = lambda resolution: None,
) -> Outcome:
    """Resolves a batch against the latest version and commits what it changes.

    ``before_commit`` may write the result elsewhere, in a way that a repetition replaces.

    When another job commits first the batch is resolved again, against what that job left;
    a batch id that the store has taken already changes nothing.  The batch is materialised,
    as every step reads it.
    """
    materialised = False
    for attempt in range(attempts):
        store = IndexedStore.latest(spark, folder)
        if store.applied(batch_id):
            return Outcome(None, store.version, {}, {})
        batch, materialised = (batch if materialised else cut_lineage(batch)), True
        asked = rules.run_rules(blanks_to_null(batch), rule_set, "pre_search", context)
        known = store.lookup(asked)
        drop_unused(spark)
        result = resolve_batch(batch, known.rows.drop("_h"), context, rule_set)
        drop_unused(spark)
        changed = result.changed.select(key_hash().alias("_h")).distinct()
        after = result.store.withColumn("_h", key_hash()).join(changed, "_h", "left_semi")
        before_commit(result)
        try:
            written = store.update(known.rows, after, batch_id)
            return Outcome(result, store.version + 1, known.read, written)
        except manifest.Conflict:
            if attempt + 1 == attempts:
                raise
    raise AssertionError("unreachable")
