"""Matching a batch against the identity store and within itself.

Three stages, each exact under its definition and free of pair caps: equality of
keys and person digests, similarity of person texts, and rule-based entity
matching.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import person_digest
from ..functions.text import lookup_key
from ..schema import HISTORY_TYPE, KEY_COLUMNS, PERSON_COLUMNS
from ..session import cut_lineage
from .graph import connected_components
from .groups import attach, top_per_group
from .project import mark_original
from .scorers import Scorer, score_pairs

# ---- exact matching ------------------------------------------------------


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in [*PERSON_COLUMNS, "rules_guest_id"] if c in df.columns]


def record_key(names: Sequence[str] = tuple(KEY_COLUMNS)) -> Column:
    """The key columns as one value; null when one of them is null."""
    parts = [F.col(n).cast("string") for n in names]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


KNOWN_COLUMNS = ["known_uxid", "known_confidence", "known_time", "known_past"]


def exact_match(
    batch: DataFrame,
    store: DataFrame,
    updated: str = "record_last_updated_timestamp",
    record: str = "batch_record_id",
) -> DataFrame:
    """Scenario, delete flag and known id of each batch row.

    1 = key known, same person data; 2 = key known, data differs; 3 = key new,
    a stored row has the same data (its id is adopted, the oldest row's when
    there are several); 4 = neither.  Rows superseded by a newer row of the same
    key, in the batch or in the store, are flagged for deletion.  A row without a
    full key repeats no other row and is known to no store: it is never flagged,
    and the join hashes it by its record id.

    The store is reduced to the batch's keys and digests before anything is sorted,
    and everything known of a key stands in one right side, so one join meets a hot key.
    """
    features = [c for c in feature_columns(batch) if c in store.columns]
    rows = batch.withColumns({"_digest": person_digest(features), "_key": record_key()})
    newest = top_per_group(
        rows.filter(F.col("_key").isNotNull()).select("_key", updated, record),
        ["_key"],
        [F.col(updated).desc_nulls_last(), F.col(record).desc()],
    ).select("_key", F.col(record).alias("_newest"))
    past = F.col("past_uxids") if "past_uxids" in store.columns else F.lit(None)
    stored = store.select(
        *KEY_COLUMNS,
        record_key().alias("_key"),
        person_digest(features).alias("_twin"),
        F.col(updated).alias("_time"),
        F.struct(
            F.col("uxid").alias("known_uxid"),
            F.col("uxid_confidence").cast("double").alias("known_confidence"),
            F.col("id_res_last_updated_timestamp").alias("known_time"),
            past.cast(HISTORY_TYPE).alias("known_past"),
        ).alias("_id"),
    )
    known = stored.join(newest.select("_key"), "_key", "left_semi").select(
        "_key",
        F.col("_twin").alias("_stored_digest"),
        F.col("_time").alias("_stored_time"),
        F.col("_id").alias("_stored_id"),
        F.lit(True).alias("_known"),
    )
    wanted = rows.select(F.col("_digest").alias("_twin")).filter(F.col("_twin").isNotNull()).distinct()
    twins = top_per_group(
        stored.filter(F.col("_id.known_uxid").isNotNull()).join(wanted, "_twin", "left_semi"),
        ["_twin"],
        [F.col("_time").asc_nulls_last(), *map(F.col, KEY_COLUMNS)],
    ).select("_twin", F.col("_id").alias("_twin_id"))

    joined = attach(rows, newest.join(known, "_key", "left"), "_key", record)
    # Only rows with a new key look for a twin.
    joined = joined.withColumn("_twin", F.when(F.col("_known").isNull(), F.col("_digest")))
    joined = attach(joined, twins, "_twin", record)
    same = F.col("_digest").eqNullSafe(F.col("_stored_digest"))
    scenario = (
        F.when(F.col("_known") & same, 1).when(F.col("_known"), 2).when(F.col("_twin_id").isNotNull(), 3).otherwise(4)
    )
    stale = (F.col("_key").isNotNull() & ~F.col(record).eqNullSafe(F.col("_newest"))) | F.coalesce(
        F.col(updated) < F.col("_stored_time"), F.lit(False)
    )
    found = F.coalesce(F.col("_stored_id"), F.col("_twin_id"))
    return joined.withColumns(
        {
            "processing_scenario": scenario,
            "delete_flag": F.when(stale, "Y").otherwise("N"),
            **{c: found[c] for c in KNOWN_COLUMNS},
        }
    ).drop("_digest", "_key", "_newest", "_stored_digest", "_stored_time", "_stored_id", "_known", "_twin", "_twin_id")


def route_exact(matched: DataFrame) -> dict[str, DataFrame]:
    """What happens next to each row of an exact match.

    ``touch``: known and unchanged, only stamps move.  ``insert``: new key with
    an adopted id.  ``bypass``: both of them, no further matching.  ``match``:
    goes on to similarity and entity matching.  ``reject``: superseded.  A bypassed
    row takes the known id with its confidence and time.  The input is materialised,
    as every route reads it.
    """
    matched = cut_lineage(matched)
    live = matched.filter(F.col("delete_flag") == "N")
    bypass = live.filter(F.col("processing_scenario").isin(1, 3)).withColumns(
        {
            "uxid": F.col("known_uxid"),
            "uxid_confidence": F.col("known_confidence"),
            "id_res_last_updated_timestamp": F.col("known_time"),
        }
    )
    return {
        "touch": bypass.filter(F.col("processing_scenario") == 1),
        "insert": bypass.filter(F.col("processing_scenario") == 3),
        "bypass": bypass,
        "match": live.filter(F.col("processing_scenario").isin(2, 4)),
        "reject": matched.filter(F.col("delete_flag") == "Y"),
    }


# ---- similarity of person texts ------------------------------------------

# Float guard for products such as 0.07 * 100.
_EPS = 1e-9
_SEP = "\u0001"
# Meetings of a signature beyond which it takes in one more word; from the most words on only
# texts with few words behind it go on.
HOT_MEETINGS = 100_000
# A word of at most so many texts is a signature by itself.
RARE_WORDS = 100
_MOST_WORDS = 4
# Names whose forms are offered in one go, unless that takes more goes than this.
_NAMES_AT_ONCE = 250_000
_MOST_ROUNDS = 16
_MOST_REST = 8


def _shared_words(size: Column, threshold: float) -> Column:
    """Fewest words a text of this size shares with any similar one."""
    return F.ceil(size * F.lit(threshold) - F.lit(_EPS)).cast("int")


def _token_sets(texts: DataFrame, frequency: DataFrame | None = None, rare: int = 0) -> DataFrame:
    """(side, head, n, tokens, rare): ``n`` distinct words per text; ``tokens`` are those that can be shared, rarest first.

    The first ``rare`` of them are rare words.  Rarity is counted over both sides with map-side combining: words that
    only one side has are left out, the others numbered, and those of at most ``rare`` texts are the rare ones.  Or it
    comes from ``frequency`` (w, common, df), and words that are not in it are left out.  Only the words of one
    person's text are ever gathered in one row.  Further columns of ``texts`` are kept.
    """
    kept = [c for c in texts.columns if c != "text"]
    listed = F.array_distinct(F.array_remove(F.split(F.lower("text"), r"\s+"), ""))
    words = texts.select(*kept, listed.alias("_l")).select(*kept, F.size("_l").alias("n"), F.explode("_l").alias("w"))
    if frequency is None:
        counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("df"), F.min("side").alias("_first"), F.max("side").alias("_last"))
        shared = cut_lineage(counts.filter("_first <> _last").select("w", (F.col("df") > rare).alias("common"), "df"))
        ranked = words.join(shared.withColumn("token", F.monotonically_increasing_id()), "w")
    else:
        ranked = words.join(frequency, "w").withColumn("token", F.col("w"))
    return (
        ranked
        .groupBy(*kept, "n")
        .agg(F.sort_array(F.collect_list(F.struct("common", "df", "token"))).alias("ranked"), F.count_if(~F.col("common")).cast("int").alias("rare"))
        .select(*kept, "n", F.col("ranked.token").alias("tokens"), "rare")
    )


def _size(sets: DataFrame) -> Column:
    """Words of a text, with those that only its side has."""
    return F.col("n") if "n" in sets.columns else F.size("tokens")


def _prefix(sets: DataFrame, threshold: float, words: int) -> Column:
    """The rarest words of a text among which it meets any similar text ``words`` times.

    Texts at or above the threshold share at least ``ceil(t * n)`` of ``n`` words.  All but one
    of that many of the most frequent words can be dropped and similar texts still meet in the
    rest; for every further meeting one more is kept.  Words that cannot be shared count for the
    length only, so the fewer can be shared the shorter the prefix.  Where only the partner's length asks for
    ``words`` shared words, the whole text stays.
    """
    need = F.greatest(_shared_words(_size(sets), threshold), F.lit(words))
    return F.slice("tokens", F.lit(1), F.greatest(F.size("tokens") - need + words, F.lit(0)))


def _single_signatures(sets: DataFrame, threshold: float) -> DataFrame:
    """One row per word of a text's prefix."""
    return _alone(sets, _prefix(sets, threshold, 1))


def _rare_signatures(sets: DataFrame, threshold: float) -> DataFrame:
    """One row per rare word of a text's prefix.

    Rare words come first, so a pair of texts whose first shared word is rare meets under it, and
    all others meet under pairs of words behind the rare ones.
    """
    return _alone(sets, F.slice(_prefix(sets, threshold, 1), F.lit(1), F.col("rare")))


def _alone(sets: DataFrame, words: Column) -> DataFrame:
    return sets.select("*", F.posexplode(words).alias("_i", "_a")).select(
        *sets.columns, F.col("_a").cast("string").alias("signature"), (F.col("_i") + 1).alias("at")
    )


def _pair_signatures(sets: DataFrame, threshold: float) -> DataFrame:
    """One row per pair of words of a text's prefix, behind its rare words if these are told."""
    first = sets.select("*", _prefix(sets, threshold, 2).alias("_p")).select("*", F.posexplode("_p").alias("_i", "_a"))
    if "rare" in sets.columns:
        first = first.filter(F.col("_i") >= F.col("rare"))
    rest = F.slice("_p", F.col("_i") + 2, F.size("_p"))
    return first.select("*", F.posexplode(rest).alias("_j", "_b")).select(
        *sets.columns,
        F.concat_ws(_SEP, F.col("_a").cast("string"), F.col("_b").cast("string")).alias("signature"),
        (F.col("_i") + F.col("_j") + 2).alias("at"),
    )


def _extended(keyed: DataFrame, threshold: float, words: int) -> DataFrame:
    """Signatures of ``words`` words from those of one less: one row per further word of the longer prefix."""
    kept = [c for c in keyed.columns if c not in ("signature", "at")]
    rest = F.slice("_p", F.col("at") + 1, F.size("_p"))
    longer = keyed.filter(F.size("tokens") >= words).withColumn("_p", _prefix(keyed, threshold, words))
    return longer.select(*kept, "signature", "at", F.posexplode(rest).alias("_j", "_w")).select(
        *kept, F.concat_ws(_SEP, "signature", F.col("_w").cast("string")).alias("signature"), (F.col("at") + F.col("_j") + 1).alias("at")
    )


def _sides(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    sized = keyed.withColumns({"n": _size(keyed), "m": F.size("tokens")})
    traits = [[F.col("trait").alias(t)] if "trait" in keyed.columns else [] for t in ("tx", "ty")]
    left = sized.filter("side = 'batch'").select(
        "signature", "head", F.col("tokens").alias("x"), F.col("n").alias("nx"), (F.col("m") - F.col("at")).alias("rx"), *traits[0]
    )
    right = sized.filter("side = 'store'").select(
        "signature", F.col("head").alias("other"), F.col("tokens").alias("y"), F.col("n").alias("ny"), (F.col("m") - F.col("at")).alias("ry"), *traits[1]
    )
    return left, right


def _met(left: DataFrame, right: DataFrame, threshold: float, words: int, exactly: bool = False) -> DataFrame:
    """(head, other, score) of the similar pairs whose first ``words`` shared words are a signature, with their traits if any.

    ``exactly``: only those that share no other word.
    """
    # A pair meets under several signatures and counts under the first one only;
    # then all other shared words stand behind the signature in both texts, which
    # rules most meetings out by arithmetic alone.
    joined = left.join(right, "signature")
    possible = F.lit(words) if exactly else words + F.least("rx", "ry")
    wanted = (F.col("nx") + F.col("ny")) * F.lit(threshold / (1 + threshold)) - F.lit(_EPS)
    joined = joined.filter(possible >= wanted)
    shared = joined.withColumn("_both", F.array_intersect("x", "y"))
    lead = F.concat_ws(_SEP, F.slice("_both", 1, words).cast("array<string>"))
    common = F.size("_both")
    if exactly:
        shared = shared.filter(common == words)
    union = F.col("nx") + F.col("ny") - common
    return shared.filter((lead == F.col("signature")) & (common >= union * F.lit(threshold) - F.lit(_EPS))).select(
        "head", "other", F.round(common / union, 6).alias("score"), *[t for t in ("tx", "ty") if t in shared.columns]
    )


def _met_short(keyed: DataFrame, threshold: float, hot: int, k: int | None) -> DataFrame:
    """The similar pairs with a text so short that one shared word may do.

    Such texts meet all, and the others meet such texts only: two longer ones share a pair of words.
    """
    lone = _shared_words(_size(keyed), threshold) < 2
    met = None
    for batch, store in ((lone, F.lit(True)), (~lone, lone)):
        sides = keyed.filter(F.when(F.col("side") == "batch", batch).otherwise(store))
        some = _met_by_length(sides, threshold, 1, hot, k)
        met = some if met is None else met.unionByName(some)
    return met


def _met_by_length(keyed: DataFrame, threshold: float, words: int, hot: int, k: int | None) -> DataFrame:
    """``_met``, where signatures with more than ``hot`` meetings take in one more word.

    A pair under a hot signature that shares a further word meets under the longer signature of
    its first words.  One that shares just the signature consists of texts so short that neither
    must share more; of those only the ``k`` smallest stored texts of each size can be among the
    ``k`` best of a text: all of a size share at least the signature with it, so they are at least
    as similar as any other of that size that shares no more.  Where a scorer ranks texts by their
    ``trait``, it is the ``k`` smallest of each size and trait: all are similar to the text if one
    of them is, and score alike.  With ``k`` None all pairs meet.

    From ``_MOST_WORDS`` words on, texts with more than ``_MOST_REST`` words behind the signature
    meet everything under it, as they would be offered under too many longer ones.
    """
    left, right = _sides(keyed)
    sides = [F.count_if(F.col("side") == side).cast("double") for side in ("batch", "store")]
    lists = keyed.groupBy("signature").agg((sides[0] * sides[1]).alias("meetings"))
    long = cut_lineage(lists.filter(F.col("meetings") > hot).select("signature"))
    if long.isEmpty():
        return _met(left, right, threshold, words)
    found = _met(left.join(long, "signature", "left_anti"), right.join(long, "signature", "left_anti"), threshold, words)
    split = keyed.join(long, "signature", "left_semi")
    if words >= _MOST_WORDS:
        left, right = _sides(split)
        wide = [F.col("rx") > _MOST_REST, F.col("ry") > _MOST_REST]
        found = found.unionByName(_met(left.filter(wide[0]), right, threshold, words))
        found = found.unionByName(_met(left.filter(~wide[0]), right.filter(wide[1]), threshold, words))
        split = split.filter(F.size("tokens") - F.col("at") <= _MOST_REST)
    left, right = _sides(split.filter(_shared_words(_size(split), threshold) <= words))
    if k is not None:
        alike = ["ny", "ty"] if "ty" in right.columns else ["ny"]
        right = top_per_group(right, ["signature", *alike], [F.col("other")], k)
    found = found.unionByName(_met(left, right, threshold, words, exactly=True))
    longer = cut_lineage(_extended(split, threshold, words + 1))
    return found.unionByName(_met_by_length(longer, threshold, words + 1, hot, k))


def similar_topk(
    batch: DataFrame,
    store: DataFrame,
    text: str = "all_sim",
    record: str = "batch_record_id",
    k: int = 5,
    threshold: float = 0.3,
    scorer: Scorer | None = None,
    hot: int = HOT_MEETINGS,
    traits: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The ``k`` most similar stored records of each batch record, by exact Jaccard.

    A ``scorer`` of two texts (columns ``text`` and ``other_text``) ranks the pairs at or
    above the threshold instead; its scores are rounded to six digits.  With ``traits``, expressions
    over the column ``text``, it sees these of both texts only (columns ``name`` and ``other_name``
    of each), so texts with equal traits score alike.

    Every batch record with a text is answered, and every stored record counts by
    itself, ties by the smaller record id.  In between, records with equal texts are one
    text, so a heavily copied text is compared once.  Every pair at or above the
    threshold is found: texts that must share two words meet under their first shared word where it is
    rare, else under pairs of words, the few so short that one word may do meet under single words.  A pair of words under which
    more than ``hot`` pairs of texts would meet is extended word by word; pairs that cannot be among
    the ``k`` best are left out there, unless a ``scorer`` sees whole texts.
    """
    if traits is not None and scorer is None:
        raise ValueError("traits are what a scorer sees: there is none")
    named = [
        df.filter(F.trim(text) != "").select(F.col(text).alias("text"), F.col(record).alias("record"))
        for df in (batch, store)
    ]
    heads = [n.groupBy("text").agg(F.min("record").alias("head")) for n in named]
    trait = [F.struct(*[c.alias(n) for n, c in traits.items()]).alias("trait")] if traits else []
    sides = [h.select(F.lit(side).alias("side"), "head", "text", *trait) for h, side in zip(heads, ("batch", "store"), strict=True)]
    # Tokenised once; both kinds of signatures read it on both sides.
    sets = _token_sets(sides[0].union(sides[1]), rare=min(RARE_WORDS, math.isqrt(4 * hot)))
    # A text that can share fewer words than any partner asks for has none.
    sets = cut_lineage(sets.filter(F.size("tokens") >= _shared_words(F.col("n"), threshold)))
    lone = _shared_words(F.col("n"), threshold) < 2
    # A partner of a one-word text has at most 1 / t times its words.
    small = F.col("n") * F.lit(threshold * threshold) <= F.lit(1 + _EPS)
    limit = k if scorer is None or traits else None
    found = _met(*_sides(_rare_signatures(sets.filter(~lone), threshold)), threshold, 1)
    found = found.unionByName(_met_by_length(_pair_signatures(sets.filter(~lone), threshold), threshold, 2, hot, limit))
    found = found.unionByName(_met_short(_single_signatures(sets.filter(small), threshold), threshold, hot, limit))
    if scorer is not None:
        if traits:
            seen = [F.col(f"{t}.{n}").alias(f"{other}{n}") for t, other in (("tx", ""), ("ty", "other_")) for n in traits]
            pairs, needs = found.select("head", "other", *seen), [f"{other}{n}" for other in ("", "other_") for n in traits]
        else:
            pairs = found.drop("score").join(heads[0], "head").join(heads[1].toDF("other_text", "other"), "other")
            needs = ["text", "other_text"]
        found = score_pairs(pairs, scorer, needs).select("head", "other", F.round("score", 6).alias("score"))
    # The k best records lie among the k best texts, and among the k smallest records of each.
    texts = top_per_group(found, ["head"], [F.col("score").desc(), F.col("other")], k)
    if scorer is not None:
        texts = cut_lineage(texts)
    others = heads[1].withColumnRenamed("head", "other").join(named[1], "text")
    others = top_per_group(others, ["other"], [F.col("record")], k).select("other", F.col("record").alias("similar_record_id"))
    best = top_per_group(
        texts.join(others, "other"), ["head"], [F.col("score").desc(), F.col("similar_record_id")], k
    )
    asking = named[0].join(heads[0], "text").select("head", F.col("record").alias(record))
    return asking.join(best, "head").select(record, "similar_record_id", "score")


def extended_lookup(
    batch: DataFrame, store: DataFrame, record: str = "batch_record_id", similar: DataFrame | None = None
) -> DataFrame:
    """Stored rows that share the e-mail, guest id or id of any batch row, or the id of a
    stored row that ``similar`` (a frame with ``similar_record_id``) names.

    One pass over the store: its keys are exploded and meet the wanted keys once.
    """

    def keyed(df: DataFrame) -> DataFrame:
        keys = {"email": lookup_key("ml_email_address"), "guest": F.col("rules_guest_id"), "uxid": F.col("uxid")}
        pairs = [F.struct(F.lit(n).alias("kind"), c.alias("value")) for n, c in keys.items()]
        return df.select(record, F.explode(F.array(*pairs)).alias("_k")).filter("_k.value IS NOT NULL")

    wanted = keyed(batch).select("_k")
    if similar is not None:
        near = store.join(similar.select(F.col("similar_record_id").alias(record)).distinct(), record, "left_semi")
        near = near.filter("uxid IS NOT NULL").select(F.struct(F.lit("uxid").alias("kind"), F.col("uxid").alias("value")).alias("_k"))
        wanted = wanted.union(near)
    hits = keyed(store).join(wanted.distinct(), "_k", "left_semi").select(record)
    return store.join(hits.distinct(), record, "left_semi")


# ---- entity matching -----------------------------------------------------


@dataclass(frozen=True)
class MatchRule:
    """Records agreeing on all listed evidence are the same entity.

    ``name~`` accepts names one letter apart: two names agree when they have a
    common form after deleting at most one letter from each.
    """

    confidence: float
    evidence: Sequence[str]


MATCH_RULES = [
    MatchRule(1.00, ["email", "phone"]),
    MatchRule(0.95, ["email", "name"]),
    MatchRule(0.95, ["phone", "name"]),
    MatchRule(0.90, ["name", "birth", "address"]),
    MatchRule(0.85, ["email", "name~"]),
    MatchRule(0.85, ["phone", "name~"]),
    MatchRule(0.80, ["name", "birth", "postcode"]),
]


def evidence(df: DataFrame) -> Mapping[str, Column]:
    """Normalised evidence columns; a part that is blank gives null."""

    def part(*names: str) -> Column:
        keys = [lookup_key(n) if n in df.columns else F.lit(None).cast("string") for n in names]
        whole = F.concat_ws(" ", *keys)
        present = keys[0].isNotNull()
        for k in keys[1:]:
            present = present & k.isNotNull()
        return F.when(present, whole)

    digits = F.regexp_replace("ml_phone", r"\D", "") if "ml_phone" in df.columns else F.lit(None).cast("string")
    return {
        "name": part("ml_first_name", "ml_last_name"),
        "address": part("ml_address_line_1", "ml_postal_code"),
        "postcode": part("ml_postal_code"),
        "birth": part("ml_birth_date"),
        "email": part("ml_email_address"),
        "phone": F.when(digits != "", digits),
    }


def _deletions(c: Column) -> Column:
    """The text and every form of it lacking one letter."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.length(c)),
        lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1)),
    )
    return F.array_distinct(F.concat(F.array(c), cuts))


def _rule_keys(number: int, rule: MatchRule) -> Column:
    """Array of (confidence, key) a profile offers under a rule; null where it lacks evidence."""
    fixed = [F.col(e) for e in rule.evidence if e != "name~"]
    stem = F.concat_ws("\u0001", F.lit(str(number)), *fixed)
    needed = [*fixed, *([F.col("name")] if "name~" in rule.evidence else [])]
    present = needed[0].isNotNull()
    for c in needed[1:]:
        present = present & c.isNotNull()

    def entry(key: Column) -> Column:
        return F.struct(F.lit(rule.confidence).alias("confidence"), F.unhex(F.md5(key)).alias("key"))

    if "name~" not in rule.evidence:
        return F.when(present, F.array(entry(stem)))
    return F.when(present, F.transform(_deletions(F.col("name")), lambda f: entry(F.concat_ws("\u0001", stem, f))))


def _near_key(number: int, rule: MatchRule) -> Column:
    """What a profile offers under a rule with ``name~``, with its name whole: (confidence, key, stem, name)."""
    fixed = [F.col(e) for e in rule.evidence if e != "name~"]
    stem = F.concat_ws("\u0001", F.lit(str(number)), *fixed)
    present = F.col("name").isNotNull()
    for c in fixed:
        present = present & c.isNotNull()
    key = F.unhex(F.md5(F.concat_ws("\u0001", stem, "name")))
    return F.when(present, F.struct(F.lit(rule.confidence).alias("confidence"), key.alias("key"), stem.alias("stem"), F.col("name")))


def _grouped(keyed: DataFrame) -> DataFrame:
    """(key, first): the smallest profile of each key that more than one record offers."""
    groups = keyed.groupBy("key").agg(F.min("head").alias("first"), F.sum("copies").alias("records"))
    return groups.filter("records > 1").drop("records")


def _near_offers(profiles: DataFrame, rules: Sequence[tuple[int, MatchRule]]) -> DataFrame:
    """(_profile, head, confidence, first) under the rules with ``name~``.

    Profiles of one name under the same other evidence are linked to the smallest of them, and
    only that one goes on: under the forms of its name, and only where other names stand beside it.
    """
    near = F.explode(F.array(*[_near_key(i, r) for i, r in rules]))
    near = profiles.select("_profile", "head", "copies", near.alias("o")).filter("o IS NOT NULL").select("_profile", "head", "copies", "o.*")
    names = cut_lineage(
        near.groupBy("key").agg(
            F.min("head").alias("head"), F.sum("copies").alias("copies"), F.min("stem").alias("stem"), F.min("name").alias("name")
        )
    )
    met = _near_names(names)
    company = names.join(met, "key", "left").filter("copies > 1 OR firsts IS NOT NULL")
    company = company.select("key", F.col("head").alias("_entry"), F.coalesce("firsts", F.array("head")).alias("firsts"))
    offers = near.select("_profile", "head", "confidence", "key").join(company, "key")
    links = F.when(F.col("head") == F.col("_entry"), F.array_union("firsts", F.array("_entry"))).otherwise(F.array("_entry"))
    return offers.select("_profile", "head", "confidence", F.explode(links).alias("first"))


def _near_names(names: DataFrame) -> DataFrame:
    """(key, firsts): the smallest profiles whose names have a form in common with that of a key.

    Forms are many times the names and few of them are shared. So they are counted under 64-bit hashes first,
    which two forms may share by chance, and only names that pass meet under their forms. Names of one stem
    stay together, and so many stems are taken at once that what is shuffled is bounded.
    """
    several = names.groupBy("stem").agg(F.count(F.lit(1)).alias("_names")).filter("_names > 1").select("stem")
    crowded = cut_lineage(names.join(several, "stem", "left_semi").withColumn("_n", F.monotonically_increasing_id()))
    rounds = max(1, min(_MOST_ROUNDS, math.ceil(crowded.count() / _NAMES_AT_ONCE)))
    met = None
    for number in range(rounds):
        some = crowded.filter(F.pmod(F.xxhash64("stem"), F.lit(rounds)) == number)
        short = F.explode(F.transform(_deletions(F.col("name")), lambda f: F.xxhash64("stem", f)))
        offered = some.select("_n", short.alias("h"))
        shared = offered.groupBy("h").agg(F.count(F.lit(1)).alias("_names")).filter("_names > 1").select("h")
        near = cut_lineage(offered.join(shared, "h", "left_semi").select("_n").distinct())
        forms = F.explode(F.transform(_deletions(F.col("name")), lambda f: F.unhex(F.md5(F.concat_ws("\u0001", "stem", f)))))
        forms = some.join(near, "_n", "left_semi").select("key", "head", "copies", forms.alias("form"))
        firsts = _grouped(forms.withColumnRenamed("key", "_name").withColumnRenamed("form", "key")).toDF("form", "first")
        part = cut_lineage(forms.join(firsts, "form").groupBy("key").agg(F.collect_set("first").alias("firsts")))
        met = part if met is None else met.unionByName(part)
    return met


def match_entities(
    df: DataFrame,
    record: str = "batch_record_id",
    rules: Sequence[MatchRule] = tuple(MATCH_RULES),
    scorer: Scorer | None = None,
    least: float = 0.5,
) -> DataFrame:
    """Adds ``MatchID`` (smallest record of the entity, null when alone) and
    ``ConfidenceLevel`` (that of the best rule under which the record has company).

    Records with equal evidence collapse to one profile first.  Each rule turns
    into keys, and each key links its profiles to the smallest one: linear in the
    data, with no pairs formed and none left out.  Forms of a name are offered once per
    name and other evidence, however many profiles have it.

    A ``scorer`` may refuse links: it sees the evidence of both ends (``name``, ``email``, ...
    and ``other_name``, ...) of every link of a profile to the smallest one of a key, and
    links below ``least`` are dropped.  The links offered stay linear in the data.
    """
    parts = evidence(df)
    names = list(parts)
    rows = df.withColumns({f"_e_{n}": c for n, c in parts.items()})
    shown = [F.coalesce(F.concat(F.lit("="), f"_e_{n}"), F.lit("")) for n in names]
    digest = F.unhex(F.md5(F.concat_ws("\u0001", *shown)))
    rows = rows.withColumn("_profile", digest)
    profiles = rows.groupBy("_profile", *[F.col(f"_e_{n}").alias(n) for n in names]).agg(
        F.min(record).alias("head"), F.count(F.lit(1)).alias("copies")
    )
    near = [(i, r) for i, r in enumerate(rules) if "name~" in r.evidence and scorer is None]
    plain = [(i, r) for i, r in enumerate(rules) if (i, r) not in near]
    if scorer is None:
        profiles = cut_lineage(profiles)
    offered = None
    if plain:
        offers = [_rule_keys(i, r) for i, r in plain]
        # Functions of higher order are interpreted, with all they are applied to: only forms of names need them.
        if any("name~" in r.evidence for _, r in plain):
            offers = F.flatten(F.array_compact(F.array(*offers)))
        else:
            offers = F.array(*[o[0] for o in offers])
        keyed = profiles.select("_profile", "head", "copies", F.explode(offers).alias("o")).filter("o IS NOT NULL").select(
            "_profile", "head", "copies", "o.*"
        )
        offered = keyed.join(_grouped(keyed), "key")
    if scorer is not None:
        offered = _accepted(offered, profiles.select("head", *names), names, scorer, least)
    if near:
        close = _near_offers(profiles, near)
        offered = close if offered is None else offered.select(close.columns).unionByName(close)
    # One narrow row per profile with company; its links number at most its keys.
    # Components, confidence and the result all start from it.
    linked = cut_lineage(
        offered
        .groupBy("_profile", "head")
        .agg(F.max("confidence").alias("ConfidenceLevel"), F.collect_set("first").alias("links"))
    )
    edges = linked.select(F.col("head").alias("src"), F.explode("links").alias("dst"))
    labels = connected_components(linked.select(F.col("head").alias("id")), edges)
    result = linked.join(labels.withColumnRenamed("id", "head"), "head").select(
        "_profile", F.col("component").alias("MatchID"), "ConfidenceLevel"
    )
    kept = rows.drop(*[f"_e_{n}" for n in names])
    return kept.join(result, "_profile", "left").drop("_profile")


def _accepted(offered: DataFrame, profiles: DataFrame, names: Sequence[str], scorer: Scorer, least: float) -> DataFrame:
    """The offers whose link the scorer takes, with the offers of the ends that still have company."""
    other = profiles.toDF("first", *[f"other_{n}" for n in names])
    pairs = offered.filter("head <> first").select("head", "first").distinct()
    pairs = pairs.join(profiles, "head").join(other, "first")
    scored = score_pairs(pairs, scorer, [*names, *other.columns[1:]], "_score")
    taken = cut_lineage(scored.filter(F.col("_score") >= F.lit(least)).select("head", "first"))
    links = offered.join(taken, ["head", "first"], "left_semi")
    # A key's smallest profile keeps company if a link to it was taken or it stands for several records.
    kept = taken.select(F.col("first").alias("head")).distinct()
    heads = offered.filter("head = first").join(kept.withColumn("_met", F.lit(True)), "head", "left")
    heads = heads.filter(F.col("_met") | (F.col("copies") > 1)).drop("_met")
    alone = offered.filter("copies > 1 AND head <> first").withColumn("first", F.col("head"))
    return links.unionByName(heads.select(links.columns)).unionByName(alone.select(links.columns))


def match_unless_skipped(df: DataFrame, skip: str = "skip_ml", record: str = "batch_record_id") -> DataFrame:
    """Entity matching for the rows that want it; the others get null columns."""
    wanted = F.coalesce(F.col(skip), F.lit(False))
    matched = match_entities(df.filter(~wanted), record)
    return matched.unionByName(df.filter(wanted), allowMissingColumns=True)


def with_originals(original: DataFrame, normalised: DataFrame, keys: Sequence[str] = tuple(KEY_COLUMNS)) -> DataFrame:
    """Original values next to the normalised ones, joined on both keys."""
    return normalised.join(mark_original(original, keys), list(keys))
