"""Similar texts under hot signatures against every pair."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from kinloom.operators import match

SCHEMA = "batch_record_id long, all_sim string"


def texts(seed: int, first: int, size: int):
    """Texts of 1 to 14 words; words come in every frequency, and two of them are in half of the texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        words = [f"w{int(rng.random() ** 3 * 25)}" for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14]))]
        rows.append((first + i, " ".join((["hot", "Hotter"] if rng.random() < 0.5 else []) + words)))
    return rows + [(first + size, None), (first + size + 1, " "), (first + size + 2, rows[0][1])]


def brute(batch, store, threshold, k):
    def words(text):
        return set((text or "").lower().split())

    best = set()
    for record, text in batch:
        found = []
        for other, its in store:
            x, y = words(text), words(its)
            if x and y and (score := len(x & y) / len(x | y)) >= threshold - 1e-9:
                found.append((-round(score, 6), other))
        best |= {(record, other, -score) for score, other in sorted(found)[:k]}
    return best


@pytest.mark.parametrize(("threshold", "hot"), [(0.3, 0), (0.3, 30), (0.55, 0), (0.8, 3), (0.3, 10**9)])
def test_extended_signatures_lose_and_repeat_nothing(threshold, hot, spark):
    batch, store = texts(1, 0, 60), texts(2, 1000, 70)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    found = [tuple(r) for r in match.similar_topk(*frames, k=200, threshold=threshold, hot=hot).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(batch, store, threshold, 200)


def test_a_hot_pair_of_words_is_not_paired_whole(spark):
    """Every text holds the same two rare-looking words; the longer signatures keep their lists short."""
    rows = [("batch" if i % 2 else "store", f"{i}", ["p", "q", *sorted(f"{c}{i // 4 * 7 % 200}" for c in "abcdefgh")]) for i in range(800)]
    sets = spark.createDataFrame(rows, "side string, head string, tokens array<string>")
    keyed = match._pair_signatures(sets, 0.6)
    assert keyed.groupBy("signature").count().agg({"count": "max"}).first()[0] == 800
    split = keyed.filter(keyed.signature == "p\u0001q")
    longer = match._extended(split, 0.6, 3)
    assert longer.groupBy("signature").count().agg({"count": "max"}).first()[0] <= 8


@pytest.mark.parametrize(("hot", "k"), [(0, 1), (0, 3), (20, 2)])
def test_the_best_under_hot_signatures(hot, k, spark):
    """Short lists of the best few per signature answer like every pair, ties included."""
    rng = random.Random(5)

    def people(first, size):
        common = ["main", "st", "apt", "1", "m2", "town"]
        return [(first + i, " ".join([f"u{rng.randrange(6)}", *rng.sample(common, rng.randrange(7))])) for i in range(size)]

    batch, store = people(0, 90), people(1000, 110)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    found = [tuple(r) for r in match.similar_topk(*frames, k=k, hot=hot).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(batch, store, 0.3, k)


@pytest.mark.parametrize("rest", [0, 2])
def test_texts_with_many_words_behind_a_long_signature(rest, spark, monkeypatch):
    monkeypatch.setattr(match, "_MOST_REST", rest)
    batch, store = texts(3, 0, 50), texts(4, 1000, 50)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    found = [tuple(r) for r in match.similar_topk(*frames, k=2, hot=0).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(batch, store, 0.3, 2)


def test_short_texts_under_hot_words_do_not_all_meet(spark):
    """Texts that share just two frequent words: each meets a few of them, not all."""
    rows = [("batch" if i % 2 else "store", i, [f"a{i}", "main", "st"]) for i in range(400)]
    sets = spark.createDataFrame(rows, "side string, head long, tokens array<string>")
    found = match._met_by_length(match._pair_signatures(sets, 0.3), 0.3, 2, 100, 5)
    assert found.count() == 200 * 5


def test_longer_texts_do_not_meet_under_a_single_hot_word(spark, monkeypatch):
    """Only partners of very short texts meet under one word; texts of six words share two."""
    formed, met = [], match._met

    def counted(left, right, *more, **named):
        formed.append(left.join(right, "signature").count())
        return met(left, right, *more, **named)

    monkeypatch.setattr(match, "_met", counted)
    rows = [(i, f"main st a{i // 4} b{i // 4} c{i} d{i}") for i in range(400)] + [(i, "main") for i in range(400, 440)]
    batch, store = ([r for r in rows if r[0] % 2 == side] for side in (0, 1))
    frames = [spark.createDataFrame(some, SCHEMA) for some in (batch, store)]
    found = {tuple(r) for r in match.similar_topk(*frames, k=2, hot=100).collect()}
    assert found == brute(batch, store, 0.3, 2)
    assert sum(formed) < 5_000


def test_words_of_one_side_make_no_signatures(spark, monkeypatch):
    """Only what both sides have can be shared; a text with too little of it meets nothing."""
    offered, signatures = [], match._pair_signatures

    def counted(sets, threshold):
        keyed = signatures(sets, threshold)
        offered.append(keyed.count())
        return keyed

    monkeypatch.setattr(match, "_pair_signatures", counted)
    words = "main st apt m2 town b7".split()
    batch = [(i, " ".join([*(f"{c}{i}" for c in "pqrstu"), *words[: i % 7]])) for i in range(70)]
    store = [(1000 + i, " ".join([*(f"{c}{i}" for c in "vwxyz"), *words[i % 3 : 6]])) for i in range(30)]
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    found = {tuple(r) for r in match.similar_topk(*frames, k=50).collect()}
    assert found == brute(batch, store, 0.3, 50) and found
    assert sum(offered) < 1_000


def nearest_length():
    """A scorer: minus the difference of the lengths."""

    def score(pairs: pa.RecordBatch) -> pa.Array:
        return pc.negate(pc.abs(pc.subtract(pairs.column("length"), pairs.column("other_length"))))

    return score


def brute_by_length(batch, store, k):
    best = set()
    for record, text in batch:
        others = [(abs(len(text) - len(its)), other) for other, its in store if brute([(record, text)], [(other, its)], 0.3, 1)]
        best |= {(record, other, -float(far)) for far, other in sorted(others)[:k]}
    return best


@pytest.mark.parametrize(("hot", "k"), [(0, 1), (0, 3), (20, 2), (10**9, 2)])
def test_the_best_by_a_scorer_of_traits(hot, k, spark):
    """Texts of equal traits score alike, so the best few of each answer like every pair, ties included."""
    rng = random.Random(6)

    def people(first, size):
        common = ["main", "st", "apt", "1", "m2", "town"]
        rows = [(first + i, " ".join([f"u{rng.randrange(6)}", *rng.sample(common, rng.randrange(7))])) for i in range(size)]
        return rows + [(first + size, rows[0][1]), (first + size + 1, "Main")]

    batch, store = people(0, 60), people(1000, 80)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    traits = {"length": F.length("text")}
    found = [tuple(r) for r in match.similar_topk(*frames, k=k, hot=hot, scorer=nearest_length(), traits=traits).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_by_length(batch, store, k)


def test_a_scorer_of_traits_does_not_see_all_pairs(spark, monkeypatch):
    """Texts that share just two frequent words: 200 by 200 pairs are similar, a few of each are scored."""
    scored, score_pairs = [], match.score_pairs

    def counted(pairs, scorer, needs, *more):
        assert needs == ["length", "other_length"]
        scored.append(pairs.count())
        return score_pairs(pairs, scorer, needs, *more)

    monkeypatch.setattr(match, "score_pairs", counted)
    rows = [(i, f"{'abc'[i % 3] * (i // 2 % 4 + 1)}{i} main st") for i in range(100, 500)]
    batch, store = ([r for r in rows if r[0] % 2 == side] for side in (0, 1))
    frames = [spark.createDataFrame(some, SCHEMA) for some in (batch, store)]
    found = {tuple(r) for r in match.similar_topk(*frames, k=2, hot=100, scorer=nearest_length(), traits={"length": F.length("text")}).collect()}
    assert found == brute_by_length(batch, store, 2)
    assert sum(scored) <= 200 * 4 * 2


def test_traits_need_a_scorer(spark):
    frame = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(ValueError, match="traits"):
        match.similar_topk(frame, frame, traits={"length": F.length("text")})


def test_a_rare_word_is_a_signature_by_itself(spark, monkeypatch):
    """Texts whose first shared word is rare are offered once under it, and not under its pairs with all words behind it."""
    offered, met = [], match._met

    def counted(left, right, *more, **named):
        offered.append(left.count() + right.count())
        return met(left, right, *more, **named)

    monkeypatch.setattr(match, "_met", counted)
    batch, store = ([(first + i, " ".join(f"{c}{i // 2}" for c in "abcdefgh") + " main st") for i in range(300)] for first in (0, 1000))
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (batch, store)]
    found = {tuple(r) for r in match.similar_topk(*frames, k=2).collect()}
    assert found == {(2 * i + a, 1000 + 2 * i + b, 1.0) for i in range(150) for a in range(2) for b in range(2)}
    assert offered[0] <= 2 * 150 * 8 and sum(offered) <= 5_000


def test_names_meet_in_several_goes(spark, monkeypatch):
    """Only names that share a form with another one meet under forms, however few stems are taken at once."""
    rng, grouped, real = random.Random(9), [], match._grouped
    rows = []
    for i in range(120):
        name = "".join(rng.choice("abcdefgh") for _ in range(9))
        rows += [(2 * i, name, f"u{i % 30}@x"), (2 * i + 1, name.replace("a", "b", 1) if i % 3 == 0 else f"zz{i}yy", f"u{i % 30}@x")]
    df = spark.createDataFrame(rows, "batch_record_id long, n string, ml_email_address string").selectExpr("batch_record_id", "n AS ml_first_name", "'l' AS ml_last_name", "ml_email_address")
    rules = [match.MatchRule(0.85, ["email", "name~"])]
    once = {tuple(r) for r in match.match_entities(df, rules=rules).select("batch_record_id", "MatchID", "ConfidenceLevel").collect()}

    def counted(keyed):
        grouped.append(keyed.count())
        return real(keyed)

    monkeypatch.setattr(match, "_grouped", counted)
    monkeypatch.setattr(match, "_NAMES_AT_ONCE", 60)
    assert {tuple(r) for r in match.match_entities(df, rules=rules).select("batch_record_id", "MatchID", "ConfidenceLevel").collect()} == once
    assert sum(r[1] is not None for r in once) >= 40 and len(grouped) == 4 and sum(grouped) < 12 * 120
