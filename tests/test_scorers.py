"""The contract of custom scorers, and what they decide."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from kinloom.operators import match
from kinloom.operators.scorers import checked, score_pairs


@pytest.mark.parametrize("scores", [[1.0], [1.0, None], [1.0, float("nan")], [1.0, float("inf")]])
def test_bad_scores_are_refused(scores):
    with pytest.raises(ValueError, match="scorer"):
        checked(pa.array(scores, pa.float64()), 2)


def test_pairs_keep_their_columns(spark):
    pairs = spark.createDataFrame([(1, "a", "x"), (2, "bb", None)], "id long, a string, b string")
    found = score_pairs(pairs, lambda batch: pc.utf8_length(batch.column("a")), ["a"])
    assert sorted(map(tuple, found.collect())) == [(1, "a", "x", 1.0), (2, "bb", None, 2.0)]
    assert score_pairs(pairs.limit(0), lambda batch: pc.utf8_length(batch.column("a")), ["a"]).count() == 0
    with pytest.raises(ValueError, match="lack"):
        score_pairs(pairs, lambda batch: batch.column("c"), ["c"])
    with pytest.raises(Exception, match="the scorer returned"):
        score_pairs(pairs, lambda batch: pa.array([1.0] * 5), ["a"]).collect()


def test_entities_by_the_links_a_scorer_takes(spark):
    """Equal e-mail and phone link four records; the scorer wants equal birth dates, or none."""
    rows = [(1, "a@x", "55", "Ann", "Lee", "d1"), (2, "a@x", "55", "Bob", "Ray", "d1"), (3, "a@x", "55", "Cy", "Poe", "d2"), (4, "a@x", "55", "Cy", "Poe", "d2"), (5, "z@x", "1", "Z", "Z", "d1")]
    names = "batch_record_id long, ml_email_address string, ml_phone string, ml_first_name string, ml_last_name string, ml_birth_date string"
    frame = spark.createDataFrame(rows, names)

    def same_birth(batch: pa.RecordBatch) -> pa.Array:
        return pc.fill_null(pc.equal(batch.column("birth"), batch.column("other_birth")), False).cast(pa.int8())

    def entities(**more):
        return {r.batch_record_id: (r.MatchID, r.ConfidenceLevel) for r in match.match_entities(frame, **more).collect()}

    assert entities() == {1: (1, 1.0), 2: (1, 1.0), 3: (1, 1.0), 4: (1, 1.0), 5: (None, None)}
    assert entities(scorer=same_birth) == {1: (1, 1.0), 2: (1, 1.0), 3: (3, 1.0), 4: (3, 1.0), 5: (None, None)}
    assert entities(scorer=lambda b: pa.array([0.0] * b.num_rows)) == {1: (None, None), 2: (None, None), 3: (3, 1.0), 4: (3, 1.0), 5: (None, None)}
