"""The registered evaluations run the operators' whole job."""

import pytest

from tidewatch.operators import detectors, evaluation, scoring
from tidewatch.plans import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["injection_recall", "precision_at_sites"])
def test_every_strength_with_the_whole_forest(spark, monkeypatch, name):
    grown, forest = [], detectors.isolation_forest_score

    def seen(*args, trees=detectors.TREES, **more):
        grown.append(trees)
        return forest(*args, trees=2, **more)  # few trees: what is asked for counts here

    monkeypatch.setattr(detectors, "isolation_forest_score", seen)
    monkeypatch.setattr(queries, "_done", {})
    rows = queries.QUERIES[name](spark, SF).collect()
    assert {r["strength"] for r in rows} == set(evaluation.STRENGTHS) == {3.0, 6.0, 12.0, 24.0}
    assert grown == [detectors.TREES] * 4 == [300] * 4
    assert set(scoring.METHODS) <= set(rows[0].asDict())
