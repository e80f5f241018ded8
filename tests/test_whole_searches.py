"""The label experiments search every candidate over its whole grid and five folds."""

from __future__ import annotations

import pytest

from tabula.catalog import models
from tabula.operators import model as ML

ENTITY = ("id long, cohort string, balance double, segment string, n_orders double, share_finished double, status string, "
          "sig_a double, sig_b string, mean_price double, has_urgent int, has_high int")


def entities(spark):
    rows = [
        (i, f"c{i % 2}", float(i * 37 % 101), "AB"[i // 2 % 2], float(i % 9), i % 4 / 4, "Positive" if i % 3 else "negative",
         i % 5 / 10, f"['{i % 7 / 2}']", float(i * 53 % 97), i // 2 % 2, i // 4 % 2)
        for i in range(80)
    ]
    return spark.createDataFrame(rows, ENTITY).coalesce(1)


@pytest.mark.parametrize("query", [
    models.q_loco_multi_output, models.q_loco_multilabel,
])
def test_label_experiments_search_whole_grids(spark, monkeypatch, query):
    """The search itself is replaced by a record of what it was given: 200 trees to depth 30 take too long here."""
    searched = []

    def record(df, cols, cand, labels, fold_col, parallelism, frames, scoring):
        searched.append((cand.name, cand.weighted, cand.grid, len(frames.folds), len(labels)))
        return 0.5, {"numTrees": 2, "maxDepth": 2}

    monkeypatch.setattr(models, "entities", lambda spark, sf: entities(spark))
    monkeypatch.setattr(ML, "search_grid_per_label", record)
    rows = query(spark, "unused").collect()
    assert [r["selected_model"] for r in rows] == ["random_forest_per_label"] * 2
    wanted = [("random_forest", False, ML.RF_GRID), ("random_forest_balanced", True, ML.RF_GRID), ("boosted_trees", False, ML.GBT_GRID)]
    for found in wanted:
        assert searched.count((*found, 5, 2)) == 2  # once a cohort
    assert len(searched) == 6
