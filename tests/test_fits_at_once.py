"""The ten fits of a regression forest's grid over five folds run side by side on twelve cores."""

from __future__ import annotations

import threading
from types import SimpleNamespace

from tabula.operators import model as ML


def cores(n):
    return SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=n))


def test_all_fits_of_a_search_meet(spark, monkeypatch):
    meet = threading.Barrier(10, timeout=30)
    fitted = SimpleNamespace(fit=lambda rows: meet.wait())
    at_once = getattr(ML, "fits_at_once", None)
    monkeypatch.setattr(ML, "fits_at_once", lambda _: at_once(cores(12)), raising=False)
    monkeypatch.setattr(ML, "with_params", lambda *a, **k: fitted)
    monkeypatch.setattr(ML, "trees_of", lambda *a: None)
    monkeypatch.setattr(ML, "stage_scores", lambda trees, rows, label, stages: [float(n + (d or 0)) for n, d in stages])
    frames = SimpleNamespace(folds=[ML.Fold(None, None, {}) for _ in range(5)], train=lambda *a: None)
    score, point = ML.search_grid(spark.range(1), ["x"], ML.regression_candidates("y")[1], "regression", "fold", "y", frames=frames)
    assert score == 230 and point == {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 1}


def test_small_sessions_run_eight():
    assert [ML.fits_at_once(cores(n)) for n in (1, 4, 8, 12)] == [8, 8, 12, 18]
