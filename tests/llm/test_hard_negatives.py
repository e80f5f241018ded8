"""Hard-negative mining against all inner products, and the packing against plain sums."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import hard_negatives as H

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        # names that the operator uses inside
        T.StructField("row", T.StringType()),
        T.StructField("rows", T.StringType()),
        T.StructField("positives", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "r", "s", "p") for i, v, lab in rows], SCHEMA).repartition(3)


def plain(rows, n_pos=5, n_neg=10):
    ok = [
        (i, [int(np.floor(256 * x)) for x in v], lab)
        for i, v, lab in rows
        if None not in (i, v, lab) and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for k, (i, a, lab) in enumerate(ok):
        if i % 3:
            continue
        score = [(sum(x * y for x, y in zip(a, c)), j, m) for n, (j, c, m) in enumerate(ok) if n != k and len(c) == len(a)]
        best = sorted(score, key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in best if s[2] == lab][:n_pos]:
            near = [s for s in best if s[2] != lab and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(near[:n_neg], 1)]
    return sorted(out)


def vectors(seed: int, n: int, dim: int, size: float = 1.0):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(dim)]
    return [(i, [size * (0.6 * b + rng.gauss(0, 0.5)) for b in base], 7 if i % 3 else rng.randint(0, 4)) for i in range(n)]


def odd():
    rows = vectors(2, 70, 8)
    rows += [(i, v, 9) for i, v, _ in rows[:6]]  # ids that repeat, with another label
    rows += [rows[9]] * 8  # rows that repeat
    rows += [(200 + i, rows[9][1], i % 2) for i in range(30)]  # ties
    rows += [(300, None, 1), (303, [None] * 8, 1), (306, [float("nan")] * 8, 1), (309, [float("inf")] * 8, 1)]
    rows += [(None, rows[0][1], 1), (312, rows[0][1], None), (315, [], 1), (318, [], 2), (-3, [0.0] * 8, 1)]
    return rows + [(400 + i, [1.0, 0.5 + i / 100], i % 2) for i in range(12)]  # another length


@pytest.mark.parametrize("rows", [vectors(1, 300, 16), vectors(3, 80, 5, 1e4), vectors(4, 60, 5, 3e6), odd()])
def test_equals_all_products(spark, monkeypatch, rows):
    monkeypatch.setattr(H, "CHUNK_ROWS", 40)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 16)
    got = H.hard_negatives(table(spark, rows), F.col("id") % 3 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_empty_table(spark):
    got = H.hard_negatives(table(spark, []), F.lit(True))
    assert got.count() == 0
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("bound, width", [(1, 2), (100, 4), (10**6, 8), (10**12, 11)])
def test_packed_scores_are_exact(bound, width):
    rng = np.random.default_rng(5)
    v = rng.integers(-bound, bound + 1, size=(600, 16))
    packed = H.Packed(v, bound)
    assert packed.width == width
    for a in v[:3]:
        assert [int(s) for s in packed.scores(a)] == [int(s) for s in v.astype(object) @ a.astype(object)]
