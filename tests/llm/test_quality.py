"""Quality classifier: gradient, passages, held-out accuracy and odd rows."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest

from tabula.llm import quality as Q
from tests.conftest import SF_SMALL

from .data import frame, none, texts, words


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string, good string")


def small_bags(seed: int = 3):
    rng = np.random.default_rng(seed)
    of = np.repeat(np.arange(9), [1, 4, 2, 1, 7, 3, 1, 2, 5])
    return rng.normal(size=(len(of), 6)).astype(np.float32), of, rng.integers(0, 2, 9).astype(float)


def test_gradient_equals_differences():
    x, of, y = small_bags()
    model = Q.fit_attention(x, of, y, epochs=1)

    def loss() -> float:
        h = model.hidden(x)
        gate = np.tanh(h @ model.p["V"]) * Q._sigmoid(h @ model.p["U"])
        a, start = Q.softmax(gate @ model.p["w"], of)
        z = np.add.reduceat(a[:, None] * h, start) @ model.p["c"] + model.p["b"][0]
        return float(np.mean(np.log1p(np.exp(-z * (2 * y - 1)))))

    got = Q.gradient(model, x, of, y)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 7)):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert got[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-6), name


def test_attention_finds_the_passage_that_decides():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 12, 400)
    of, y = np.repeat(np.arange(400), n), rng.integers(0, 2, 400).astype(float)
    x = rng.normal(size=(len(of), 6)).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    x[first[y == 0], 2] += 6  # one passage in a bag tells
    model = Q.fit_attention(x, of, y, epochs=60)
    a, g = model.passages(x)
    w, start = Q.softmax(a, of)
    assert ((np.add.reduceat(w * g, start) + model.p["b"][0] > 0) == (y == 1)).mean() > 0.97
    assert w[first[(y == 0) & (n > 5)]].mean() > 0.5


def test_passages_do_not_depend_on_runs(monkeypatch):
    rows = [t for t in texts(n=10)] + ["\n  " + " ".join(words(random.Random(4), 900)) + " \n"]
    x, of = Q.describe([(t or "").encode() for t in rows])
    n = [max(1, -(-len((t or "").split()) // Q.PASSAGE_WORDS)) for t in rows]
    assert np.bincount(of, minlength=len(rows)).tolist() == n and x.shape == (sum(n), Q.WIDTH)
    assert np.isfinite(x).all()
    model = Q.fit_attention(x, of, np.arange(len(rows)) % 2.0, epochs=1)
    whole = model.scores(rows)
    monkeypatch.setattr(Q, "RUN_BYTES", 1500)
    assert len(list(Q._cut(rows[-1].encode()))) > 1
    assert model.scores(rows) == pytest.approx(whole, abs=1e-5)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
def test_held_out_accuracy(spark):
    from tabula.session import load

    sf = SF_SMALL.replace("0.001", "0.01")
    known = {r["doc_id"]: r["quality"] for r in load(spark, sf, "labels").collect()}
    from tabula.llm.queries import QUERIES

    rows = QUERIES["op11_quality"](spark, sf).collect()
    assert len(rows) == load(spark, sf, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and known.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) >= 0.95


def test_odd_rows(spark):
    rng = random.Random(2)
    good = [" ".join(words(rng, 80)) + "." for _ in range(40)]
    bad = [" | ".join(words(rng, 80)) + "$$$" for _ in range(40)]
    rows = good + bad + ["", None, " \n", good[0], bad[0], "word " * 300_000]
    ids = [*range(80), 100, 101, 102, 0, 40, None]
    marks = [(i, int(i < 40), 0, "x", "y") for i in range(80)] + [(None, 1, 0, "x", "y"), (5, None, 0, "x", "y"), (6, 7, 0, "x", "y")]
    docs = frame(spark, rows, ids=ids)
    got = Q.quality(docs, labels(spark, marks))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[0]) == 2 and by[0][0]["score"] == pytest.approx(by[0][1]["score"], abs=1e-6)
    assert by[None][0]["held_out"] is False
    assert by[100][0]["score"] == pytest.approx(by[101][0]["score"], abs=1e-6)
    held = [r for i in range(80) for r in by[i] if r["held_out"]]
    assert np.mean([(r["doc_id"] < 40) == (r["predicted"] == 1) for r in held]) > 0.9
    # held-out labels are never read
    turned = [(i, 1 - q if q in (0, 1) and i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else q, t, a, b) for i, q, t, a, b in marks]
    again = Q.quality(docs, labels(spark, turned)).collect()

    def order(found):
        return sorted((str(r["doc_id"]), round(r["score"], 4)) for r in found)

    assert order(again) == order(out)


@pytest.mark.parametrize("marks, score", [([], 0.0), ([(i, 1, 0, "", "") for i in range(20)], 1.0)])
def test_one_class_or_none(spark, marks, score):
    out = Q.quality(frame(spark, ["a b", None, ""]), labels(spark, marks)).collect()
    assert len(out) == 3 and all(r["score"] == pytest.approx(score, abs=1e-9) for r in out)


def test_empty_table(spark):
    marks = [(i, i % 2, 0, "", "") for i in range(20)]
    assert Q.quality(none(spark), labels(spark, marks)).count() == 0
