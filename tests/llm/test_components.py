"""Connected components: few rounds, few tasks, results as of a plain search."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.llm import common as C


def plain(edges):
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            low[max(a, b)] = min(a, b)
    return {x: root(x) for x in low}


def shapes():
    rng = random.Random(3)
    order = rng.sample(range(60), 60)
    chain = list(zip(order, order[1:]))
    hubs = [(999, i) for i in range(100, 130)] + [(90, i) for i in range(1000, 1030)] + [(101, 1005)]
    sparse = [(rng.randrange(-3000, -2940), rng.randrange(-3000, -2940)) for _ in range(28)]
    return [*chain, *hubs, *sparse, (5007, 5007), (5001, 5002), (5002, 5001), (5001, 5002), (None, 3), (4, None)]


@pytest.mark.parametrize("part", [25, 1 << 18])
def test_components_by_plain_search(spark, monkeypatch, part):
    monkeypatch.setattr(C, "PART_EDGES", part)
    df = spark.createDataFrame(shapes(), "a long, b long").repartition(7)
    got = C.components(df).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == plain(shapes())
    assert C.components(df.where("a is null")).count() == 0


def test_stars_in_bounded_parts(monkeypatch):
    edges = [(a, b) for a, b in shapes() if a is not None and b is not None and a != b]
    pdf = pd.DataFrame([(max(e), min(e)) for e in edges], columns=["u", "v"])
    monkeypatch.setattr(C, "PART_EDGES", 10)
    out = list(C._stars(pdf.iloc[i : i + 4] for i in range(0, len(pdf), 4)))
    assert max(map(len, out)) <= 12 and (pd.concat(out)["u"] > pd.concat(out)["v"]).all()
    assert plain(pd.concat(out).itertuples(index=False)) == plain(edges)


def test_tables_written_are_few(spark, monkeypatch):
    """The driver keeps what it knows of each round's tasks, so a chain in any order must not take a round per link."""
    written, keep = [], C.keep
    monkeypatch.setattr(C, "keep", lambda df, tag: written.append(tag) or keep(df, tag))
    order = random.Random(5).sample(range(400), 400)
    df = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long").repartition(7)
    assert C.components(df).select("component").distinct().count() == 1
    assert len(written) <= 2
    # links found before are handed on as stars, which are done
    del written[:]
    stars = spark.range(1, 1000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert C.components(stars).count() == 1000 and len(written) == 1
