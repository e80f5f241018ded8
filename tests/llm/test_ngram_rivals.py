"""What the n-gram join compares: each list of a key's documents once, common keys in parts."""

from __future__ import annotations

from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from tabula.llm import ngram_join as J


def near_copies(spark):
    """Six documents of 200 words that differ in a few words at their ends, and two others."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words, *[f"x{i}_{j}" for j in range(110)]])) for i in range(6)]
    rows += [(10 + i, " ".join(f"y{i}_{j}" for j in range(200))) for i in range(2)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def lists(df):
    got = defaultdict(set)
    for r in df.collect():
        got[r["sig"], r["bx"], r["by"]].add((r["sid"], r["blk"]))
    return [(k[1:], frozenset(v)) for k, v in got.items()]


def test_each_list_of_documents_is_compared_once(spark):
    join = J._Join(near_copies(spark), 5)
    keyed = J.keep(join.keyed(), "keyed")
    alone = join.sets.select("sid", F.col("rep").alias("comp"))
    rivals = lists(join.rivals(keyed, alone))
    assert rivals and len(rivals) == len(set(rivals))
    # every list of more than three documents that share a key is among them
    shared = defaultdict(set)
    for r in keyed.collect():
        shared[r["sig"]] |= {r["sid"], r["first"]}
    assert {frozenset(v) for v in shared.values() if len(v) > 3} == {frozenset(s for s, _ in v) for _, v in rivals}


def test_second_round_has_the_rows_that_were_close(spark):
    join = J._Join(near_copies(spark), 5)
    sids = sorted(r["sid"] for r in join.sets.collect())[:4]
    rows = [(sig, 0, 0, 0, s, sids[0]) for sig in (1, 2) for s in sids] + [(3, 0, 0, 0, s, sids[0]) for s in sids[:2]]
    close = spark.createDataFrame(rows, "sig long, bx int, by int, blk int, sid long, other long")
    comp = {s: i // 2 for i, s in enumerate(sids)}  # the first two are one component by now
    node = spark.createDataFrame([(s, c) for s, c in comp.items()], "sid long, comp long")
    got = join.still_rivals(close, node).collect()
    assert sorted((r["sig"], r["sid"], r["comp"]) for r in got) == sorted((1, s, c) for s, c in comp.items())


def test_usual_counters_cut_no_key():
    text = " ".join(f"w{i}" for i in range(300))

    def parts(counts):
        run = J._keys(5, SimpleNamespace(value=counts), 10)
        return set(pd.concat(list(run(iter([pd.DataFrame({"text": [text]})]))))["part"])

    # with many documents every counter is larger than a block, by rare shingles alone
    assert parts(np.full(J.COUNTERS, 5000)) == {-1}
    few = np.zeros(J.COUNTERS, dtype=np.int64)
    few[J._slot(next(J.shingle_sets([text])))] = 5000
    assert min(parts(few)) >= 0
