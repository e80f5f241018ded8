"""Sharding by balanced label propagation.

Documents of equal text are linked. Each starts in the shard of its hash; in rounds, linked documents move to
the shard that holds most of their neighbours, as far as that shard's quota allows, so links end up uncut and
sizes even. Documents of one group are alike to the method, so the state is a table of counts by (group, shard):
a round is a join and aggregations over it, however many documents a group has. A group larger than a shard
moves to as many of its fullest shards as it fills.

A shard takes in a round as many documents as it has room for and as leave it in that round, so full shards
swap. One that can take none is passed over until documents have moved. Each move leaves fewer links cut, and
the rounds end when no shard can take any of the documents that would move.

The law is ``rows``: shard counts differ by at most one. Linked documents beyond a shard's quota, and all
documents without a copy, fill what is left of the quotas in hash order. Numbers within shards and groups come
from counts by hash prefix and a window inside a prefix, so no task orders a whole shard or a whole hot group.

Cases: null text has size 8 and crc 0 and is linked with nothing; empty texts are equal texts; repeated rows are
copies; fewer rows than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

SHARDS = 24
#: Share of a quota that linked documents may take while they move, if all of them fit into it.
FILL = 0.98
#: Groups above this size are numbered by hash prefix.
BIG_GROUP = 1_000


def _numbered(df: DataFrame, by: list[str], split: Column, out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... within ``by``, in the order of mark, doc_id; ``split`` tells where prefixes are used."""
    df = df.withColumn("__b", F.when(split, F.substring("mark", 1, 3)).otherwise(F.lit("")))
    counts = df.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    run = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(run), F.lit(0))).drop("__n")
    at = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("mark", "doc_id")) - 1
    return df.withColumn("__at", at).join(counts, [*by, "__b"]).withColumn(
        out, (F.col("__at") + F.col("__before")).cast("long")
    ).drop("__b", "__at", "__before")


def shares(asked: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The share of what is asked of each shard that may move: as much goes in as comes out, besides the free room.

    ``asked[a, b]`` is the number of documents that would go from a to b.
    """
    into = asked.sum(axis=0)
    share = (into > 0).astype(float)
    while True:
        can = np.maximum(free + asked @ share, 0) / np.maximum(into, 1)
        less = np.minimum(share, can)
        if (share - less).max(initial=0) < 1e-4:
            return less
        share = less


def _loads(counts: DataFrame, shards: int) -> list[int]:
    load = [0] * shards
    for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        load[r["shard"]] = r["n"]
    return load


def propagate(counts: DataFrame, quotas: list[int]) -> DataFrame:
    """Move counts (g, shard, n) towards the fullest shards of each group, until no move is left within the quotas."""
    shards, turn = len(quotas), 0
    load = _loads(counts, shards)
    # where linked documents need more than FILL, each shard takes its part of them
    limit = [max(int(q * FILL), -(-q * sum(load) // max(1, sum(quotas)))) for q in quotas]
    shut: set[int] = set()  # shards that could take none since the last move
    afresh = True  # no shard was shut at first since the last move

    def by_shard(values, shard: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in values]), shard + 1)

    while True:
        free = [x - y for x, y in zip(limit, load)]
        # a group wants its fullest open shards, as many as it fills; documents elsewhere go to one of them
        one = F.struct("n", F.xxhash64("g", "shard").alias("t"), "shard")
        want = counts.where(~F.col("shard").isin(shut)) if shut else counts
        want = want.groupBy("g").agg(F.sort_array(F.collect_list(one), asc=False).alias("open"), F.sum("n").alias("k"))
        fills = F.greatest(F.lit(1), F.floor(F.col("k") / float(max(1, *limit)))).cast("int")
        want = want.select("g", F.slice("open", F.lit(1), fills).alias("best"))
        moves = counts.join(want, "g", "left")
        pick = F.pmod(F.xxhash64("g", "shard", F.lit(turn)), F.size("best")).cast("int")
        there = F.exists("best", lambda x: x["shard"] == F.col("shard"))
        moves = moves.withColumn("to", F.when(F.col("best").isNotNull() & ~there, F.get("best", pick)))
        # from a fuller shard, which is shut, documents go as a whole
        fewer = F.col("to.n") >= F.col("n")
        small = F.col("n") * 20 <= by_shard(free, F.col("to.shard"))
        moves = moves.withColumn("fewer", fewer).withColumn("to", F.when(fewer | small, F.col("to.shard")))
        asked = np.zeros((shards, shards))
        for r in moves.where("to is not null").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():
            asked[r["shard"], r["to"]] = r["n"]
        share = shares(asked, np.array(free, dtype=float))
        enters = share * asked.sum(axis=0)
        stuck = {s for s in range(shards) if asked[:, s].any() and enters[s] < 1}
        if enters.sum() < 1:
            if stuck:
                shut |= stuck
            elif afresh:
                return counts
            else:
                shut, afresh = set(), True
            continue
        p, room = by_shard(share.tolist(), F.col("to")), by_shard(enters.tolist(), F.col("to"))
        chance = F.pmod(F.xxhash64("g", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        odds = F.pmod(F.xxhash64("g", "shard", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)  # rounds at random
        # small groups move whole or not at all, large ones in part
        gone = (
            F.when(F.col("to").isNull(), F.lit(0))
            .when(F.col("fewer") & (F.col("n") * 20 > room), F.least(F.col("n"), F.floor(F.col("n") * p + odds)))
            .when(chance < p, F.col("n"))
            .otherwise(F.lit(0))
            .cast("long")
        )
        moves = moves.withColumn("gone", gone)
        counts = keep(
            moves.select("g", "shard", (F.col("n") - F.col("gone")).alias("n"))
            .unionByName(moves.where("gone > 0").select("g", F.col("to").alias("shard"), F.col("gone").alias("n")))
            .groupBy("g", "shard")
            .agg(F.sum("n").alias("n"))
            .where("n > 0"),
            "shard-counts",
        )
        load, turn = _loads(counts, shards), turn + 1
        shut, afresh = stuck, not stuck


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: not of this law) and linked of every row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text", F.length(text))).alias("g"),
    )
    rows = keep(rows.withColumn("mark", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "text_crc32"))), "shard-rows")
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    groups = rows.where("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    groups = keep(groups, "shard-groups")
    home = F.pmod(F.xxhash64("mark"), F.lit(shards)).cast("int")
    linked = rows.join(groups, "g")
    counts = keep(linked.groupBy("g", home.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    counts = propagate(counts, quotas)
    upto = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.withColumn("hi", F.sum("n").over(upto)).withColumn("lo", F.col("hi") - F.col("n"))
    spans = spans.groupBy("g").agg(F.collect_list(F.struct("lo", "hi", "shard")).alias("spans"))  # one per shard at most
    placed = _numbered(linked, ["g"], F.col("k") > BIG_GROUP, "i").join(spans, "g")
    inside = F.filter("spans", lambda s: (s["lo"] <= F.col("i")) & (F.col("i") < s["hi"]))
    placed = placed.select("doc_id", "size", "text_crc32", "mark", F.element_at(inside, 1)["shard"].alias("shard"))
    placed = keep(_numbered(placed, ["shard"], F.lit(True), "slot"), "shard-placed")
    quota = F.element_at(F.array(*[F.lit(q) for q in quotas]), F.col("shard") + 1)
    kept = placed.where(F.col("slot") < quota).withColumn("linked", F.lit(True))
    taken = [0] * shards
    for r in kept.groupBy("shard").count().collect():
        taken[r["shard"]] = r["count"]
    single = rows.join(groups.select("g"), "g", "left_anti").select("doc_id", "size", "text_crc32", "mark").withColumn("linked", F.lit(False))
    over = placed.where(F.col("slot") >= quota).select("doc_id", "size", "text_crc32", "mark").withColumn("linked", F.lit(True))
    pool = _numbered(single.unionByName(over).withColumn("all", F.lit(0)), ["all"], F.lit(True), "i")
    first, bounds = 0, []
    for s in range(shards):
        bounds.append((first, first + quotas[s] - taken[s], s, taken[s] - first))
        first += quotas[s] - taken[s]
    steps = F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for x, c in zip(b, ("lo", "hi", "s", "shift"))]) for b in bounds])
    step = F.element_at(F.filter(steps, lambda b: (b["lo"] <= F.col("i")) & (F.col("i") < b["hi"])), 1)
    pool = pool.withColumn("step", step).select(
        "doc_id", "size", "text_crc32", "linked", F.col("step.s").cast("int").alias("shard"), (F.col("i") + F.col("step.shift")).alias("slot")
    )
    out = kept.select("doc_id", "size", "text_crc32", "linked", "shard", "slot").unionByName(pool)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "linked",
    )
