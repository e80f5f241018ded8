"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

A bin holds a source at most once and a duplicate cluster at most once. A document longer than a bin gives full
pieces, each a bin of its own, and one rest that is packed. Rows are dealt by hash to shards of about SHARD_ROWS
rows, so a task's memory is bounded whatever the table's size; bins don't span shards.

Within a shard rests are taken by size, largest first. Open bins are held by residual; below a residual by the
bitmap of the sources that they hold. A bit per occupied residual leads to the tightest one that fits;
if every bin there conflicts in source (known for the whole bitmap at once) or cluster, the search goes on to the
next larger residual, until the tightest compatible bin is found or a new one is opened.

Cases: null and empty texts have size 0 and still get a place; null sources are one source, null clusters
conflict with nothing; repeated rows conflict as copies do; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, word_count

CAPACITY, SHARD_ROWS = 1024, 4096


def best_fit(sizes, sources, clusters, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and start of each item of size <= capacity, in the given order. ``sources`` and ``clusters`` are small
    integers (a cluster of -1 conflicts with nothing)."""
    levels: dict[int, dict[int, list[int]]] = {}  # residual -> source bitmap -> bins
    occupied = 0  # bit r: some open bin has residual r
    residual: list[int] = []
    source_map: list[int] = []
    cluster_map: list[int] = []
    bins, starts = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        bit, mark = 1 << source, (1 << cluster) if cluster >= 0 else 0
        found, level = -1, size
        while found < 0:
            above = occupied >> level
            if not above:
                break
            level += (above & -above).bit_length() - 1
            for held, some in levels[level].items():
                if held & bit:
                    continue
                found = next((b for b in some if not cluster_map[b] & mark), -1)
                if found >= 0:
                    some.remove(found)
                    if not some:
                        del levels[level][held]
                    break
            if found < 0:
                level += 1
        if found < 0:
            found = len(residual)
            residual.append(capacity)
            source_map.append(0)
            cluster_map.append(0)
        elif not levels[level]:
            del levels[level]
            occupied &= ~(1 << level)
        bins.append(found)
        starts.append(capacity - residual[found])
        residual[found] -= size
        source_map[found] |= bit
        cluster_map[found] |= mark
        r = residual[found]
        levels.setdefault(r, {}).setdefault(source_map[found], []).append(found)
        occupied |= 1 << r
    return bins, starts


def _pack_shard(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rest", "doc_id", "cluster"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sources = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
        names = pdf["cluster"]
        again = names.notna() & names.duplicated(keep=False)  # only clusters met twice need a bit
        clusters = np.full(len(pdf), -1)
        clusters[again] = pd.factorize(names[again])[0]
        bins, starts = best_fit(pdf["rest"].tolist(), sources.tolist(), clusters.tolist(), capacity)
        packed = pd.DataFrame(
            {"doc_id": pdf["doc_id"], "part": pdf["full"], "n_words": pdf["rest"], "bin": bins, "start": starts}
        )[(pdf["rest"] > 0) | (pdf["full"] == 0)]
        n = int(pdf["full"].sum())
        whole = pdf.loc[pdf.index.repeat(pdf["full"])]
        first = (max(bins) + 1) if bins else 0
        full = pd.DataFrame(
            {
                "doc_id": whole["doc_id"],
                "part": whole.groupby(level=0).cumcount(),
                "n_words": capacity,
                "bin": np.arange(first, first + n),
                "start": 0,
            }
        )
        out = pd.concat([packed, full], ignore_index=True)
        out["shard"] = pdf["shard"].iloc[0]
        return out[["doc_id", "part", "n_words", "shard", "bin", "start"]]

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """(doc_id, part, n_words, shard, bin, start) of every piece of every row of ``docs``.

    ``cluster`` names a column of duplicate clusters; without it rows of equal text are one cluster.
    """
    group = F.col(cluster).cast("string") if cluster else F.xxhash64("text").cast("string")
    size = word_count(F.col("text"))
    items = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.when(F.col("text").isNotNull(), group).alias("cluster"),
        size.alias("size"),
    )
    items = keep(items, "pack-items")
    shards = max(1, -(-items.count() // SHARD_ROWS))
    items = items.select(
        "doc_id",
        "source",
        "cluster",
        F.floor(F.col("size") / capacity).cast("long").alias("full"),
        (F.col("size") % capacity).alias("rest"),
        # copies share a doc_id or a text; dealing by a random number would not be the same when a task is run again
        F.pmod(F.xxhash64("doc_id", "cluster", F.lit(17)), F.lit(shards)).cast("int").alias("shard"),
    )
    schema = "doc_id string, part long, n_words long, shard int, bin long, start long"
    out = items.groupBy("shard").applyInPandas(_pack_shard(capacity), schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
