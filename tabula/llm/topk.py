"""Exact top-k search by inner product: three phases with a uniform threshold.

Dimensions are cut into M blocks that play the part of the nodes of the threshold algorithm: each yields a
list of partial scores. Candidates are packed into chunks of about CHUNK_ROWS rows and queries into chunks
of about QUERY_ROWS; each (query chunk, candidate chunk) pair is one row of work, so no task holds more than
one pair of chunks and the work spreads over all pairs.

Phase 1 gathers the head of each block's list in each chunk; the k-th best total among the rows so gathered
is a safe cutoff tau. Phase 2 hands tau to every chunk pair: a row whose total reaches tau has a partial
score of at least tau / M in some block, so only such rows are collected. Phase 3 resolves their totals
exactly and keeps the k best (ties to the smaller id).

Cases: vectors that are null, hold a null or a non-finite component, and rows with a null id take no part;
only vectors of equal length are compared; rows that repeat a query's id are the query's own; fewer than k
candidates give all of them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

CHUNK_ROWS, QUERY_ROWS, BLOCKS = 2048, 256, 4


def quantised(vectors: DataFrame, id_col: str, vec_col: str, factor: int = 256) -> DataFrame:
    """(id, v): floor(factor * x) of each component as a long, for valid vectors only."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    df = df.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    return df.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(factor))).cast("long")).alias("v"))


def _packed(df: DataFrame, rows: int, key: str, salt: int) -> DataFrame:
    """Chunks of about ``rows`` vectors of one length: (dim, key, n_key, ids, vals)."""
    count = df.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / float(rows)).cast("int").alias(f"n_{key}"))
    df = df.withColumn("dim", F.size("v")).join(count, "dim")
    df = df.withColumn(key, F.pmod(F.xxhash64("id", F.lit(salt)), F.col(f"n_{key}")).cast("int"))
    packed = df.groupBy("dim", key, f"n_{key}").agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    return packed.select(
        "dim", key, f"n_{key}", F.transform("rows", lambda r: r["id"]).alias(f"{key}_ids"),
        F.flatten(F.transform("rows", lambda r: r["v"])).alias(f"{key}_vals"),
    )


def _partials(q: np.ndarray, c: np.ndarray, m: int) -> list[np.ndarray]:
    """Integer partial scores of each block; double arithmetic where it is exact, long or object otherwise."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    kind = np.float64 if top < 2**53 else np.int64 if top < 2**62 else object
    q, c = q.astype(kind), c.astype(kind)
    edges = [round(i * q.shape[1] / m) for i in range(m + 1)]
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges, edges[1:])]


def _chunks(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    qi, ci = np.asarray(row.q_ids, dtype=np.int64), np.asarray(row.c_ids, dtype=np.int64)
    q = np.asarray(row.q_vals, dtype=np.int64).reshape(len(qi), row.dim)
    c = np.asarray(row.c_vals, dtype=np.int64).reshape(len(ci), row.dim)
    return qi, ci, q, c


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score down, id up."""
    return np.lexsort((ids, -scores))[:k]


def _gather(k: int, m: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                qi, ci, q, c = _chunks(row)
                parts = _partials(q, c, m)
                out = []
                for i, own in enumerate(qi):
                    heads = [np.argpartition(-p[i], min(k, len(ci) - 1))[: k + 1] for p in parts]
                    seen = np.unique(np.concatenate(heads))
                    seen = seen[ci[seen] != own]
                    total = sum(p[i, seen] for p in parts)
                    best = _best(ci[seen], total, k)
                    out.append(pd.DataFrame({"q_id": own, "id": ci[seen][best], "score": total[best].astype(np.int64)}))
                if out:
                    yield pd.concat(out)

    return run


def _collect(k: int, m: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                qi, ci, q, c = _chunks(row)
                tau = np.asarray([np.nan if t is None else t for t in row.tau], dtype=np.float64)
                parts = _partials(q, c, m)
                out = []
                for i, own in enumerate(qi):
                    if np.isnan(tau[i]):
                        near = np.arange(len(ci))
                    else:
                        near = np.flatnonzero(np.logical_or.reduce([p[i] >= tau[i] / m for p in parts]))
                    near = near[ci[near] != own]
                    total = sum(p[i, near] for p in parts)
                    if not np.isnan(tau[i]):
                        reach = total >= tau[i]
                        near, total = near[reach], total[reach]
                    best = _best(ci[near], total, k)
                    out.append(pd.DataFrame({"q_id": own, "id": ci[near][best], "score": total[best].astype(np.int64)}))
                if out:
                    yield pd.concat(out)

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(q_id, rank, id, score): the ``k`` best rows for each row where ``is_query`` (of ``id``) holds."""
    rows = keep(quantised(vectors, id_col, vec_col), "topk-rows")
    queries = rows.where(is_query).dropDuplicates(["id"])
    cands = keep(_packed(rows, CHUNK_ROWS, "c", 11), "topk-chunks")
    asked = keep(_packed(queries, QUERY_ROWS, "q", 13), "topk-queries")

    def pairs(asked: DataFrame) -> DataFrame:
        n_q = asked.select("dim", "n_q").distinct()
        n_c = cands.select("dim", "n_c").distinct()
        c = cands.join(n_q, "dim").withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).drop("n_q", "n_c")
        q = asked.join(n_c, "dim").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("n_c") - 1))).drop("n_q", "n_c")
        return c.join(q, ["dim", "q", "c"])

    schema = "q_id long, id long, score long"
    heads = pairs(asked).mapInPandas(_gather(k, BLOCKS), schema)
    tau = _ranked(heads.distinct(), k).groupBy("q_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    tau = tau.select("q_id", F.when(F.col("n") >= k, F.col("low")).alias("tau"))
    flat = asked.select("dim", "q", F.posexplode("q_ids").alias("at", "q_id")).join(tau, "q_id", "left")
    cut = flat.groupBy("dim", "q").agg(F.array_sort(F.collect_list(F.struct("at", "tau"))).alias("t"))
    cut = cut.select("dim", "q", F.transform("t", lambda x: x["tau"]).alias("tau"))
    told = keep(asked.join(cut, ["dim", "q"]), "topk-told")
    return _ranked(pairs(told).mapInPandas(_collect(k, BLOCKS), schema), k).select("q_id", "rank", "id", "score")
