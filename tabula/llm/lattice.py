"""Near-duplicate embeddings by lattice hashing.

Each of TABLES tables projects a unit vector to eight dimensions and decodes it to the nearest point of the
E8 lattice; the vector lives in that cell and visits the PROBES neighbouring cells nearest to it. Vectors
that meet in a cell (one of them at home there) are verified by their cosine in double precision.

Equal vectors are one class. A pair is counted once: in the first table where it meets, and there in the cell
of the smaller id if both visit each other. So links are counted without sending pairs: a cell's task
sends sums, and edges that connect what it has linked. Cells of more than BLOCK_ROWS vectors are dealt out in
blocks, each task comparing two blocks.

Recall: by simulation a pair at cosine 0.9 meets with probability 0.95, at 0.95 with 0.999; tests hold the
result against brute force.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; only vectors
of equal length are compared; rows with a null id are returned without links; repeated rows link with each other;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, keep

TABLES, PROBES, SCALE, BLOCK_ROWS = 6, 4, 0.8, 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _even_point(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even coordinate sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(x))
    step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    near[rows, worst] += np.where(near.sum(axis=1) % 2 != 0, step, 0.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point: the closer of the even points and the even points shifted by one half."""
    a, b = _even_point(x), _even_point(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _names(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit name for each lattice point (doubled coordinates mixed with odd factors)."""
    h = np.full(points.shape[:-1], 0x9E3779B97F4A7C15 * (table + 1) % 2**64, dtype=np.uint64)
    whole = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    for i in range(8):
        h = (h ^ whole[..., i]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.astype(np.int64)


def cells(unit: np.ndarray, table: int) -> np.ndarray:
    """Names of the home cell (column 0) and of the visited cells of unit vectors."""
    rng = np.random.default_rng([table, unit.shape[1]])
    x = unit @ (rng.standard_normal((unit.shape[1], 8)) * SCALE) + rng.random(8)
    home = decode(x)
    side = np.argpartition(-((x - home) @ ROOTS.T), PROBES, axis=1)[:, :PROBES]
    return _names(np.concatenate([home[:, None, :], home[:, None, :] + ROOTS[side]], axis=1), table)


def _unit(vectors) -> np.ndarray:
    m = np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def _addresses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for dim, part in pdf.groupby(pdf["embedding"].map(len)):
            unit = _unit(part["embedding"])
            for t in range(TABLES):
                names = cells(unit, t)
                yield pd.DataFrame(
                    {
                        "dim": np.int32(dim),
                        "tab": np.int32(t),
                        "cell": names.ravel(),
                        "rep": np.repeat(part["rep"].to_numpy(), names.shape[1]),
                        "home": np.tile([True] + [False] * PROBES, len(part)),
                    }
                )


def _first_meeting(unit: np.ndarray, ids: np.ndarray, i: np.ndarray, j: np.ndarray, tab: int, cell: int) -> np.ndarray:
    """Whether this table and cell is where each pair (i, j) is counted."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = at[: len(i)], at[len(i) :]
    ok = np.ones(len(i), dtype=bool)
    for t in range(tab + 1):
        names = cells(unit[used], t)
        if t < tab:
            met = (names[b] == names[a][:, :1]).any(axis=1) | (names[a] == names[b][:, :1]).any(axis=1)
            ok &= ~met
        else:
            b_at_a, a_at_b = (names[b] == names[a][:, :1]).any(axis=1), (names[a] == names[b][:, :1]).any(axis=1)
            small_a = ids[used[a]] < ids[used[b]]
            at_a = b_at_a & (~a_at_b | small_a)
            ok &= np.where(at_a, names[a][:, 0], names[b][:, 0]) == cell
    return ok


def _tree(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position linked to each of n positions by the pairs (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _verify(threshold: float):
    def one(g: pd.DataFrame) -> pd.DataFrame | None:
        if len(g) < 2 or not g["home"].any():
            return None
        g = g.sort_values("rep", kind="stable")
        ids, mult, home = g["rep"].to_numpy(), g["mult"].to_numpy(), g["home"].to_numpy()
        unit, blk = _unit(g["embedding"]), g["blk"].to_numpy()
        sim = unit @ unit.T >= threshold
        sim &= home[:, None] | home[None, :]
        bx, by = g["bx"].iloc[0], g["by"].iloc[0]
        if bx != by:
            sim &= blk[:, None] != blk[None, :]
        i, j = np.nonzero(np.triu(sim, 1))
        if not len(i):
            return None
        low = _tree(len(ids), i, j)
        linked = np.unique(np.concatenate([i, j]))
        first = _first_meeting(unit, ids, i, j, int(g["tab"].iloc[0]), g["cell"].iloc[0])
        i, j = i[first], j[first]
        n = np.bincount(i, weights=mult[j], minlength=len(ids)) + np.bincount(j, weights=mult[i], minlength=len(ids))
        return pd.DataFrame({"rep": ids[linked], "n": n[linked].astype(np.int64), "low": ids[low[linked]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, rest = ["dim", "tab", "cell", "bx", "by"], None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            k = pdf[keys].to_numpy()
            starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
            done = [one(pdf.iloc[a:b]) for a, b in zip(starts, starts[1:])]
            rest = pdf.iloc[starts[-1] :] if len(starts) else None
            if done := [x for x in done if x is not None]:
                yield pd.concat(done)
        if rest is not None and (last := one(rest)) is not None:
            yield last

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``."""
    # floats stay as they are, all other numbers are doubles: nothing is rounded before the comparison
    kind = vectors.schema[vec_col].dataType
    kind = "array<float>" if kind == T.ArrayType(T.FloatType(), kind.containsNull) else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("embedding"))
    wide = F.col("embedding").cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists(wide, lambda x: x != 0)
    rows = rows.withColumn("key", F.when(valid, F.xxhash64("embedding")))
    classes = rows.where("key is not null").groupBy("key", "embedding").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult")
    )
    classes = keep(classes, "lattice-classes")
    homes = keep(
        classes.select("rep", "embedding").mapInPandas(
            _addresses, "dim int, tab int, cell long, rep long, home boolean"
        ),
        "lattice-cells",
    )
    size = homes.groupBy("dim", "tab", "cell").agg(
        F.count(F.lit(1)).alias("k"), F.max("home").alias("any_home")
    ).where("k > 1 and any_home").drop("any_home")
    met = homes.join(size, ["dim", "tab", "cell"])
    met = met.withColumn("blocks", F.ceil(F.col("k") / float(BLOCK_ROWS)).cast("int"))
    met = met.withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("bx", F.least("blk", "other")).withColumn("by", F.greatest("blk", "other"))
    met = met.select("dim", "tab", "cell", "bx", "by", "blk", "home", "rep").join(classes.select("rep", "mult", "embedding"), "rep")
    keys = ["dim", "tab", "cell", "bx", "by"]
    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    found = keep(dealt.mapInPandas(_verify(threshold), "rep long, n long, low long"), "lattice-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comps = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    result = (
        classes.join(counts, "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key",
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.join(result, ["key", "embedding"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
