"""Hard-negative mining by exact inner products, several candidates in one wide integer (Kronecker packing).

Components are integers. Those of ``FIELDS`` candidates are biased to be non-negative and set into separated fields of
one wide integer per dimension. An anchor's biased component times that integer multiplies all of them at once; the
sum over the dimensions holds every candidate's sum of products in its own field, since a field is wide enough for
dimensions x (largest biased component) squared. Taking the biases' share away gives the exact scores:
sum (a + B)(c + B) = sum a c + B sum a + B sum c + dim B B.

Anchors are packed into chunks of about ANCHOR_ROWS, candidates of about CHUNK_ROWS, whatever their labels, so labels
of any number and size give even chunks; each pair of chunks is one row of work. The first pass gives each chunk's
best rows of the anchor's label, of which the best are its positives; the second, told the positives' scores, gives
each chunk's best rows of other labels that lie within a positive's bounds. Both send at most a fixed number of rows a
pair of anchor and chunk.

Cases: rows with a null label, id or vector, or with a null or non-finite component take no part; only vectors of
equal length are compared; rows that repeat an id are rows of their own (each may be an anchor, a positive and a
negative of the others); an anchor with no other row of its label has no result, nor has a positive with no negative
within its bounds; an empty table gives no rows; scores must fit a long, at any size the arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

CHUNK_ROWS, ANCHOR_ROWS, FIELDS = 2048, 256, 256


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, label: Column, factor: int = 256) -> DataFrame:
    """(row, id, label, v): floor(factor * x) of each component, of rows that take part; ``row`` tells repeats apart."""
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("x")
    )
    df = df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad)
    whole = F.transform("x", lambda x: F.floor(x * F.lit(float(factor))).cast("long"))
    return df.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v"))


def chunks(rows: DataFrame, size: int, at: str, salt: int) -> DataFrame:
    """Rows (with ``v``) of one length by hash in chunks of about ``size``: (dim, at, n_at, rows)."""
    own = rows.columns
    dim = F.size("v").alias("dim")
    count = rows.groupBy(dim).agg(F.ceil(F.count(F.lit(1)) / float(size)).cast("int").alias(f"n_{at}"))
    rows = rows.select("*", dim).join(count, "dim")
    rows = rows.withColumn(at, F.pmod(F.xxhash64("row", F.lit(salt)), F.col(f"n_{at}")).cast("int"))
    return rows.groupBy("dim", at, f"n_{at}").agg(F.collect_list(F.struct(*own)).alias("rows"))


def field_bytes(dim: int, bias: int) -> int:
    """Bytes of a field that holds any sum of ``dim`` products of biased components (0 to 2 bias)."""
    need = max(dim, 1) * (2 * bias) ** 2
    return next((n for n in (2, 4, 8) if need < 1 << (8 * n)), (need.bit_length() + 7) // 8)


def pack(v: np.ndarray, bias: int, width: int) -> list[int]:
    """For each dimension one integer with the biased components of all rows of ``v``, ``width`` bytes a field."""
    if width <= 8:
        cells = np.ascontiguousarray((v + bias).T).astype(f"<u{width}")
        return [int.from_bytes(c.tobytes(), "little") for c in cells]
    return [sum((int(x) + bias) << (8 * width * k) for k, x in enumerate(col)) for col in v.T]


def unpack(total: int, n: int, width: int) -> np.ndarray:
    """The ``n`` fields of an integer."""
    raw = total.to_bytes(n * width, "little")
    if width <= 8:
        return np.frombuffer(raw, dtype=f"<u{width}")
    return np.array([int.from_bytes(raw[i : i + width], "little") for i in range(0, len(raw), width)], dtype=object)


class Packed:
    """Candidates as wide integers, ``FIELDS`` a group."""

    def __init__(self, v: np.ndarray, bias: int):
        self.dim, self.bias = v.shape[1], bias
        self.width = field_bytes(self.dim, bias)
        # the bounds of a positive are compared as 100 times a score
        self.kind = np.int64 if self.width <= 4 else object
        self.sums = [int(s) for s in v.astype(object).sum(axis=1)] if self.kind is object else v.sum(axis=1)
        self.sums = np.asarray(self.sums, dtype=self.kind)
        self.groups = [(min(FIELDS, len(v) - i), pack(v[i : i + FIELDS], bias, self.width)) for i in range(0, len(v), FIELDS)]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of ``anchor`` with all candidates."""
        biased = [int(a) + self.bias for a in anchor]
        got = [unpack(sum(map(mul, wide, biased)), n, self.width).astype(self.kind) for n, wide in self.groups]
        own = self.bias * sum(biased)  # bias * (sum a + dim * bias)
        return np.concatenate(got) - own - self.bias * self.sums


def best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` best by score down, id up."""
    if len(ids) > 8 * n and scores.dtype != object:
        low = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= low)
        return near[np.lexsort((ids[near], -scores[near]))[:n]]
    return np.lexsort((ids, -scores))[:n]


def _rows(cells) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row, ids, label = (np.array([c[k] for c in cells], dtype=np.int64) for k in ("row", "id", "label"))
    return row, ids, label, np.array([c["v"] for c in cells], dtype=np.int64).reshape(len(cells), -1)


def _positives(bias: int, n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for anchors, cands in zip(pdf["a_rows"], pdf["rows"]):
                row, ids, label, v = _rows(cands)
                packed, out = Packed(v, bias), []
                for a in anchors:
                    mine = np.flatnonzero((label == a["label"]) & (row != a["row"]))
                    if len(mine):
                        score = packed.scores(np.asarray(a["v"]))[mine]
                        at = best(ids[mine], score, n)
                        out += [(a["row"], row[mine[i]], ids[mine[i]], int(score[i])) for i in at]
                yield pd.DataFrame(out, columns=["a_row", "p_row", "p_id", "p_score"])

    return run


def _negatives(bias: int, n: int, low: int, high: int, scale: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for anchors, cands in zip(pdf["a_rows"], pdf["rows"]):
                row, ids, label, v = _rows(cands)
                packed, out = Packed(v, bias), []
                for a in anchors:
                    other = np.flatnonzero(label != a["label"])
                    score = packed.scores(np.asarray(a["v"]))[other] if len(other) else other
                    for p in a["positives"]:
                        p_score = int(p["p_score"])
                        fits = np.flatnonzero((scale * score >= low * p_score) & (scale * score <= high * p_score))
                        near = other[fits]
                        at = best(ids[near], score[fits], n)
                        out += [
                            (a["row"], a["id"], p["p_row"], p["p_id"], p_score, ids[near[i]], int(score[fits][i])) for i in at
                        ]
                yield pd.DataFrame(
                    out, columns=["a_row", "anchor_id", "p_row", "positive_id", "positive_score", "negative_id", "negative_score"]
                )

    return run


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 100,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row where ``is_anchor``
    (of ``id``) holds and each of its ``n_positives`` best rows of the same label, the ``n_negatives`` best rows of
    other labels with low * positive_score <= scale * negative_score <= high * positive_score."""
    label = F.col("label") if label is None else label
    rows = keep(integer_vectors(vectors, id_col, vec_col, label), "negatives-rows")
    bias = rows.select(F.array_max(F.transform("v", lambda x: F.abs(x))).alias("m")).agg(F.max("m")).first()[0] or 1
    cands = keep(chunks(rows, CHUNK_ROWS, "c", 17), "negatives-chunks")
    wanted = keep(rows.where(is_anchor), "negatives-anchors")

    def pairs(anchors: DataFrame) -> DataFrame:
        """Every chunk of anchors beside every chunk of candidates of equal length."""
        packed = keep(chunks(anchors, ANCHOR_ROWS, "a", 19).withColumnRenamed("rows", "a_rows"), "negatives-asked")
        n_c, n_a = cands.select("dim", "n_c").distinct(), packed.select("dim", "n_a").distinct()
        a = packed.join(n_c, "dim").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("n_c") - 1)))
        c = cands.join(n_a, "dim").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)))
        return a.select("dim", "a", "c", "a_rows").join(c.select("dim", "a", "c", "rows"), ["dim", "a", "c"])

    found = pairs(wanted).select("a_rows", "rows").mapInPandas(
        _positives(bias, n_positives), "a_row long, p_row long, p_id long, p_score long"
    )
    order = Window.partitionBy("a_row").orderBy(F.col("p_score").desc(), "p_id", "p_row")
    found = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= n_positives)
    lists = found.groupBy("a_row").agg(F.collect_list(F.struct("p_row", "p_id", "p_score")).alias("positives"))
    told = keep(wanted.join(lists.withColumnRenamed("a_row", "row"), "row"), "negatives-told")
    schema = (
        "a_row long, anchor_id long, p_row long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    found = pairs(told).select("a_rows", "rows").mapInPandas(_negatives(bias, n_negatives, low, high, scale), schema)
    order = Window.partitionBy("a_row", "p_row").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
