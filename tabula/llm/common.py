"""Helpers shared by the corpus operators: scratch tables, text expressions, regex spans, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import ensure_checkpoint_dir

#: A word is a maximal run of characters other than ASCII blank, tab, line feed, VT, FF and CR.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANK = "[\\x20\\x09-\\x0D]+"
#: Edges that a task makes stars of at once (a fixed bound: more edges are dealt to more tasks).
PART_EDGES = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def with_spans(df: DataFrame, text: str, out: str, pattern: str | Column, group: int = 0) -> DataFrame:
    """Add ``out``: array of (start, end, hit, part) for each leftmost non-overlapping match, in code points.

    The pieces between matches (``split``) and the matches themselves alternate, so running sums of
    their lengths give the positions; ``part`` is the given group of the match. Null text or a null
    pattern: no match.
    """
    item = "struct<start:long,end:long,hit:string,part:string>"
    empty = F.array().cast(f"array<{item}>")
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    step = df.withColumn(
        "__hits", F.when(F.regexp_like(F.col(text), regex), F.regexp_extract_all(F.col(text), regex, F.lit(0)))
    )
    step = step.withColumn("__gaps", F.when(F.col("__hits").isNotNull(), F.split(F.col(text), regex, -1)))
    parts = F.regexp_extract_all(F.col(text), regex, F.lit(group)) if group else F.col("__hits")
    step = step.withColumn("__parts", F.when(F.col("__hits").isNotNull(), parts))

    def take(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    zipped = F.zip_with(
        F.zip_with(
            F.slice(F.col("__gaps"), F.lit(1), F.size("__hits")),
            F.col("__hits"),
            lambda g, h: F.struct(g.alias("gap"), h.alias("hit")),
        ),
        F.col("__parts"),
        lambda x, p: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), p.alias("part")),
    )
    found = F.aggregate(
        zipped, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found")), take, lambda acc: acc["found"]
    )
    return step.withColumn(out, F.when(F.col("__hits").isNull(), empty).otherwise(found)).drop(
        "__hits", "__gaps", "__parts"
    )


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[list[pd.DataFrame]]:
    """The groups of equal keys of rows that arrive sorted by key, a list of whole groups at a time."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        k = pdf[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) if len(k) else []
        yield [pdf.iloc[a:b] for a, b in zip(starts, starts[1:])]
        rest = pdf.iloc[starts[-1] :] if len(starts) else None
    if rest is not None:
        yield [rest]


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (u, v) of a task, a bounded part at a time, as stars: each node of a part but the smallest of those that it
    is connected with there, once, with that smallest one."""

    def of(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
        ids, at = np.unique(np.r_[u, v], return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        low = np.arange(len(ids))
        while (apart := low[a] != low[b]).any():
            a, b = a[apart], b[apart]
            x, y = low[a], low[b]
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while ((next_low := low[low]) != low).any():
                low = next_low
        ends = low != np.arange(len(ids))
        return pd.DataFrame({"u": ids[ends], "v": ids[low[ends]]})

    part, held = [], 0
    for pdf in batches:
        part.append(pdf)
        held += len(pdf)
        if held >= PART_EDGES:
            yield of(*(np.concatenate([x[c].to_numpy() for x in part]) for c in "uv"))
            part, held = [], 0
    if held:
        yield of(*(np.concatenate([x[c].to_numpy() for x in part]) for c in "uv"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long): (node, component = smallest node).

    Each task makes stars of a part of at most about PART_EDGES edges, which settles a single part. With several parts a round
    goes on: every edge moves to the smallest neighbour of its lower end (large star), and the lower ends of a node are
    linked to the smallest of them (small star). Rounds are written to the shared folder until all edges are
    stars. Nodes without an edge are not returned.
    """
    cur = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")

    def state() -> tuple[int, int]:
        """Edges, and nodes that are not either the upper end of one edge or the lower end of any number of them."""
        ends = cur.select(F.col("u").alias("node"), F.lit(1).alias("upper"), F.lit(0).alias("lower")).unionByName(
            cur.select(F.col("v").alias("node"), F.lit(0).alias("upper"), F.lit(1).alias("lower"))
        )
        ends = ends.groupBy("node").agg(F.sum("upper").alias("upper"), F.max("lower").alias("lower"))
        return tuple(ends.agg(F.coalesce(F.sum("upper"), F.lit(0)), F.count_if(F.col("upper") + F.col("lower") > 1)).first())

    n, apart = state()
    while apart:
        parts = -(-n // PART_EDGES)
        stars = cur.coalesce(parts).mapInPandas(_stars, "u long, v long")
        if parts == 1:
            cur = keep(stars, "edges")
            break
        up = stars.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), "m")
        large = stars.join(up, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = keep(small.unionByName(low.select("u", F.col("m").alias("v"))), "edges")
        n, apart = state()
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema))
