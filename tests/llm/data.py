"""Small corpora for the tests: invented prose with copies, near copies, hot sources and odd rows."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("size", T.StringType()),
        T.StructField("mark", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("bin", T.StringType()),
        T.StructField("shard", T.StringType()),
    ]
)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(["ka", "lo", "mi", "ter", "än", "sho", "vu"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Prose, exact copies, near copies at several distances, a shared passage, periodic and odd texts."""
    rng = random.Random(seed)
    out: list[str | None] = [" ".join(words(rng, rng.randint(30, 200))) for _ in range(n)]
    passage = " ".join(words(rng, 90))
    for i in range(0, n, 5):
        t = out[i].split(" ")
        for share in (0.0, 0.02, 0.04, 0.07):
            out.append(" ".join(w if rng.random() >= share else "neu" for w in t))
        out.append(" ".join(t + words(rng, max(1, len(t) // 4))))
        out.append(out[i + 1] + " " + passage)
    out += ["Shti " * 300, "a" * 1500, "x", "x", "one two three four", "One two Three four", "", "", "  \n\t ", None, None]
    out += [" ".join(words(rng, 4000)), "abc " * 2000 + passage, "\n".join(["the same line of words again"] * 40)]
    return out


def frame(spark, rows: list[str | None], sources: list[str | None] | None = None, ids: list[int | None] | None = None):
    """Documents of the given texts; a third of them in one hot source."""
    data = []
    for i, t in enumerate(rows):
        s = sources[i] if sources else ("hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None)
        data.append((ids[i] if ids else i * 3 + 1, t, "en", s, None if t is None else len(t), "x", "y", "z", "c", "s", "b", "h"))
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
