"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.

Every step is a DataFrame expression, aggregation or join. Documents are only read for their size; the
decision for a row needs nothing but the row and its source's line of the plan, so a hot source is
never gathered: its sums are pre-aggregated and the cut is found in a histogram of hash prefixes.

Cases: null or empty text has size 0 and nothing is taken; a null source is a source of its own, ordered
last; a source of size 0 has target 0; an empty table gives no rows; repeated rows are decided alike;
columns that are not used play no part in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, word_count

#: A plan of up to this many sources (one short row each) is broadcast, a longer one is joined by shuffle.
BROADCAST_SOURCES = 50_000


def _mark(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def targets(
    sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3
) -> DataFrame:
    """(source, source_size, target) by capped water-filling.

    ``sized`` has source and size. Sources ordered by code point (null last) weigh ``weights`` in turn and
    share ``share`` of all words. With caps c = max_epochs * size, clamping and resharing until no
    target is above its cap equals one level L with sum(min(c, L * w)) = total: sources are clamped
    in the order of c / w, so L follows from running sums over the sources in that order.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % n + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * float(max_epochs))
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = by.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(in_order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(everything).cast("double") * float(share)).alias("total"),
        F.row_number().over(in_order).alias("nth"),
    )
    level = (F.col("total") - F.col("capped")) / F.col("open")
    by = by.withColumn("free", level * F.col("weight") <= F.col("cap")).withColumn("level", level)
    # the first source in order that is not clamped fixes the level of all that follow
    first = F.min(F.when(F.col("free"), F.struct("nth", "level")))
    by = by.withColumn("final", first.over(everything)["level"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("final") * F.col("weight"))
    )
    return by.select("source", "source_size", target.alias("target"))


def plan(sized: DataFrame, seed: int = 0, **options) -> DataFrame:
    """One row per source: target, whole repetitions, and the point of the seeded order up to which a
    document is taken once more (cut_mark, cut_id), where the document at the cut gives ``part`` words.

    ``sized`` has doc_id, source and size. The order is the md5 of seed and doc_id. Words per
    (source, first three hex digits) place the cut in one of 4096 buckets; only that bucket's rows are
    ordered, so a window never holds more than that share of a source.
    """
    marked = sized.withColumn("mark", _mark(F.col("doc_id"), seed)).withColumn("bucket", F.substring("mark", 1, 3))
    goal = targets(sized, **options)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("whole", whole.cast("long")).withColumn(
        "extra", F.floor(F.col("target") + F.lit(0.5)).cast("long") - F.col("whole") * F.col("source_size")
    )
    hist = marked.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("upto", F.sum("words").over(run))
    g, h = goal.alias("g"), hist.alias("h")
    at = h.join(g, F.col("h.source").eqNullSafe(F.col("g.source"))).where("upto >= extra and upto - words < extra")
    at = at.select(
        F.col("h.source").alias("source"), "bucket", (F.col("extra") - F.col("upto") + F.col("words")).alias("left")
    )
    m, a = marked.where("size > 0").alias("m"), at.alias("a")
    inside = m.join(a, F.col("m.source").eqNullSafe(F.col("a.source")) & (F.col("m.bucket") == F.col("a.bucket")))
    inside = inside.select(F.col("m.source").alias("source"), "doc_id", "size", "mark", "left")
    order = Window.partitionBy("source").orderBy("mark", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.sum("size").over(order)).where("upto >= left and upto - size < left")
    cut = inside.groupBy("source").agg(
        F.min(F.struct("mark", "doc_id", (F.col("left") - F.col("upto") + F.col("size")).alias("part"))).alias("cut")
    )
    g, c = goal.alias("g"), cut.alias("c")
    return g.join(c, F.col("g.source").eqNullSafe(F.col("c.source")), "left").select(
        "g.*", F.col("cut.mark").alias("cut_mark"), F.col("cut.doc_id").alias("cut_id"), F.col("cut.part").alias("part")
    )


def apply_plan(docs: DataFrame, plan_df: DataFrame, seed: int = 0, size: str = "size") -> DataFrame:
    """All columns of ``docs`` (doc_id, source and the one named ``size`` among them) with __source_size,
    __target, __whole and __part: words taken beyond the whole repetitions (all, some at the cut, or 0)."""
    own = docs.columns
    few = plan_df.count() <= BROADCAST_SOURCES
    p = plan_df.select(*[F.col(c).alias(f"__{c}") for c in plan_df.columns if c != "part"], F.col("part").alias("__cut_part"))
    joined = docs.join(F.broadcast(p) if few else p, F.col("source").eqNullSafe(F.col("__source")), "left")
    mark = _mark(F.col("doc_id"), seed)
    part = (
        F.when(F.col("__cut_mark").isNull() | (mark > F.col("__cut_mark")), F.lit(0))
        .when(mark < F.col("__cut_mark"), F.col(size))
        .when(F.col("doc_id").eqNullSafe(F.col("__cut_id")), F.least(F.col("__cut_part"), F.col(size)))
        .when(F.col("doc_id") < F.col("__cut_id"), F.col(size))
        .otherwise(F.lit(0))
    )
    return joined.select(*own, "__source_size", "__target", "__whole", part.cast("long").alias("__part"))


def mix_report(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words taken, repetitions counted) of every row."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    done = apply_plan(sized, keep(plan(sized, seed, **options), "mix"), seed)
    taken = F.col("__whole") * F.col("size") + F.col("__part")
    return done.select(
        "doc_id",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        taken.alias("taken"),
    )


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each row repeated as often as the plan says, the
    document at a source's cut also once with its first words only. Documents without words, of which
    there is nothing to repeat, are kept once."""
    cols = docs.columns
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    p = keep(plan(sized, seed, **options), "mix")
    done = apply_plan(docs.withColumn("__size", word_count(F.col("text"))), p, seed, "__size")
    full = F.when(F.col("__size") == 0, F.lit(1)).otherwise(
        F.col("__whole") + F.when(F.col("__part") == F.col("__size"), F.lit(1)).otherwise(F.lit(0))
    )
    some = (F.col("__part") > 0) & (F.col("__part") < F.col("__size"))
    none = F.array().cast("array<boolean>")
    copies = F.concat(
        F.array_repeat(F.lit(False), full.cast("int")), F.when(some, F.array(F.lit(True))).otherwise(none)
    )
    out = done.withColumn("__cut", F.explode(copies))
    pieces = F.split(F.col("text"), "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])", -1)
    lead = F.when(F.col("text").rlike("^[\\x20\\x09-\\x0D]"), F.lit(1)).otherwise(F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), (F.col("__part") + lead).cast("int")), "")
    new = {"text": F.when(F.col("__cut"), head).otherwise(F.col("text"))}
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("__cut"), F.length(head)).otherwise(F.col("n_chars")).cast(kind)
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in cols])
