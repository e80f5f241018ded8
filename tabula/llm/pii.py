"""Personal data: four fixed patterns, and information-theoretic sanitisation of terms that give them away.

Only DataFrame and SQL functions are used. Values matched by the base patterns are the protected entities
of four kinds. For a term t and a kind e, corpus counts over lines give the pointwise mutual information
PMI(t, e) = log2(p(t, e) / (p(t) p(e))) and the information of the kind, IC(e) = -log2 p(e); PMI reaches IC
when t appears with the kind only. The disclosure of t is PMI / IC. In documents that hold the kind, terms
with a disclosure of GENERALISE_AT or more are generalised to a placeholder, of REMOVE_AT or more removed.
Joint counts are of distinct entity values, so copies of a document don't make its words look revealing.

Cases: null and empty text have no spans; repeated rows are judged alike; an empty table gives no rows;
overlapping spans are replaced once, from the first start to the last end; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, with_spans

# Base patterns by kind. Possessive forms and the look-behind only save the engine from trying
# again inside a run; \\G admits the rest of a run of which the last match took the head.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = "[\\p{L}\\p{N}]{3,}"

#: Least number of distinct entity values that a term must be seen with; disclosure limits.
MIN_VALUES, GENERALISE_AT, REMOVE_AT = 5, 0.75, 0.95
TERM_KIND = "term"


def _luhn(hit: Column) -> Column:
    digits = F.filter(F.split(F.reverse(F.translate(hit, " -", "")), "", -1), lambda c: c != "")
    parts = F.transform(
        digits,
        lambda c, i: F.when(i % 2 == 0, c.cast("int"))
        .when(c.cast("int") > 4, c.cast("int") * 2 - 9)
        .otherwise(c.cast("int") * 2),
    )
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.length(F.regexp_replace(hit, "[^0-9]", ""))


ACCEPT = {
    "email": None,
    "ip": lambda s: s["hit"].rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$"),
    "card": lambda s: _digits(s["hit"]).between(13, 19) & _luhn(s["hit"]),
    "phone": lambda s: _digits(s["hit"]).between(9, 15),
}


def with_base(df: DataFrame, text: str = "text") -> DataFrame:
    """Add one array column of accepted matches per kind (named as the kind, with two leading underscores)."""
    for kind in KINDS:
        df = with_spans(df, text, f"__{kind}", PATTERNS[kind])
    return df.withColumns({f"__{k}": F.filter(f"__{k}", ACCEPT[k]) for k in KINDS if ACCEPT[k]})


def protected_lines(docs: DataFrame) -> DataFrame:
    """(kind, value, terms) of each entity on each line of ``docs`` (doc_id, text); matches never span lines."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = with_base(lines, "line")

    def entity(kind: str) -> Column:
        return F.transform(f"__{kind}", lambda s: F.struct(F.lit(kind).alias("kind"), s["hit"].alias("value")))

    entities = F.concat(*[entity(k) for k in KINDS])
    rest = F.col("line")
    for k in KINDS:
        rest = F.regexp_replace(rest, PATTERNS[k], " ")
    terms = F.array_distinct(F.regexp_extract_all(F.lower(rest), F.lit(TERM), F.lit(0)))
    found = lines.select(F.explode(entities).alias("e"), terms.alias("terms"))
    return found.select("e.kind", "e.value", "terms")


def revealing_terms(docs: DataFrame, protected: DataFrame) -> DataFrame:
    """(term, kind, disclosure) of the terms at or above GENERALISE_AT; counts cover all lines of ``docs``."""
    seen = keep(protected_lines(protected), "pii-lines")
    joint = seen.select("kind", "value", F.explode("terms").alias("term")).groupBy("kind", "term").agg(
        F.countDistinct("value").alias("joint")
    )
    joint = keep(joint.where(F.col("joint") >= MIN_VALUES), "pii-joint")
    kinds = seen.groupBy("kind").agg(F.countDistinct("value").alias("n_kind"))
    lines = docs.where("text is not null").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0)))
    n_lines = docs.agg(F.sum(F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)))).first()[0] or 0
    counts = lines.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    both = joint.join(counts, "term").join(kinds, "kind")
    pmi = F.log2(F.col("joint") * float(n_lines) / (F.col("n_term") * F.col("n_kind")))
    info = -F.log2(F.col("n_kind") / float(max(n_lines, 1)))
    both = both.select("term", "kind", F.when(info > 0, pmi / info).alias("disclosure"))
    return keep(both.where(F.col("disclosure") >= GENERALISE_AT), "pii-terms")


def _named(spans: str, k: int, kind: str, label: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(k).alias("k"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(label).alias("label")
        ),
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with __base and __spans: arrays of (k, start, end, kind, label) by kind, then start."""
    own = docs.columns
    held = " or ".join(f"size(__{k}) > 0" for k in KINDS)
    slim = keep(with_base(docs.where("text is not null").select("doc_id", "text")).where(held).select("doc_id", "text"), "pii-docs")
    terms = revealing_terms(docs.select("text"), slim)
    by_kind = terms.groupBy("term").agg(
        F.collect_set("kind").alias("kinds"), F.max("disclosure").alias("disclosure")
    )  # at most four kinds a term
    based = with_base(docs)
    base = F.concat(*[_named(f"__{k}", i, k, f"[{k.upper()}]") for i, k in enumerate(KINDS)])
    based = based.withColumn("__base", F.array_sort(base)).withColumn(
        "__kinds", F.concat(*[F.when(F.size(f"__{k}") > 0, F.array(F.lit(k))).otherwise(F.array().cast("array<string>")) for k in KINDS])
    ).select(*own, "__base", "__kinds")
    none = F.array().cast(based.schema["__base"].dataType)
    if terms.isEmpty():
        return based.select(*own, "__base", F.col("__base").alias("__spans"))
    clean, hold = based.where(F.size("__kinds") == 0), based.where(F.size("__kinds") > 0)
    key = F.xxhash64("doc_id", "text")
    words = hold.select(
        key.alias("__key"), "__kinds", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term")
    )
    told = words.join(by_kind, "term").where(F.arrays_overlap("kinds", "__kinds"))
    gone = F.col("disclosure") >= REMOVE_AT
    alternatives = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("term")))), "|")
    told = told.groupBy("__key").agg(alternatives(~gone).alias("__soft"), alternatives(gone).alias("__hard"))
    whole = lambda c: F.when(F.col(c) != "", F.concat(F.lit("(?iu)(?<![\\p{L}\\p{N}])(?:"), F.col(c), F.lit(")(?![\\p{L}\\p{N}])")))
    hold = hold.withColumn("__key", key).join(told, "__key", "left")
    hold = with_spans(hold.withColumn("__soft", whole("__soft")).withColumn("__hard", whole("__hard")), "text", "__s", F.col("__soft"))
    hold = with_spans(hold, "text", "__h", F.col("__hard"))
    extra = F.concat(_named("__s", len(KINDS), TERM_KIND, "[TERM]"), _named("__h", len(KINDS), TERM_KIND, ""))
    outside = F.filter(extra, lambda t: ~F.exists("__base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    hold = hold.select(*own, "__base", F.array_sort(F.concat("__base", outside)).alias("__spans"))
    return hold.unionByName(clean.select(*own, "__base", none.alias("__spans")))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with spans replaced by their label; n_chars follows the text where it is a column."""
    own = docs.columns
    found = find_pii(docs)
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"], s["end"], s["label"])))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return (
            F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, s["label"]).alias("out")))
            .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    text = F.when(F.size("__spans") > 0, F.aggregate(ordered, start, put, rest)).otherwise(F.col("text"))
    found = found.withColumn("__new", text)
    new = {"text": F.col("__new")}
    if "n_chars" in own:
        n = F.when(F.size("__spans") > 0, F.length("__new")).otherwise(F.col("n_chars"))
        new["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in own])


def span_text(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
