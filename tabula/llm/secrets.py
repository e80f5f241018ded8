"""Secret scan: three fixed patterns, and a character Markov model of random strings against identifiers.

Only DataFrame and SQL functions are used. One pass over the texts extracts the pattern matches and the
long tokens; the models are first-order transition tables over the token alphabet (a fixed 68 x 68), one
trained on the strings inside pattern matches (labelled secret), one on the tokens outside of them
(labelled ordinary). A token outside the base matches whose log-likelihood ratio is high is one more span.

Cases: null and empty text have no spans; repeated rows are judged alike; an empty table gives no rows;
without any labelled secret the model adds nothing; only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, with_spans


def _caseless(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


# Base patterns of the three kinds, and the least length of group 2 or of the match.
ASSIGN = (
    "(" + "|".join(_caseless(w) for w in ("password", "passwd", "secret", "token")) + "|" + _caseless("api")
    + "_?" + _caseless("key") + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: a shorter run holds no longer one
HEX = "[0-9a-f]{24,}"  # the same for [0-9a-f]+
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_.-"
TOKEN = "[A-Za-z0-9+/=_-]{12,}"
#: Added to each character's count; weight of the character frequencies in a row of transitions, so that a row
#: of few samples (which may hold unlabelled random strings) falls back on how common the next character is at all.
SMOOTHING, BACKOFF = 0.5, 200.0
#: Least token length to judge, least mean and total log-likelihood ratio (nats) of a secret.
MIN_LENGTH, MIN_MEAN, MIN_TOTAL = 16, 0.4, 12.0


def _codes(token: Column) -> Column:
    """0-based alphabet index of each character."""
    chars = F.filter(F.split(token, "", -1), lambda c: c != "")
    return F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def extract(docs: DataFrame) -> DataFrame:
    """doc_id with the base spans of each kind and the tokens, written once; texts are read once."""
    df = docs.select("doc_id", "text")
    df = with_spans(df, "text", "assign", ASSIGN, group=2)
    df = with_spans(df, "text", "access", ACCESS)
    df = with_spans(df, "text", "hex", HEX)
    df = with_spans(df, "text", "token", TOKEN)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(s["part"]) >= 6))
    base = F.concat("assign", "access", "hex")
    free = F.filter(
        "token", lambda t: ~F.exists(base, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    )
    return keep(df.select("doc_id", "assign", "access", "hex", free.alias("token")), "secrets")


def transitions(strings: DataFrame) -> list[float]:
    """Log transition probabilities (a * 68 + b) of the column ``s``; counts of at most 68 x 68 pairs."""
    n = len(ALPHABET)
    codes = strings.select(_codes(F.col("s")).alias("c")).where(F.size("c") > 1)
    pairs = F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: a * n + b
    )
    counts = [0] * (n * n)
    for row in codes.select(F.explode(pairs).alias("p")).groupBy("p").count().where(f"p between 0 and {n * n - 1}").collect():
        counts[row["p"]] = row["count"]
    next_up = [sum(counts[a * n + b] for a in range(n)) + SMOOTHING for b in range(n)]
    common = [k / sum(next_up) for k in next_up]
    table = []
    for a in range(n):
        own = counts[a * n : a * n + n]
        total = sum(own) + BACKOFF
        table += [math.log((k + BACKOFF * c) / total) for k, c in zip(own, common)]
    return table


def ratio_table(found: DataFrame) -> list[float] | None:
    """Log-likelihood ratios of transitions, secret against ordinary; None without labelled secrets."""
    secret = found.select(
        F.explode(
            F.concat(F.transform("assign", lambda s: s["part"]), F.transform(F.concat("access", "hex"), lambda s: s["hit"]))
        ).alias("s")
    )
    if secret.isEmpty():
        return None
    ordinary = found.select(F.explode(F.transform("token", lambda s: s["hit"])).alias("s"))
    return [p - q for p, q in zip(transitions(secret), transitions(ordinary))]


def ratio(token: Column, table: list[float]) -> Column:
    """Sum of the transition ratios along the token."""
    n = len(ALPHABET)
    lookup = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    codes = _codes(token)
    pairs = F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: a * n + b
    )
    return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.element_at(lookup, p + 1))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of start, kind number, kind, end in result order) and spans (base and Markov spans)."""
    found = extract(docs)
    table = ratio_table(found)
    if table is None:
        extra = F.array().cast("array<struct<start:long,end:long,hit:string,part:string>>")
    else:
        long_ones = F.filter("token", lambda t: F.length(t["hit"]) >= MIN_LENGTH)
        scored = F.transform(long_ones, lambda t: F.struct(t.alias("t"), ratio(t["hit"], table).alias("llr")))
        extra = F.transform(
            F.filter(
                scored,
                lambda x: (x["llr"] >= MIN_TOTAL) & (x["llr"] >= MIN_MEAN * (F.length(x["t"]["hit"]) - 1)),
            ),
            lambda x: x["t"],
        )

    def named(spans: Column, k: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(k).alias("k"), F.lit(KINDS[k]).alias("kind"), s["end"].alias("end")
            ),
        )

    base = F.array_sort(F.concat(named(F.col("assign"), 0), named(F.col("access"), 1), named(F.col("hex"), 2)))
    out = found.select("doc_id", "assign", "access", "hex", base.alias("base"), named(extra, 3).alias("markov"))
    return out.select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        "base",
        F.array_sort(F.concat("base", "markov")).alias("spans"),
    )


def span_text(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
