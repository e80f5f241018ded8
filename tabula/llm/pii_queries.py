"""Query of the personal data operator over all documents, checked by brute force in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.session import load

from .pii import KINDS, find_pii, span_text
from .registry import query


@query("op6_pii")
def op6_pii(spark, sf_dir):
    found = find_pii(load(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(span_text("__base"), 256).alias("base_sha256"),
        span_text("__spans").alias("spans"),
    )
