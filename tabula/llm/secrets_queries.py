"""Query of the secret scan over all documents. Base spans and model are checked by brute force in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.session import load

from .registry import query
from .secrets import find_secrets, span_text


@query("op10_secrets")
def op10_secrets(spark, sf_dir):
    found = find_secrets(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(span_text("base"), 256).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )
