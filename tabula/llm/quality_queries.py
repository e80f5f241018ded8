"""Query of the quality score over all documents, tested by held-out accuracy."""

from __future__ import annotations

from tabula.session import load

from .quality import quality
from .registry import query


@query("op11_quality")
def op11_quality(spark, sf_dir):
    return quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
