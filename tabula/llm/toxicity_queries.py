"""Query of the toxicity score over all documents, tested by held-out accuracy."""

from __future__ import annotations

from tabula.session import load

from .registry import query
from .toxicity import toxicity


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
