"""Query of the removal of repeated strings over all documents, checked by brute force in tests."""

from __future__ import annotations

from tabula.session import load

from .registry import query
from .suffix_dedup import remove_repeats


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).drop("kept")
