"""Query of best-fit packing over all documents, checked against a plain search in tests."""

from __future__ import annotations

from tabula.session import load

from .packing import pack
from .registry import query


@query("op1_packing")
def op1_packing(spark, sf_dir):
    return pack(load(spark, sf_dir, "documents"))
