"""Query of sharding over all documents, tested by its law and by the links it cuts."""

from __future__ import annotations

from tabula.session import load

from .registry import query
from .sharding import shard_documents


@query("op4_sharding")
def op4_sharding(spark, sf_dir):
    return shard_documents(load(spark, sf_dir, "documents").select("doc_id", "text"))
