"""All queries of this package (imported for their registration)."""

from __future__ import annotations

from . import (  # noqa: F401
    merkle_queries,
    mixing_queries,
    negatives_queries,
    ngram_queries,
    packing_queries,
    pii_queries,
    quality_queries,
    secrets_queries,
    sharding_queries,
    suffix_queries,
    toxicity_queries,
    vector_queries,
)
from .registry import ORACLE, QUERIES  # noqa: F401
