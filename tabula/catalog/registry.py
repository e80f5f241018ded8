"""Registry of testdata bindings: one Spark callable (+ optional DuckDB SQL) per operator."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATOR_IDS: dict[str, str] = {}


def query(name: str, op_id: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its DuckDB oracle (None = rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATOR_IDS[name] = op_id
        if sql is not None:
            # "column" is reserved in DuckDB: quote the long-layout column name.
            ORACLE[name] = re.sub(r'(?<!["\w])column(?!["\w])', '"column"', sql.strip())
        return fn

    return deco
