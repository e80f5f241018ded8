"""Small text helpers for writing oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Sequence


def long_sql(table: str, cols: Sequence[str], ids: Sequence[str] = (), cast: str = "DOUBLE") -> str:
    """Long layout (ids, column, value) as a UNION ALL subquery."""
    idl = "".join(f"{i}, " for i in ids)
    parts = [f"SELECT {idl}'{c}' AS column, CAST({c} AS {cast}) AS value FROM {table}" for c in cols]
    return "(" + "\nUNION ALL ".join(parts) + ")"


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


EMB_LONG_SQL = """(SELECT vec_id, label, CAST(i - 1 AS BIGINT) AS feature, CAST(embedding[i] AS DOUBLE) AS value
  FROM (SELECT vec_id, label, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings))"""

LINEITEM_ID = "(l_orderkey * 16 + l_linenumber)"
