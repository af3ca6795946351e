"""Small SQL text helpers for the oracle queries (ANSI SQL as DuckDB runs it)."""

from __future__ import annotations

from quillspark.functions.columns import NUMERIC_PATTERN


def sql_safe_double(expr: str) -> str:
    return (f"CASE WHEN regexp_full_match(CAST({expr} AS VARCHAR), '{NUMERIC_PATTERN}') "
            f"THEN TRY_CAST(trim(CAST({expr} AS VARCHAR)) AS DOUBLE) END")


def sql_sig_round(expr: str, digits: int = 9, zero_below: float | None = None) -> str:
    k = f"({digits - 1} - floor(log10(abs({expr}))))"
    pa = f"pow(10.0, least(abs({k}), 22))"
    pb = f"pow(10.0, greatest(abs({k}) - 22, 0))"
    small = f"WHEN abs({expr}) < {zero_below!r} THEN 0.0 " if zero_below is not None else ""
    return (f"(CASE WHEN ({expr}) = 0 OR ({expr}) IS NULL OR isnan({expr}) OR isinf({expr}) "
            f"THEN ({expr}) {small}"
            f"WHEN {k} >= 0 THEN round(({expr}) * {pa} * {pb}, 0) / {pb} / {pa} "
            f"ELSE round(({expr}) / {pa} / {pb}, 0) * {pb} * {pa} END)")


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
