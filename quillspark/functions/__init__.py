"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from quillspark.functions.columns import (
    NUMERIC_PATTERN,
    hinge,
    logistic_loss,
    safe_double,
    sig_round,
    snippet,
    sparse_dot,
    tokens,
)

__all__ = [
    "NUMERIC_PATTERN",
    "hinge",
    "logistic_loss",
    "safe_double",
    "sig_round",
    "snippet",
    "sparse_dot",
    "tokens",
]
