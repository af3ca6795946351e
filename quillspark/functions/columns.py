"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a plain decimal number, optional sign and exponent, spaces
# around allowed. Refuses '1d', '1f', 'inf', 'nan', '1_000'.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Split on a single space: empty tokens, case, tabs, punctuation and line
    breaks stay as they are ('a  b ' -> ['a', '', 'b', ''])."""
    return F.split(_c(text), " ", -1)


def safe_double(c) -> Column:
    """String -> DOUBLE, null when the text is not a plain number. The cast
    itself takes type suffixes, hexadecimal and words like 'nan'; all of them
    have a letter other than an exponent's e."""
    s = _c(c).cast("string")
    return F.when(~s.rlike("[a-df-zA-DF-Z]"), s.try_cast("double"))


def sparse_dot(i, v, weights) -> Column:
    """Σ v[k] * weights[i[k]] for a sparse row (0-based ``i``) against a dense
    array column ``weights``."""
    return F.aggregate(
        F.zip_with(_c(i), _c(v), lambda a, b: b * F.element_at(_c(weights), a + 1)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def logistic_loss(margin, y) -> Column:
    """-y ln h - (1-y) ln(1-h) with h = sigmoid(margin), in the overflow-free
    form log1p(exp(-|m|)) + max(m, 0) - y m."""
    m, y = _c(margin), _c(y)
    return F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - y * m


def hinge(margin, y_pm) -> Column:
    """max(0, 1 - y m) with y in {-1, +1}."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - _c(y_pm) * _c(margin))


def snippet(text, n: int = 200) -> Column:
    return F.substring(_c(text), 1, n)


def sig_round(c, digits: int = 9, zero_below: float | None = None) -> Column:
    """Round to ``digits`` significant digits (for comparing floating results
    across engines); magnitudes below ``zero_below`` (rounding noise of an
    exact zero) become 0."""
    c = _c(c)
    # k decimals to keep; scale by 10^|k| only (exact for |k| <= 22), so both
    # engines see the same products and round half away from zero alike.
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(c)))
    pa = F.pow(F.lit(10.0), F.least(F.abs(k), F.lit(22)))
    pb = F.pow(F.lit(10.0), F.greatest(F.abs(k) - 22, F.lit(0)))
    special = (c == 0) | c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    out = F.when(special, c).otherwise(
        F.when(k >= 0, F.round(c * pa * pb, 0) / pb / pa)
        .otherwise(F.round(c / pa / pb, 0) * pb * pa))
    if zero_below is not None:
        out = F.when(F.abs(c) < F.lit(zero_below), F.lit(0.0)).otherwise(out)
    return out
