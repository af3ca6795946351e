"""Safe casts and inclusive range filters for delimited records.

A row is kept when every tested field parses and lies in its inclusive range,
and every kept field parses. Everything is one projection + one filter, so
Catalyst pushes what it can into the scan and prunes unused columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillspark.functions.columns import safe_double

# The taxi ride fields kept and their inclusive ranges.
TAXI_KEEP = {
    "trip_time_in_secs": "trip_time_in_secs",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "surcharge": "surcharge",
    "total_amount": "total_amount",
}
TAXI_RANGES = {
    "trip_time_in_secs": (120.0, 3600.0),
    "fare_amount": (3.0, 200.0),
    "trip_distance": (1.0, 50.0),
}

# The same shape of cleaning on the lineitem table (used by the registered
# queries): quantity -> price regression, discount as third tested field.
LINEITEM_KEEP = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "tax": "l_tax",
}
LINEITEM_RANGES = {
    "quantity": (2.0, 48.0),
    "price": (1000.0, 100000.0),
    "discount": (0.01, 0.09),
}


def in_range(c, lo: float, hi: float):
    """``lo <= c <= hi``; null and nan aren't in any range."""
    return (c >= F.lit(float(lo))) & (c <= F.lit(float(hi)))


def _condition(parsed, keep, ranges):
    """Whether a row's tested fields lie in their ranges and all kept ones parse."""
    cond = F.lit(True)
    for name, (lo, hi) in ranges.items():
        cond = cond & in_range(parsed[name], lo, hi)
    for name in keep:
        if name not in ranges:          # a range test already rejects null
            cond = cond & parsed[name].isNotNull()
    return cond


def parsed_fields(keep, ranges):
    """The kept and the tested fields by name, safely cast."""
    tested = {name: keep.get(name, name) for name in ranges}
    return {name: safe_double(src) for name, src in {**tested, **keep}.items()}


def clean_numeric(df: DataFrame, keep: Mapping[str, str],
                  ranges: Mapping[str, tuple[float, float]],
                  extra_ranges: Mapping[str, tuple[float, float]] | None = None,
                  passthrough: Sequence[str] = ()) -> DataFrame:
    """Project ``keep`` (output name -> source column) through ``safe_double``
    and keep rows inside every range. Range fields not in ``keep`` are tested
    but not returned. ``extra_ranges`` adds optional conditions (e.g. a
    minimum toll) on top of the defaults."""
    all_ranges = {**ranges, **(extra_ranges or {})}
    parsed = parsed_fields(keep, all_ranges)
    cols = [F.col(c) for c in passthrough] + [parsed[n].alias(n) for n in keep]
    return df.where(_condition(parsed, keep, all_ranges)).select(*cols)


def clean_observed(df: DataFrame, keep: Mapping[str, str], ranges: Mapping[str, tuple[float, float]],
                   extra_ranges: Mapping[str, tuple[float, float]] | None = None,
                   passthrough: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """``clean_numeric`` and what it drops, counted in the same pass:
    ``rows_in``, ``rows_kept``, and by the first cause ``unparsable`` (a kept or
    tested field is no plain number) and ``out_of_range``. The counts are there
    once an action has run over the frame."""
    all_ranges = {**ranges, **(extra_ranges or {})}
    parsed = parsed_fields(keep, all_ranges)
    whole = F.lit(True)
    for c in parsed.values():
        whole = whole & c.isNotNull()
    kept = F.coalesce(_condition(parsed, keep, all_ranges), F.lit(False))
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_kept"),
                         F.count_if(~whole).alias("unparsable"), F.count_if(whole & ~kept).alias("out_of_range"))
    return clean_numeric(counted, keep, ranges, extra_ranges, passthrough), seen


def dropped_rows(df: DataFrame, keep: Mapping[str, str],
                 ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row: input rows, kept rows, dropped rows (one aggregation pass)."""
    kept = F.coalesce(_condition(parsed_fields(keep, ranges), keep, ranges), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_kept")).withColumn(
        "rows_dropped", F.col("rows_in") - F.col("rows_kept"))


def as_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Render columns as text, as a delimited file would hold them."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])
