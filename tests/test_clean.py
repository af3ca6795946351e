import bz2
import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions.columns import NUMERIC_PATTERN, safe_double
from quillspark.operators.clean import TAXI_KEEP, TAXI_RANGES, clean_numeric, dropped_rows
from quillspark.sources.csv import TAXI_FIELDS, read_csv_strings


def ride(time="300", dist="2.0", fare="10.0", surcharge="0.5", total="12.0"):
    f = ["m", "h", "2013-01-01 00:00:00", "2013-01-01 00:05:00", time, dist,
         "-73.9", "40.7", "-73.9", "40.7", "CRD", fare, surcharge, "0.5", "1.0", "0.0", total]
    return f


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in TAXI_FIELDS))


def test_safe_double_forms(spark):
    vals = ["1", " 3 ", "+5", ".5", "1e3", "1.", "abc", "", "nan", "inf", "1_000", "1d", "1f", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(safe_double("s")).collect()]
    assert got == [1.0, 3.0, 5.0, 0.5, 1000.0, 1.0, None, None, None, None, None, None, None, None]


def test_range_filter_boundaries(spark):
    rows = [
        ride(),                                  # kept
        ride(time="120"), ride(time="3600"),     # boundaries kept
        ride(time="119.99"), ride(time="3600.01"),
        ride(fare="3"), ride(fare="200"), ride(fare="2.99"), ride(fare="200.5"),
        ride(dist="1"), ride(dist="50"), ride(dist="0.99"), ride(dist="50.01"),
        ride(time=""), ride(fare="abc"), ride(dist="nan"), ride(time="1_000"),
        ride(total="x"),                         # a kept field that does not parse
    ]
    out = clean_numeric(frame(spark, rows), TAXI_KEEP, TAXI_RANGES)
    assert out.columns == list(TAXI_KEEP)
    assert out.count() == 7
    stats = dropped_rows(frame(spark, rows), TAXI_KEEP, TAXI_RANGES).first()
    assert (stats.rows_in, stats.rows_kept, stats.rows_dropped) == (18, 7, 11)


def test_optional_extra_range(spark):
    rows = [ride(surcharge="0.5"), ride(surcharge="3.5")]
    out = clean_numeric(frame(spark, rows), TAXI_KEEP, TAXI_RANGES,
                        extra_ranges={"surcharge": (3.0, 1e9)})
    assert [r.surcharge for r in out.collect()] == [3.5]


def test_csv_plain_bz2_and_short_rows(spark, tmpdir_path):
    lines = [",".join(ride()), ",".join(ride(fare="20.0")), "a,b,c"]
    text = "\n".join(lines) + "\n"
    plain = os.path.join(tmpdir_path, "rides.csv")
    with open(plain, "w") as f:
        f.write(text)
    packed = os.path.join(tmpdir_path, "rides2.csv.bz2")
    with open(packed, "wb") as f:
        f.write(bz2.compress(text.encode()))
    for path in (plain, packed):
        df = read_csv_strings(spark, path)
        assert df.count() == 3
        kept = clean_numeric(df, TAXI_KEEP, TAXI_RANGES)
        assert sorted(r.fare_amount for r in kept.collect()) == [10.0, 20.0]


def test_plan_prunes_and_compares_plainly(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "rides.parquet")
    frame(spark, [ride(), ride(time="5")]).write.parquet(path)
    out = clean_numeric(spark.read.parquet(path), TAXI_KEEP, TAXI_RANGES).select("fare_amount")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "medallion" not in plan.split("ReadSchema")[-1]
    assert "transform(" not in plan and "lambda" not in plan and "Exchange" not in plan
    assert out.agg(F.count("*")).first()[0] == 1
    stats = dropped_rows(spark.read.parquet(path), TAXI_KEEP, TAXI_RANGES)
    assert stats._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(allow_nan=True, width=64).map(repr), st.integers(-10**6, 10**6).map(str),
                          st.text("0123456789.eE+- dfxnaiINFty_", max_size=8)), min_size=1, max_size=30))
def test_safe_double_agrees_with_the_number_pattern(spark, values):
    """A text counts as a number exactly if it has the form of one."""
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "s string").select(safe_double("s")).collect()]
    for v, x in zip(values, got):
        plain = re.fullmatch(NUMERIC_PATTERN.strip("^$"), v, re.ASCII)
        assert (x is not None) == bool(plain), (v, x)
        if plain:
            assert x == float(v)
