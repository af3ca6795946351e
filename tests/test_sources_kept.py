import bz2
import os

import pytest
from pyspark.sql import functions as F

from quillspark.operators.clean import TAXI_KEEP, TAXI_RANGES, clean_numeric, clean_observed
from quillspark.sources.csv import CAUSES, TAXI_FIELDS, checked_records, read_csv_strings, split_records
from quillspark.sources.layout import laid_out
from quillspark.sources.tables import keep_bucketed
from quillspark.sources.text import line_counts, load_corpus, observe_lines, parse_labelled, read_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ride(time="600", distance="2.5", fare="10", extra="0.5", total="11"):
    row = ["m", "h", "2013-01-01 00:00:00", "2013-01-01 00:10:00", time, distance, "-73.9", "40.7", "-73.8", "40.8", "CSH", fare, extra, "0.5", "0", "0", total]
    return ",".join(row)


LINES = {
    ride(): None, ride(time="120", distance="1", fare="3"): None, ride(time="3600", distance="50", fare="200"): None,
    ride(time="119"): "out_of_range", ride(fare="200.01"): "out_of_range", ride(distance="nan"): "unparsable",
    ride(time="abc"): "unparsable", ride(total="1_000"): "unparsable", ride(extra=""): "unparsable", ride(time="", fare="1"): "unparsable",
    ride() + ",more": "ragged", ride().rsplit(",", 1)[0]: "ragged", "": "ragged", "one": "ragged", ride(time="119") + ",": "ragged",
}


@pytest.mark.parametrize("packed", [False, True])
def test_kept_and_rejected_lines_are_all_lines(spark, tmpdir_path, packed):
    path = os.path.join(tmpdir_path, "rides.csv" + (".bz2" if packed else ""))
    text = "\n".join(LINES) + "\n"
    with bz2.open(path, "wt") if packed else open(path, "w") as f:
        f.write(text)
    checked = checked_records(read_lines(spark, path), TAXI_FIELDS, TAXI_KEEP, TAXI_RANGES)
    assert {r.line: r.cause for r in checked.collect()} == LINES
    kept, rejects, counts = split_records(checked, os.path.join(tmpdir_path, "out"))
    want = {c: list(LINES.values()).count(c) for c in CAUSES}
    assert counts == {"lines": len(LINES), "kept": list(LINES.values()).count(None), **want}
    assert kept.count() + rejects.count() == len(text.splitlines()) == counts["lines"]
    assert {(r.line, r.cause) for r in rejects.collect()} == {(k, v) for k, v in LINES.items() if v}
    # the kept ones are those of the plain cleaning
    plain = clean_numeric(read_csv_strings(spark, path), TAXI_KEEP, TAXI_RANGES)
    extra = [ride() + ",more"]                   # which the plain reader cuts off and keeps
    assert plain.count() == kept.count() + len(extra) and set(kept.collect()) <= set(plain.collect())
    assert kept.columns == list(TAXI_KEEP)


def test_a_null_line_is_ragged_and_columns_pass_through(spark):
    lines = spark.createDataFrame([(1, None), (2, "5,7"), (3, "5,x"), (4, "50,1")], "at int, value string")
    checked = checked_records(lines, ["a", "b"], {"b": "b"}, {"a": (1.0, 9.0)}, passthrough=["at"])
    assert {r.at: (r.cause, r.b) for r in checked.collect()} == {
        1: ("ragged", None), 2: (None, 7.0), 3: ("unparsable", None), 4: ("out_of_range", 1.0)}


def test_no_lines(spark, tmpdir_path):
    none = spark.createDataFrame([], "value string")
    kept, rejects, counts = split_records(checked_records(none, ["a"], {"a": "a"}, {}), os.path.join(tmpdir_path, "none"))
    assert kept.count() == rejects.count() == 0 and set(counts.values()) == {0}


def test_counts_of_the_cleaning_pass(spark):
    rows = [("5", "1"), ("x", "1"), ("50", "1"), (None, "1"), ("5", "y"), ("9", "2"), ("0", "z")]
    df = spark.createDataFrame(rows, "a string, b string").repartition(3)
    kept, seen = clean_observed(df, {"a": "a", "b": "b"}, {"a": (1.0, 9.0)})
    assert sorted(map(tuple, kept.collect())) == [(5.0, 1.0), (9.0, 2.0)]
    assert seen.get == {"rows_in": 7, "rows_kept": 2, "unparsable": 4, "out_of_range": 1}
    assert sorted(kept.collect()) == sorted(clean_numeric(df, {"a": "a", "b": "b"}, {"a": (1.0, 9.0)}).collect())


def test_counts_of_the_parsing_pass(spark):
    lines = spark.createDataFrame([('<doc id="AU1" x="">a</doc>',), ("no mark",), (None,), ('<doc id="2">b</doc>',)], "value string")
    counted, seen = observe_lines(lines)
    assert parse_labelled(counted).count() == 2
    assert seen.get == {"lines": 4, "parsed": 2, "unmatched": 2} == line_counts(lines).first().asDict()


def test_layouts(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "lines.txt")
    with open(path, "w") as f:
        f.writelines(f'<doc id="{"AU" if k % 2 else ""}{k}" t="">text {k}</doc>\n' for k in range(500))
    plain = read_lines(spark, path)
    assert "Exchange" not in plan(plain)
    auto = read_lines(spark, path, layout="auto")
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan(auto) and sorted(auto.collect()) == sorted(plain.collect())
    by_key = laid_out(plain, ["value"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(by_key) and by_key.count() == 500
    assert laid_out(plain, 7).rdd.getNumPartitions() == 7
    rides = os.path.join(tmpdir_path, "rides.csv")
    with open(rides, "w") as f:
        f.write((ride() + "\n") * 40)
    assert read_csv_strings(spark, rides, layout=5).rdd.getNumPartitions() == 5
    assert "REBALANCE" in plan(read_csv_strings(spark, rides, layout="auto"))
    for layout in (None, "auto", 4):
        train, test = load_corpus(spark, path, layout=layout)
        assert (train.count(), test.count()) == tuple(x.count() for x in load_corpus(spark, path))
    for wrong in (0, True, ["nope"], []):
        with pytest.raises(ValueError):
            laid_out(plain, wrong)


def test_rebalanced_tasks_follow_the_data(spark):
    """Sixteen times the rows are dealt out to more tasks, without a number given."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sizes = []
        for n in (4_000, 64_000):
            rows = laid_out(spark.range(n).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("t")), "auto")
            sizes.append(len(rows.groupBy(F.spark_partition_id().alias("p")).agg(F.max("t")).collect()))
        assert sizes[1] >= 4 * sizes[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_bucketed_tables_join_where_they_lie(spark):
    words = keep_bucketed(spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("w")), "doc_id", 6)
    known = keep_bucketed(spark.range(0, 4000, 3).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("y")), "doc_id", 6)
    both = words.join(known.hint("merge"), "doc_id")
    p = plan(both)
    assert "SortMergeJoin" in p and "Exchange" not in p and "Bucketed: true" in p
    assert both.count() == len(range(0, 2000, 3))
    per_doc = words.groupBy("doc_id").count()
    assert "Exchange" not in plan(per_doc) and per_doc.count() == 2000
