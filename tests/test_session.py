import os

from quillspark.session import checkpoint_dir, materialize, pin


def test_materialize_checkpoints_and_keeps_rows(spark):
    assert checkpoint_dir(spark)                      # set by the test session
    df = spark.range(1000).selectExpr("id", "id * 2 AS y").where("id % 3 = 0")
    pinned = materialize(df)
    try:
        plan = pinned._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" in plan or "InMemoryRelation" in plan   # lineage cut
        assert "Filter" not in plan.split("InMemoryRelation")[-1].split("\n")[0]
        assert sorted(r.id for r in pinned.collect()) == list(range(0, 1000, 3))
        folder = checkpoint_dir(spark).replace("file:", "")
        assert any(os.scandir(folder))                # files written to the checkpoint folder
    finally:
        pinned.unpersist()


def test_task_closures_need_no_installed_package():
    """Arrow-pass closures must carry this package's code: Python workers on
    a cluster do not have it installed."""
    import subprocess
    import sys

    import numpy as np
    import pyarrow as pa
    from pyspark import cloudpickle

    from quillspark.operators.gradient import _partials

    fn = _partials(np.full(3, 0.1), "hinge", "exact", "label", None)
    payload = cloudpickle.dumps(fn)
    probe = (
        "import sys, pickle, pyarrow as pa\n"
        "assert not any('repo' in p for p in sys.path)\n"
        "fn = pickle.loads(sys.stdin.buffer.read())\n"
        "b = pa.RecordBatch.from_arrays([pa.array([[0, 1]], pa.list_(pa.int32())),"
        " pa.array([[1.0, 2.0]], pa.list_(pa.float64())), pa.array([1.0])], ['i', 'v', 'label'])\n"
        "out = next(fn(iter([b])))\n"
        "print(out.num_rows, len(out.column(0)[0]))\n"
    )
    res = subprocess.run([sys.executable, "-c", probe], input=payload, capture_output=True,
                         cwd="/tmp", timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert res.returncode == 0, res.stderr.decode()[-800:]
    assert res.stdout.decode().strip() == "1 5"      # one row of p + 2 slots
    assert pa is not None
