"""Restartable training: the state after each step, kept in the shared folder.

A step's state is one row of Parquet in a folder of its own: θ, the rate, the
loss, the step rule's numbers and the trace row. It is written before the next
step starts, so a run that ends anywhere goes on from its last whole step and
gives the trace of an unbroken one. A folder belongs to one configuration; a
run with another one is refused. Each row is ``dim`` numbers long, and as many
rows are kept as there are steps."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = ("config string, finished boolean, theta array<double>, theta_old array<double>, "
                "loss double, rate double, rule string, trace_loss double, trace_rate double")


class StateMismatch(ValueError):
    """The folder holds the steps of another configuration."""


@dataclass
class Step:
    """What the next step starts from."""

    step: int
    theta: np.ndarray
    theta_old: np.ndarray
    loss: float
    rate: float
    rule: dict
    finished: bool = False


class StepLog:
    """The steps of one training run under ``path``, a folder that the driver
    and a later driver both reach."""

    def __init__(self, spark: SparkSession, path: str, config: Mapping[str, object]):
        self.spark, self.path = spark, path.rstrip("/")
        self.config = json.dumps(dict(config), sort_keys=True, default=str)

    def save(self, state: Step, trace_loss: float, trace_rate: float) -> None:
        row = (self.config, state.finished, state.theta, state.theta_old, float(state.loss), float(state.rate),
               json.dumps(state.rule), float(trace_loss), float(trace_rate))
        names = [c.split(" ")[0] for c in STATE_SCHEMA.split(", ")]
        table = pa.table({c: pa.array([x]) for c, x in zip(names, row)})
        self.spark.createDataFrame(table, STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/step={state.step}")

    def rows(self) -> DataFrame | None:
        """All steps kept; none if the folder isn't there or holds no step."""
        try:
            return self.spark.read.schema(f"{STATE_SCHEMA}, step int").parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last(self) -> Step | None:
        """The last whole step. One row is read in full."""
        kept = self.rows()
        row = kept.orderBy(F.desc("step")).limit(1).first() if kept is not None else None
        if row is None:
            return None
        if row["config"] != self.config:
            raise StateMismatch(f"{self.path} has steps of {row['config']}, not of {self.config}")
        return Step(row["step"], np.array(row["theta"]), np.array(row["theta_old"]), row["loss"], row["rate"],
                    json.loads(row["rule"]), row["finished"])

    def trace(self, through: int) -> list[tuple[int, float, float]]:
        """``(step, loss, rate)`` of the steps up to one."""
        kept = self.rows().where(F.col("step") <= through).select("step", "trace_loss", "trace_rate")
        return sorted(map(tuple, kept.collect()))          # one row per step
