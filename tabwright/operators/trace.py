"""Rows that pass each step of a lazy plan, counted while the plan runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RowTrace:
    """Rows in, out and removed per step, without a scan of their own.

    ``step`` marks a place in a plan; the rows that pass there are counted by the job that
    runs the plan, which must be one job (a written stage). ``known`` adds a step whose
    rows are known otherwise. Filters above a mark are not moved below it, so marks stand
    after the filters that belong in the scan. A task that Spark runs again because its
    shuffle files were lost counts its rows again; ``stage_row_counts`` over written
    stages is exact then too.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation | int]] = []

    def step(self, name: str, df: DataFrame) -> DataFrame:
        watch = Observation()
        self._steps.append((name, watch))
        return df.observe(watch, F.count(F.lit(1)).alias("rows"))

    def known(self, name: str, rows: int) -> None:
        self._steps.append((name, rows))

    def report(self, spark: SparkSession) -> DataFrame:
        """``step, stage, rows_in, rows_out, rows_removed``; waits until the plan has run."""
        rows, before = [], None
        for i, (name, seen) in enumerate(self._steps):
            # Spark leaves out what it finds to be empty, and the count with it.
            out = seen if isinstance(seen, int) else seen.get.get("rows", 0)
            came = out if before is None else before
            rows.append((i, name, came, out, came - out))
            before = out
        return spark.createDataFrame(
            rows, "step int, stage string, rows_in bigint, rows_out bigint, rows_removed bigint"
        )


def traced(trace: RowTrace | None, name: str, df: DataFrame) -> DataFrame:
    """``df``, marked as a step if there is a trace."""
    return df if trace is None else trace.step(name, df)
