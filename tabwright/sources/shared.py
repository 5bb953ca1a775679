"""Small results that several later steps need, kept in the shared folder.

Several operators work in two steps: a pass that aggregates the data to a small table
(class counts, group parameters, cut points) and a pass that uses that table row by row.
``settle`` writes such a table below ``spark.checkpoint.dir`` and reads it back. That
gives three things: the first pass is not repeated by every use, a lost executor cannot
undo it, and Spark knows the real size of the table - so a join against it is broadcast
only when the size is below ``spark.sql.autoBroadcastJoinThreshold``, and is a
sort-merge join with skew splitting otherwise. No join in this package carries a hint.

What a run settles can be given back: inside ``run_scope`` all such tables go to a folder
of the run, which is removed when the scope ends. Results that outlive the run are written
elsewhere before that. Copies of a stage stay until newer ones are complete.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}
#: Open runs of each application, the innermost last.
_RUNS: dict[str, list[str]] = {}
_NO_RUN = "loose"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tabwright-")
    return _LOCAL[application]


def settle(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the written table."""
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/settled/{current_run(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_stored(df: DataFrame) -> bool:
    """Is this a table in files, of which at most columns are chosen, cast or renamed?"""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return plan.nodeName().startswith(("LogicalRelation", "Relation"))


def settle_with(df: DataFrame, path: str | None = None, /, **facts: Column) -> tuple[DataFrame, dict[str, Any]]:
    """``settle``, and aggregates over the written rows that cost no job of their own.

    The aggregates stand on top of the plan, in the tasks that write. Spark counts those
    once however often tasks or the stages below run.
    """
    watch = Observation()
    written = settle(df.observe(watch, *[fact.alias(name) for name, fact in facts.items()]), path)
    found = watch.get
    if len(found) < len(facts):  # a plan that Spark finds to be empty is not observed
        found = written.agg(*[fact.alias(name) for name, fact in facts.items()]).first().asDict()
    return written, found


def checkpoint_stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Keep the output of a stage under its name and go on from the written copy.

    Writing the same name again makes a new copy next to the old one, so a stage can be
    repeated while something still reads the earlier copy. ``newest_stage`` finds the last
    complete one, ``sweep_stages`` removes those before it.
    """
    copy = f"{time.time_ns():020d}-{current_run(df.sparkSession)}-{uuid.uuid4().hex[:8]}"
    return settle(df, f"{_stages(df.sparkSession, folder)}/{name}/{copy}")


# --- how long files live ------------------------------------------------------------------


def current_run(spark: SparkSession) -> str:
    runs = _RUNS.get(spark.sparkContext.applicationId)
    return runs[-1] if runs else _NO_RUN


@contextmanager
def run_scope(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Remove what is settled inside when the scope ends.

    Copies of stages go with it if the run ends well; after an error they stay, complete
    ones for going on from, until ``sweep_stages``.
    """
    run = f"{name}-{uuid.uuid4().hex}"
    runs = _RUNS.setdefault(spark.sparkContext.applicationId, [])
    runs.append(run)
    try:
        yield run
        remove(spark, [p for stage in listed(spark, _stages(spark)) for p in listed(spark, stage) if f"-{run}-" in p])
    finally:
        runs.remove(run)
        release(spark, run)


def release(spark: SparkSession, run: str = _NO_RUN) -> None:
    """Remove the tables that a run settled; by default those outside any run."""
    remove(spark, [f"{shared_folder(spark)}/settled/{run}"])


def newest_stage(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame | None:
    """The last complete copy of a stage."""
    copies = _complete(spark, f"{_stages(spark, folder)}/{name}")
    return spark.read.parquet(copies[-1]) if copies else None


def sweep_stages(spark: SparkSession, folder: str | None = None, keep: int = 1) -> None:
    """Leave the last ``keep`` complete copies of each stage, and what is newer than them."""
    for stage in listed(spark, _stages(spark, folder)):
        complete = _complete(spark, stage)
        if len(complete) >= keep > 0:
            first = complete[-keep]
            remove(spark, [p for p in listed(spark, stage) if p < first])


def _stages(spark: SparkSession, folder: str | None = None) -> str:
    return (folder or f"{shared_folder(spark)}/stages").rstrip("/")


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path, wherever the shared folder is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder, by name; nothing if there is none."""
    files, place = _files(spark, path)
    return sorted(s.getPath().toString() for s in files.listStatus(place)) if files.exists(place) else []


def _complete(spark: SparkSession, stage: str) -> list[str]:
    return [p for p in listed(spark, stage) if any(f.endswith("/_SUCCESS") for f in listed(spark, p))]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove files or folders; those that are not there do not matter."""
    for path in paths:
        files, place = _files(spark, path)
        files.delete(place, True)
