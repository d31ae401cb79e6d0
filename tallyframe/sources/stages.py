"""Intermediate results of a run, in folders that carry the run's id."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A folder of a run that left no audit row is taken for a dead writer's after so many days.
DEAD_AFTER_DAYS = 7.0


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


class Stage:
    """What one run keeps between its steps, below ``{place}/{run_id}``; drop() removes it.

    A step is done when its folder says so. A run may take over what a lost run has
    done (``resumed``, its id), as long as its journal is that of the same work.
    """

    def __init__(self, spark: SparkSession, place: str, run_id: str, work: str = "", resumed: str | None = None):
        self._spark, self._folder, self._work = spark, f"{place}/{run_id}", work
        self._before = f"{place}/{resumed}" if resumed else None
        if self._before:
            found = spark.read.parquet(f"{self._before}/journal").first().work if self._done(self._before, "journal") else None
            if found != work:
                raise ValueError("The run to go on from is gone, or was about another source or contract")

    def _done(self, folder: str, name: str) -> bool:
        path, system = _path(self._spark, f"{folder}/{name}/_SUCCESS")
        return system.exists(path)

    def begin(self) -> None:
        """Note what the run is about."""
        self._spark.range(0, 1, 1, 1).select(F.lit(self._work).alias("work")).write.mode("overwrite").parquet(f"{self._folder}/journal")

    def keep(self, rows: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        """rows, written and read again; those of the lost run if it had got so far."""
        folder = f"{self._folder}/{name}"
        if self._before and self._done(self._before, name):
            folder = f"{self._before}/{name}"
        else:
            writer = rows.write.mode("overwrite")
            (writer.partitionBy(partition) if partition else writer).parquet(folder)
        return self._spark.read.schema(rows.schema).parquet(folder)

    def drop(self) -> None:
        for folder in (self._folder, self._before):
            if folder:
                path, system = _path(self._spark, folder)
                system.delete(path, True)


def lost_runs(spark: SparkSession, place: str, runs: DataFrame, steps: tuple[str, ...]) -> dict[str, list[str]]:
    """Runs with a stage and no row in ``runs``, and the steps that each has done."""
    path, system = _path(spark, place)
    if not system.exists(path):
        return {}
    found = sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory())
    ended = {r.run_id for r in runs.select("run_id").where(F.col("run_id").isin(*found)).distinct().collect()} if found else set()

    def done(run: str) -> list[str]:
        return [s for s in steps if system.exists(_path(spark, f"{place}/{run}/{s}/_SUCCESS")[0])]

    return {run: done(run) for run in found if run not in ended}


def drop_dead(spark: SparkSession, place: str, runs: DataFrame, days: float = DEAD_AFTER_DAYS, but: str | None = None) -> list[str]:
    """Remove the stages of runs that are over; returns their ids.

    Over are runs with a row in ``runs``, and runs without one whose folder has
    not changed for ``days``: a writer that works has no row yet. Nothing but
    folders in ``place`` is touched, and not that of the run ``but``.
    """
    path, system = _path(spark, place)
    if not system.exists(path):
        return []
    found = {s.getPath().getName(): s for s in system.listStatus(path) if s.isDirectory()}
    if not found:
        return []
    ended = {r.run_id for r in runs.select("run_id").where(F.col("run_id").isin(*found)).distinct().collect()}
    limit = (time.time() - days * 86400) * 1000
    dead = [name for name, s in found.items() if name != but and (name in ended or s.getModificationTime() < limit)]
    for name in dead:
        system.delete(found[name].getPath(), True)
    return sorted(dead)
