"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="tallyframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Seconds between two collections of the driver's garbage while its heap is below this share of its limit.
COLLECT_EVERY, CROWDED = 10.0, 0.75


class Scratch:
    """Tables of one run, written as Parquet, which survive the loss of executors.

    What a lazy result still reads must stay; drop() is for tables that are
    no longer needed. The folder itself belongs to whoever empties the
    checkpoint folder.
    """

    _collected = -COLLECT_EVERY

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """df, written once and read again."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        self._collect()
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def measured(self, df: DataFrame, **values: Column) -> tuple[DataFrame, dict]:
        """df kept, and aggregates of its rows, taken while they are written: they need no job of their own."""
        seen = Observation()
        kept = self.keep(df.observe(seen, *[value.alias(name) for name, value in values.items()]))
        return kept, seen.get

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that keep() returned, and let Spark clean up behind them."""
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._collect()

    def _collect(self) -> None:
        """Collect the driver's garbage.

        That is when Spark forgets the shuffles and broadcasts of finished steps, and
        deletes their files. Many small steps leave much of that and little
        other garbage, and plans of finished steps would fill the heap to its limit.
        A collection after each of many short steps does the same: the JVM takes
        the time that it spends collecting for a sign of too small a heap.
        """
        heap = self.spark._jvm.java.lang.Runtime.getRuntime()
        if time.monotonic() - Scratch._collected < COLLECT_EVERY and heap.totalMemory() < CROWDED * heap.maxMemory():
            return
        gc.collect()
        self.spark._jvm.System.gc()
        Scratch._collected = time.monotonic()
