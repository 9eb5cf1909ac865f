"""Stage folder: written tables that cut lineage.

A stage table is read by several outputs, so it is computed once, survives lost
executors, and keeps values such as row slots fixed. The folder is the one the
cluster names in spark.checkpoint.dir.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from faturaflow.sources import files

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="faturaflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


class Stage:
    """Named Parquet tables under one folder, which is that of one run or batch. A table that an
    earlier attempt of the run completed is reused, not recomputed: a replay goes on from it and
    gives the same numbers. A name is written once per run; a second frame under it raises."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_root(spark)}/stage-{uuid.uuid4().hex}"
        self._names: set[str] = set()

    def table(self, name: str, df: DataFrame) -> DataFrame:
        if name in self._names:
            raise ValueError(f"stage table {name!r} belongs to an earlier run; use a stage of your own")
        self._names.add(name)
        path = f"{self.folder}/{name}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the folder, once everything that reads its tables is written."""
        files.delete(self.spark, self.folder)
