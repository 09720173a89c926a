"""Intermediate tables in the shared folder that `spark.checkpoint.dir` names."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_RUN = "spark.faremeter.run"
_own: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names.

    A session that runs in this process (`local`) and names none, as in tests, gets one here, since Spark takes this
    setting only when it starts. Any other session must name a folder that all executors share.
    """
    global _own
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        configured = _own = _own or tempfile.mkdtemp(prefix="faremeter-")
    return configured.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this session's run inside the shared folder; `clear_scratch` removes it."""
    folder, run = shared_folder(spark), spark.conf.get(_RUN, None)
    if not run:
        run = f"run-{uuid.uuid4().hex}"
        spark.conf.set(_RUN, run)
    return f"{folder}/{run}"


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a DataFrame once as a Parquet table and read it back; a filter on the column `by` reads its own files only.

    This cuts the lineage, fixes the content of expressions that depend on physical row order, keeps a lost executor
    from recomputing earlier rounds, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove a stored table that nothing reads any more; loops call it for what the next step has replaced."""
    spark, found = df.sparkSession, df.inputFiles()
    if found:
        folder = spark._jvm.org.apache.hadoop.fs.Path(found[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this session has stored. Results that read stored tables must be written elsewhere before."""
    folder = scratch_root(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.conf.unset(_RUN)
