"""Writing logs and staged results. Period tables: sources.published."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from returns_analytics.sources.files import Folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a new local one only where all tasks run on this machine."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="returns-checkpoint-"))


def staging_folder(spark: SparkSession) -> str:
    """A folder of this application below the checkpoint folder, reachable from every executor."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{spark.sparkContext.applicationId}"


class Staging:
    """Intermediate results of one run: parquet below the staging folder, gone when the run ends, also by an error.

    Staging cuts the lineage: a lost executor costs a re-read of the staged files only.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._name, self._count = spark, f"run-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Staging:
        return self

    def __call__(self, table: DataFrame) -> DataFrame:
        """Write a table and read it back. Eager."""
        path = f"{staging_folder(self._spark)}/{self._name}/{self._count}"
        self._count += 1
        table.write.parquet(path)
        return self._spark.read.schema(table.schema).parquet(path)

    def __exit__(self, *error: object) -> None:
        Folder(self._spark, staging_folder(self._spark)).delete(self._name)


def stage(table: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder and read it back, for lazy results that outlive the call. Eager.

    The files stay until the folder is cleaned; a run uses Staging.
    """
    ensure_checkpoint_dir(table.sparkSession)
    return table.checkpoint(eager=True)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
