"""Tables an operator writes to the shared folder and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from returns_analytics.sources.sinks import staging_folder


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def free_name(name: str, columns: list[str]) -> str:
    """The name, or one like it that no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system Spark reads."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(java, True)


class Scratch:
    """Parquet tables of one operator call, below the folder of ``spark.checkpoint.dir``.

    A stored table cuts the lineage: a lost executor costs a re-read of its files, not the steps
    before. Tables that no later step reads are dropped as soon as possible; the last ones stay
    for the lazy result and go with the folder (``close``).
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._count = 0

    def store(self, table: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self._count}"
        self._count += 1
        # once stored, the shuffles of the table are read by nobody: let Spark remove their files at once
        before = self.spark.conf.get(_CLEAN)
        self.spark.conf.set(_CLEAN, "true")
        try:
            table.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, before)
        stored = self.spark.read.schema(table.schema).parquet(path)
        self._paths[id(stored)] = path
        return stored

    def drop(self, table: DataFrame) -> None:
        path = self._paths.pop(id(table), None)
        if path is not None:
            delete(self.spark, path)

    def close(self) -> None:
        delete(self.spark, self.folder)
