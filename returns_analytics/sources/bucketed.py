"""Tables stored by taxpayer: joins and picks on gstin read them without moving a row.

A table bucketed by gstin is partitioned that way when it is scanned. A merge by taxpayer, the pick of one return
per taxpayer and the joins of a candidate then exchange only what is new; tables with the same number of
buckets meet each other without any exchange. The number of buckets is that of the largest table's tasks and has
to be the same for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

KEY = "gstin"


def save(table: DataFrame, name: str, path: str, buckets: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store a table under a catalog name, bucketed and sorted by gstin; returns it as stored. Eager.

    Rows are dealt to the buckets' tasks first, so a task writes one bucket and there is one file per bucket
    (and partition).
    """
    rows = table.repartition(buckets, KEY)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(KEY)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return read(table.sparkSession, name)


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
