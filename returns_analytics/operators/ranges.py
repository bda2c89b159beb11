"""Ordered pages and equal-depth key ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.functions.keys import normalise
from returns_analytics.sources.sinks import stage


def _positive(size: int, what: str) -> int:
    if size <= 0:
        raise ValueError(f"{what} must be positive, not {size}")
    return size


def page_after(rows: DataFrame, key: str, size: int, start_after: str | None = None) -> DataFrame:
    """The first rows by key, optionally after a key (compared trimmed and in upper case).

    The limit is the feature here, and the size is taken as given; Spark keeps the first rows of each partition only.
    """
    if start_after is not None and start_after.strip():
        rows = rows.filter(normalise(F.col(key)) > start_after.strip().upper())
    return rows.orderBy(key).limit(_positive(size, "the page size"))


def key_slice(rows: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Rows of one range, both ends included."""
    return rows.filter(F.col(key).between(first, last))


def range_count(total_rows: int, rows_per_range: int) -> int:
    """Number of ranges that hold about the given number of rows each."""
    return max(1, -(-total_rows // _positive(rows_per_range, "the rows of a range")))


def _bucket(position: str, n: int) -> Column:
    """Bucket of a row position (from 1): the first ``total mod n`` buckets hold one row more."""
    boundary = f"(total % {n}) * (total div {n} + 1)"
    return F.expr(
        f"case when {position} <= {boundary} then ({position} - 1) div (total div {n} + 1) + 1 "
        f"else total % {n} + ({position} - 1 - {boundary}) div (total div {n}) + 1 end"
    )


def _bucket_start(bucket: str, n: int) -> Column:
    """Position of the first row of a bucket."""
    return F.expr(f"({bucket} - 1) * (total div {n}) + least({bucket} - 1, total % {n}) + 1")


def equi_depth_ranges(rows: DataFrame, key: str, n: int, partitions: int | None = None) -> DataFrame:
    """Lowest key, highest key and row count of n ranges of equal depth over the ordered rows.

    Same result as NTILE(n) over the whole table, but no task ever sees the whole order: keys are
    counted (a key with very many rows becomes one counter), range-partitioned, numbered within
    each partition, and shifted by the rows of the partitions before. A key then covers an
    interval of positions and is counted in every range it reaches into. The range-partitioned
    counters are staged (eager), because range bounds are sampled anew each time they are computed.
    """
    tasks = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    parts = stage(
        counted.repartitionByRange(tasks, F.col("key").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    # one row per partition: bounded by the number of tasks, whatever the data
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part").agg(F.sum("n").alias("rows"))
    offsets = sums.select(
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    within = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (
        parts.withColumn("upto", F.sum("n").over(within))
        .join(F.broadcast(offsets), "part")
        .withColumn("last", F.col("offset") + F.col("upto"))
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    spread = (
        placed.withColumn("first_bucket", _bucket("first", n))
        .withColumn("last_bucket", _bucket("last", n))
        .withColumn("bucket", F.explode(F.sequence("first_bucket", "last_bucket")))
    )
    inside = (
        F.least(F.col("last"), _bucket_start("(bucket + 1)", n) - 1)
        - F.greatest(F.col("first"), _bucket_start("bucket", n))
        + 1
    )
    return spread.withColumn("inside", inside).groupBy("bucket").agg(
        F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("inside").alias("rows")
    )
