"""Distinct taxpayers over any span of months from stored bitmaps.

A distinct count of a quarter is no sum of its months: a taxpayer who filed twice counts once. Counting from the
returns reads all of them again for every span. Here every taxpayer has a dense number once and for all,
and per period and office the numbers are kept as bits (4 KB for 32,768 numbers). Bitmaps merge by OR, partially
on the map side, so quarters, years and all offices together are counted from the stored bits alone.

Numbers follow the order of the keys, which begin with the state, so the taxpayers of an office share few
bitmaps. New taxpayers are numbered behind the known ones; a number never changes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.functions.periods import first_day, is_valid_period
from returns_analytics.operators.office import dealer_offices, dealers_in_period
from returns_analytics.sources.sinks import stage
from returns_analytics.sources.tables import period_slices


def taxpayer_ids(taxpayers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(gstin, id) of all taxpayers, ids 0, 1, 2, ...; those of ``known`` stay. Eager.

    Keys are range-partitioned and numbered within each partition, shifted by the rows of the partitions before: no
    task sees all of them. The partitions are staged, because their bounds are sampled anew each time.
    """
    fresh = taxpayers.select("gstin").filter(F.col("gstin").isNotNull()).distinct()
    start = F.lit(0).cast("bigint")
    if known is not None:
        fresh = fresh.join(known.select("gstin"), "gstin", "left_anti")
        start = F.coalesce(known.agg(F.max("id") + 1).scalar(), start)
    parts = stage(fresh.repartitionByRange("gstin").withColumn("part", F.spark_partition_id()))
    # one row per partition
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(before, F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("part").orderBy("gstin")) - 1
    numbered = parts.withColumn("number", number).join(F.broadcast(offsets), "part").select(
        "gstin", (start + F.col("offset") + F.col("number")).alias("id"))
    return numbered if known is None else known.select("gstin", "id").unionByName(numbered)


def filer_bitmaps(
    summary: DataFrame, ids: DataFrame, dealer: DataFrame, juri: DataFrame, periods: Iterable[str] | None = None
) -> DataFrame:
    """(ret_period, st_juri, bucket, bits): the filers of a period in an office of the master, as bits.

    Repeated returns set the same bit. A row per period, office and bucket leaves each task.
    """
    wanted = None if periods is None else list(periods)
    codes = juri.select(F.col("jurisdiction_code").alias("st_juri"))
    placed = (
        dealer_offices(dealers_in_period(dealer, summary, wanted))
        .join(codes, "st_juri", "left_semi")
        .join(ids, "gstin")
        .select("gstin", "st_juri", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"))
    )
    filers = period_slices(summary, wanted).filter(is_valid_period(F.col("ret_period"))).select("gstin", "ret_period")
    return (
        filers.join(placed, "gstin")
        .groupBy("ret_period", "st_juri", "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def with_calendar(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps with the year (text) and the quarter (1 to 4) of their period."""
    day = first_day(F.col("ret_period"))
    return bitmaps.withColumns({"year": F.substring("ret_period", 3, 4), "quarter": F.quarter(day)})


def distinct_filers(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Number of different taxpayers per group of the given columns."""
    return (
        bitmaps.groupBy(*by, "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        .groupBy(*by)
        .agg(F.sum(F.bitmap_count("bits")).alias("filed_gstins"))
    )
