"""Run counters, run summaries and the reject log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the jobs in logs, run states and messages.
DEFAULTER_JOB, MONTHLY_JOB = "RETURN_DEFAULTER", "MONTHLY_ANALYTICS"
CLEAN = ("COMPLETED", "Completed successfully")
RUNNING = ("RUNNING", "Run started")
WITH_REJECTS = ("COMPLETED_WITH_ERRORS", "Completed with quarantined invalid source records")


def _shape(texts: str, counts: str) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in texts.split()]
    return T.StructType(fields + [T.StructField(name, T.LongType()) for name in counts.split()])


#: stored columns of the run logs
RUN_LOG = _shape(
    "run_id job_name ret_period status message",
    "total_eligible scanned written skipped not_filed filed_late filed_on_time notice_eligible",
)
REVENUE_RUN_LOG = _shape(
    "run_id ret_period status message",
    "source_rows source_gstins offices_processed unmapped_registrations unmapped_jurisdictions duplicate_mappings",
)
MONTHLY_LOG = _shape(
    "run_id job_name ret_period status message", "source_rows growth_rows scored failed missing_dates"
)


def _count(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def reject_log(rejects: DataFrame, run_id: str, run_at: dt.datetime, job: str = DEFAULTER_JOB) -> DataFrame:
    """Rows to append to the reject log; codes and texts are kept whole."""
    return rejects.select(
        F.lit(run_id).alias("run_id"),
        F.lit(job).alias("job_name"),
        "gstin",
        "ret_period",
        "error_code",
        "error_message",
        F.lit(0).alias("retry_count"),
        F.lit(run_at).cast("timestamp").alias("created_at"),
    )


def risk_counts() -> list[Column]:
    """Aggregates a run observes on the scored rows it stages, so that counting is no job of its own."""
    failed = F.col("reject_reason").isNotNull()
    return [F.count(F.lit(1)).alias("rows_read"), _count(~failed).alias("scored"), _count(failed).alias("failed")]


RESULT_COUNTS = ("written", "not_filed", "filed_late", "filed_on_time", "notice_eligible")


def result_counts() -> list[Column]:
    """Aggregates a run observes on the results it writes."""
    status = F.col("filing_status")
    return [
        F.count(F.lit(1)).alias("written"),
        *[_count(status == name.upper()).alias(name) for name in ("not_filed", "filed_late", "filed_on_time")],
        _count(F.col("notice_eligible") == "Y").alias("notice_eligible"),
    ]


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """Counts a finished write observed; 0 where the rows turned out empty and Spark left their node out of the plan."""
    try:
        return dict(seen.get)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        return dict.fromkeys(names, 0)


def summary_row(run_id: str, period: str, eligible: int, written: Mapping[str, int], skipped: int) -> dict:
    """The row of run_summary from counts observed while writing (result_counts)."""
    state, message = WITH_REJECTS if skipped else CLEAN
    return {
        "run_id": run_id, "job_name": DEFAULTER_JOB, "ret_period": period, "status": state, "total_eligible": eligible,
        "scanned": written["written"] + skipped, **written, "skipped": skipped, "message": message,
    }


def defaulter_counters(results: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row per period: scanned, written, skipped and the counts by status."""
    outcome = results.select("ret_period", "filing_status", "notice_eligible", F.lit(False).alias("skipped"))
    outcome = outcome.unionByName(
        rejects.select("ret_period", F.lit(True).alias("skipped")), allowMissingColumns=True
    )
    status = F.col("filing_status")
    return outcome.groupBy("ret_period").agg(
        F.count(F.lit(1)).alias("scanned"),
        _count(~F.col("skipped")).alias("written"),
        _count(F.col("skipped")).alias("skipped"),
        _count(status == "NOT_FILED").alias("not_filed"),
        _count(status == "FILED_LATE").alias("filed_late"),
        _count(status == "FILED_ON_TIME").alias("filed_on_time"),
        _count(F.col("notice_eligible") == "Y").alias("notice_eligible"),
    )


def risk_counters(scored: DataFrame) -> DataFrame:
    """One row per period: returns read, scored and failed, and the failed percent."""
    counts = scored.groupBy("ret_period").agg(*risk_counts())
    return counts.withColumn("failed_percent", F.col("failed") * 100.0 / F.col("rows_read"))


def run_summary(counters: DataFrame, eligible: DataFrame, run_id: str) -> DataFrame:
    """Final row of a defaulter run: population, counters, state and message.

    Starts from the population, so a run without candidates has its row, with counts of 0.
    """
    counts = ["scanned", "written", "skipped", "not_filed", "filed_late", "filed_on_time", "notice_eligible"]
    skipped = F.coalesce(F.col("skipped"), F.lit(0)) > 0
    state = F.when(skipped, WITH_REJECTS[0]).otherwise(CLEAN[0])
    message = F.when(skipped, WITH_REJECTS[1]).otherwise(CLEAN[1])
    return eligible.join(counters, "ret_period", "left").select(
        F.lit(run_id).alias("run_id"),
        F.lit(DEFAULTER_JOB).alias("job_name"),
        "ret_period",
        state.alias("status"),
        F.coalesce(F.col("eligible"), F.lit(0)).alias("total_eligible"),
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts],
        message.alias("message"),
    )


def revenue_run_summary(precheck: DataFrame, offices: DataFrame, run_id: str) -> DataFrame:
    """Final row of an office run per period: source counts, mapping gaps and offices written."""
    written = offices.groupBy("ret_period").agg(F.count(F.lit(1)).alias("offices_processed"))
    return precheck.join(written, "ret_period", "left").select(
        F.lit(run_id).alias("run_id"),
        "ret_period",
        F.lit("SUCCESS").alias("status"),
        "source_rows",
        "source_gstins",
        F.coalesce("offices_processed", F.lit(0)).alias("offices_processed"),
        "unmapped_registrations",
        "unmapped_jurisdictions",
        "duplicate_mappings",
        F.lit("Office revenue batch completed successfully").alias("message"),
    )


def run_row(
    spark: SparkSession, shape: T.StructType, run_id: str, period: str, state: tuple[str, str], counters: dict | None = None
) -> DataFrame:
    """Row of a run in a state, with its message and what was counted so far; other counters are empty."""
    known = {"run_id": run_id, "ret_period": period, "status": state[0], "message": state[1]}
    if "job_name" in shape.fieldNames():
        known["job_name"] = MONTHLY_JOB if shape == MONTHLY_LOG else DEFAULTER_JOB
    known |= {name: value for name, value in (counters or {}).items() if name in shape.fieldNames() and name not in known}
    return spark.createDataFrame([tuple(known.get(name) for name in shape.fieldNames())], shape)


def latest_runs(runs: DataFrame, keys: Sequence[str] = ("job_name", "ret_period")) -> DataFrame:
    """The newest run row per key. Of one run its final row; runs of the same instant are decided by run id."""
    order = [F.col("started_at").desc_nulls_last(), F.col("run_id").desc()]
    if "finished_at" in runs.columns:
        order.append(F.col("finished_at").desc_nulls_last())
    order = Window.partitionBy(*keys).orderBy(*order)
    return runs.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")
