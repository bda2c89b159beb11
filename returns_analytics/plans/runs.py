"""Runs: compute a period and store the result. Everything here is eager.

A run computes the full new state of its periods and publishes it at once (sources.published). Running a period
again gives the same state; late returns need less, see run_late_returns. What a run stages on the way is removed
when it ends, also by an error.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returns_analytics.errors import GateFailed
from returns_analytics.functions.bands import RISK_THRESHOLDS
from returns_analytics.functions.periods import shift_period
from returns_analytics.operators import defaulters, late, quality, risk, runs
from returns_analytics.operators.trees import TreeModel
from returns_analytics.operators.upsert import stale_keys
from returns_analytics.plans import pipelines
from returns_analytics.schemas import OFFICE_KEY, TAXPAYER_KEY
from returns_analytics.sources.published import Published
from returns_analytics.sources.sinks import Staging, append_log
from returns_analytics.sources.tables import period_slice, period_slices, require_registration, require_rows


@dataclass(frozen=True)
class Inputs:
    """The source tables of a run."""

    summary: DataFrame
    registration: DataFrame
    dealer: DataFrame
    juri: DataFrame
    due: DataFrame


@dataclass(frozen=True)
class Store:
    """Where the results are kept: one folder per table under a root; logs are plain parquet."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, spark: SparkSession, name: str) -> Published:
        return Published(spark, self.path(name))

    def read(
        self, spark: SparkSession, name: str, columns: T.StructType, periods: Sequence[str] | None = None
    ) -> DataFrame:
        """A stored table, or some of its periods; an empty one before its first write."""
        return self.table(spark, name).read(columns, periods)


def _stored_schema(rows: DataFrame, **extra: T.DataType) -> T.StructType:
    """Columns of a stored table: those of its rows and the ones a merge adds."""
    fields = [T.StructField(field.name, field.dataType, True) for field in rows.schema.fields]
    return T.StructType(fields + [T.StructField(name, kind, True) for name, kind in extra.items()])


_TIME = T.TimestampType()


def growth_schema(rows: DataFrame) -> T.StructType:
    return _stored_schema(rows, created_at=_TIME, updated_at=_TIME)


def risk_schema(profile: DataFrame) -> T.StructType:
    return _stored_schema(profile, batch_id=T.LongType(), processed_at=_TIME, created_at=_TIME, updated_at=_TIME)


def defaulter_schema(results: DataFrame) -> T.StructType:
    return _stored_schema(
        results, active_flag=T.StringType(), notice_status=T.StringType(), first_detected_at=_TIME,
        last_evaluated_at=_TIME, created_at=_TIME, updated_at=_TIME,
    )


def office_schema(offices: DataFrame) -> T.StructType:
    return _stored_schema(offices, created_at=_TIME, updated_at=_TIME)


@dataclass(frozen=True)
class MonthlyOutcome:
    period: str
    source_rows: int
    growth_rows: int
    scored: int
    failed: int
    missing_dates: int


def run_monthly(
    inputs: Inputs,
    store: Store,
    model: TreeModel,
    period: str,
    run_at: dt.datetime,
    batch_id: int,
    thresholds: Sequence[float] = RISK_THRESHOLDS,
    max_failure_percent: float = 1.0,
    unique_rows: bool = False,
) -> MonthlyOutcome:
    """Growth and then risk of one period. A period without returns stores nothing but its log rows.

    ``unique_rows``: no taxpayer has two rows at one date (quality.has_unique_dates looks), see operators.growth.

    The run is logged when it starts and when it ends or stops, with what was counted so far.
    """
    with _logged(store, inputs.summary.sparkSession, "monthly_runs", runs.MONTHLY_LOG, str(batch_id), period, run_at) as counted:
        with Staging(inputs.summary.sparkSession) as stage:
            _store_month(
                inputs, store, model, period, run_at, batch_id, thresholds, max_failure_percent, unique_rows, counted, stage)
    return MonthlyOutcome(period, *[counted[name] for name in ("source_rows", "growth_rows", "scored", "failed", "missing_dates")])


def _store_month(
    inputs: Inputs,
    store: Store,
    model: TreeModel,
    period: str,
    run_at: dt.datetime,
    batch_id: int,
    thresholds: Sequence[float],
    max_failure_percent: float,
    unique_rows: bool,
    counted: dict,
    stage: Staging,
) -> None:
    summary, spark = inputs.summary, inputs.summary.sparkSession
    counted |= dict.fromkeys(("source_rows", "growth_rows", "scored", "failed", "missing_dates"), 0)
    counts = quality.source_counts(summary, [period]).first()
    if counts is None:
        return
    counted["source_rows"] = counts.source_rows
    counted["missing_dates"] = quality.missing_period_dates(summary, [period]).first().missing_dates

    # rows are counted by the write that stages them
    seen = Observation()
    growth = pipelines.growth_analytics(summary, [period], unique_rows)
    growth = stage(growth.observe(seen, F.count(F.lit(1)).alias("rows")))
    quality.require_unique(growth, TAXPAYER_KEY)
    stored = store.read(spark, "growth", growth_schema(growth), [period])
    store.table(spark, "growth").publish(pipelines.merge_growth(stored, growth, run_at), [period])
    counted["growth_rows"] = runs.observed(seen, "rows")["rows"]

    seen = Observation()
    scored = risk.scored_returns(summary, model, [period]).select("gstin", "ret_period", "risk_score", "reject_reason")
    scored = stage(scored.observe(seen, *runs.risk_counts()))
    read = runs.observed(seen, "rows_read", "scored", "failed")
    counted |= {"scored": read["scored"], "failed": read["failed"]}
    quality.enforce_failure_limit(read["rows_read"], read["failed"], max_failure_percent)
    profile, _ = risk.risk_profile_of(scored, model, thresholds)
    quality.require_unique(profile, TAXPAYER_KEY)
    stored = store.read(spark, "risk", risk_schema(profile), [period])
    store.table(spark, "risk").publish(pipelines.merge_risk(stored, profile, run_at, batch_id), [period])


def run_late_returns(
    inputs: Inputs, store: Store, changes: DataFrame, run_at: dt.datetime
) -> dict[str, int]:
    """Bring the stored growth up to date with changed returns (operators.late), all periods they reach at once.

    ``inputs.summary`` holds the new state and ``changes`` the (gstin, changed_date) at which it differs. Returns the
    number of rows computed and of periods replaced; nothing is written where nothing changed.
    """
    spark = inputs.summary.sparkSession
    with Staging(spark) as stage:
        changes = stage(changes)
        if changes.isEmpty():
            return {"rows": 0, "periods": 0}
        seen = Observation()
        rows = late.late_growth(inputs.summary, changes)
        columns = growth_schema(rows)
        rows = stage(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        quality.require_unique(rows, TAXPAYER_KEY)
        stored = store.read(spark, "growth", columns)
        reached = late.reached_rows(stored, changes).select("ret_period").unionByName(rows.select("ret_period"))
        # one row per period
        periods = sorted(r.ret_period for r in reached.distinct().collect())
        known = {f"ret_period={p}" for p in periods} & set(store.table(spark, "growth").state().versions)
        # periods no run has stored yet are left to their run
        periods = [p for p in periods if f"ret_period={p}" in known]
        stored = store.read(spark, "growth", columns, periods)
        merged = late.merge_late_growth(stored, period_slices(rows, periods), changes, run_at)
        store.table(spark, "growth").publish(merged, periods)
        return {"rows": runs.observed(seen, "rows")["rows"], "periods": len(periods)}


def run_defaulters(
    inputs: Inputs,
    store: Store,
    growth: DataFrame,
    risk_rows: DataFrame,
    period: str,
    as_of: dt.date,
    run_at: dt.datetime,
    run_id: str,
    months: int = defaulters.HISTORY_MONTHS_DEFAULT,
) -> dict:
    """Evaluate a period, merge the results, log the rejects, and return the run summary.

    A run begins once its due date is known and its registrations are there; what fails before is raised
    and not logged. From then on a run that stops is logged as failed, with what was counted so far,
    and the error passed on.
    """
    due_date = defaulters.required_due_date(inputs.due, period)
    require_registration(inputs.registration, period)
    with _logged(store, inputs.summary.sparkSession, "runs", runs.RUN_LOG, run_id, period, run_at) as counted:
        with Staging(inputs.summary.sparkSession) as stage:
            return _evaluate_period(
                inputs, store, growth, risk_rows, period, due_date, as_of, run_at, run_id, months, counted, stage)


def _evaluate_period(
    inputs: Inputs,
    store: Store,
    growth: DataFrame,
    risk_rows: DataFrame,
    period: str,
    due_date: dt.date,
    as_of: dt.date,
    run_at: dt.datetime,
    run_id: str,
    months: int,
    counted: dict,
    stage: Staging,
) -> dict:
    spark = inputs.summary.sparkSession
    warning = quality.coverage_warning(growth, inputs.summary, period)
    eligible = defaulters.eligible_count(inputs.registration, period).withColumn("ret_period", F.lit(period))
    counted["total_eligible"] = eligible.first().eligible

    # the candidates' own earlier results are their history: read it before anything is written
    shape = defaulters.results_of(
        defaulters.checked_candidates(
            defaulters.defaulter_candidates(
                inputs.registration, inputs.summary, growth, risk_rows, _no_history(spark), inputs.juri, period,
                due_date, months,
            )
        ),
        as_of,
    )
    stored = store.read(spark, "defaulters", defaulter_schema(shape))
    checked = stage(defaulters.checked_candidates(
        defaulters.defaulter_candidates(
            inputs.registration, inputs.summary, growth, risk_rows, stored, inputs.juri, period, due_date, months
        )
    ))
    bad = quality.bad_taxpayer_keys(checked).first()
    if bad is not None:
        raise GateFailed(f"taxpayer {bad.gstin} comes out {bad.n} times; growth, risk or jurisdictions hold duplicates")

    # counted by the writes themselves: results where they are merged, rejects where they are logged
    kept, set_aside = Observation(), Observation()
    results = defaulters.results_of(checked, as_of).observe(kept, *runs.result_counts())
    rejects = defaulters.rejects_of(checked).observe(set_aside, F.count(F.lit(1)).alias("skipped"))
    target = store.read(spark, "defaulters", defaulter_schema(shape), [period])
    store.table(spark, "defaulters").publish(pipelines.merge_defaulters(target, results, run_at))
    append_log(runs.reject_log(rejects, run_id, run_at), store.path("rejects"))
    written, skipped = runs.observed(kept, *runs.RESULT_COUNTS), runs.observed(set_aside, "skipped")["skipped"]
    counted |= runs.summary_row(run_id, period, counted["total_eligible"], written, skipped)
    counted["state"] = (counted["status"], counted["message"])
    return {n: v for n, v in counted.items() if n != "state"} | {"warnings": [warning] if warning else []}


@contextmanager
def _logged(
    store: Store,
    spark: SparkSession,
    table: str,
    shape: T.StructType,
    run_id: str,
    period: str,
    run_at: dt.datetime,
    done: tuple[str, str] = runs.CLEAN,
) -> Iterator[dict]:
    """Log a run as running, then as ended or failed. Gives the dict the run writes its counters to.

    Its entry ``state`` replaces the state and message of a run that ended. Both rows of a run share their
    start; the final one has the time it finished.
    """
    counted: dict = {}
    began = time.monotonic()

    def log(state: tuple[str, str], finished: dt.datetime | None) -> None:
        rows = runs.run_row(spark, shape, run_id, period, state, counted)
        times = (("started_at", run_at), ("finished_at", finished))
        append_log(rows.withColumns({n: F.lit(t).cast("timestamp") for n, t in times}), store.path(table))

    def finished() -> dt.datetime:
        return run_at + dt.timedelta(seconds=time.monotonic() - began)

    log(runs.RUNNING, None)
    try:
        yield counted
    except Exception as error:
        log(("FAILED", str(error)), finished())
        raise
    log(counted.pop("state", done), finished())


def _no_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "gstin string, ret_period string, filing_status string, active_flag string"
    )


def run_office_revenue(
    inputs: Inputs, store: Store, period: str, run_at: dt.datetime, run_id: str
) -> dict:
    """Check the sources, compute the offices of a period, and store them all or not at all.

    The run is logged when it starts and when it ends or stops, with what was counted so far.
    """
    spark = inputs.summary.sparkSession
    with _logged(store, spark, "revenue_runs", runs.REVENUE_RUN_LOG, run_id, period, run_at) as counted:
        with Staging(spark) as stage:
            return _replace_offices(inputs, store, period, run_at, run_id, counted, stage)


def _replace_offices(
    inputs: Inputs, store: Store, period: str, run_at: dt.datetime, run_id: str, counted: dict, stage: Staging
) -> dict:
    spark = inputs.summary.sparkSession
    require_rows(period_slice(inputs.summary, period), f"summary of {period}")
    precheck = stage(quality.office_precheck(inputs.summary, inputs.dealer, inputs.juri, [period]))
    for row in precheck.collect():  # one row: a single period
        counted |= row.asDict()
    warnings = quality.enforce_precheck(precheck)

    plan = pipelines.office_revenue(inputs.summary, inputs.dealer, inputs.juri, None, [period])
    stored = store.read(spark, "offices", office_schema(plan))
    # the months that growth and averages of the period look at
    reach = [shift_period(period, -back) for back in range(13)]
    months = quality.duplicate_office_months(stored.filter(F.col("ret_period").isin(reach))).first()
    if months is not None:
        raise GateFailed(f"office {months.st_juri} is stored {months.n} times for one month")
    offices = stage(pipelines.office_revenue(inputs.summary, inputs.dealer, inputs.juri, stored, [period]))
    require_rows(offices, f"mapped offices of {period}")
    target = period_slice(stored, period)
    stale = stale_keys(target, offices, OFFICE_KEY).count()
    summary = runs.revenue_run_summary(precheck, offices, run_id).first()
    counted |= summary.asDict()
    store.table(spark, "offices").publish(pipelines.merge_offices(target, offices, run_at), [period])
    counted["state"] = (summary.status, summary.message)
    return summary.asDict() | {"stale_deleted": stale, "warnings": warnings}
