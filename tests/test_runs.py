"""Runs that store their results: once, again, and failing."""

import datetime as dt

import pytest
from helpers import collect
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returns_analytics.errors import DueDateError, GateFailed
from returns_analytics.operators import late, risk, runs, trees
from returns_analytics.parity import oracle
from returns_analytics.plans.runs import Inputs, Store, run_defaulters, run_late_returns, run_monthly, run_office_revenue
from returns_analytics.sources.files import Folder
from returns_analytics.sources.sinks import staging_folder

NOW, LATER = dt.datetime(2000, 8, 15, 1), dt.datetime(2000, 8, 16, 1)
AS_OF = dt.date(2000, 8, 15)


def table(spark, store, name):
    """All columns of a stored table, read through its pointer."""
    published = store.table(spark, name)
    version, part = max((v, k) for k, v in published.state().versions.items())
    columns = spark.read.option("basePath", published.path).parquet(f"{published.path}/{version}/{part}").drop("version").schema
    columns["ret_period"].dataType = T.StringType()
    return published.read(columns)


@pytest.fixture(scope="module")
def inputs(small):
    return Inputs(*[small.table(name) for name in ("summary", "registration", "dealer", "juri", "due")])


@pytest.fixture(scope="module")
def model():
    return trees.load_model(oracle.MODEL_PATH, risk.FEATURES)


def test_monthly_then_defaulters(spark, inputs, model, tmp_path):
    store = Store(str(tmp_path))
    for period in ("052000", "062000"):
        outcome = run_monthly(inputs, store, model, period, NOW, batch_id=1)
        assert outcome.source_rows == outcome.growth_rows == outcome.scored > 0
    again = run_monthly(inputs, store, model, "062000", LATER, batch_id=2)
    assert run_monthly(inputs, store, model, "011990", NOW, batch_id=3).source_rows == 0

    growth, profile = table(spark, store, "growth"), table(spark, store, "risk")
    assert growth.filter("updated_at > created_at").count() == again.growth_rows
    assert {r.batch_id for r in profile.select("batch_id").distinct().collect()} == {1, 2}
    # what runs staged is gone
    assert not [name for name in Folder(spark, staging_folder(spark)).names() if name.startswith("run-")]
    assert {r.ret_period for r in growth.select("ret_period").distinct().collect()} == {"052000", "062000"}

    first = run_defaulters(inputs, store, growth, profile, "062000", AS_OF, NOW, "run-1")
    assert first["scanned"] == first["written"] + first["skipped"] == first["total_eligible"]
    stored = collect(table(spark, store, "defaulters"), "gstin", "default_score", "first_detected_at")
    run_defaulters(inputs, store, growth, profile, "062000", AS_OF, LATER, "run-2")
    rerun = table(spark, store, "defaulters")
    assert collect(rerun, "gstin", "default_score", "first_detected_at") == stored
    assert {(r.notice_status, r.active_flag, r.last_evaluated_at) for r in rerun.collect()} == {("NOT_ISSUED", "Y", LATER)}

    # the results of a period are history of the next one
    nxt = run_defaulters(inputs, store, growth, profile, "072000", dt.date(2000, 9, 15), LATER, "run-3")
    assert nxt["scanned"] > 0
    missing = {r.gstin for r in rerun.filter("filing_status = 'NOT_FILED'").collect()}
    evaluated = table(spark, store, "defaulters").filter("ret_period = '072000'")
    assert {r.gstin for r in evaluated.filter("historical_default_count > 0").collect()} == missing & {
        r.gstin for r in evaluated.collect()}

    log = spark.read.parquet(store.path("runs")).filter("ret_period = '062000'")
    assert [r.run_id for r in runs.latest_runs(log).collect()] == ["run-2"]
    # what fails before a run begins is raised, not logged
    with pytest.raises(DueDateError):
        run_defaulters(inputs, store, growth, profile, "011990", AS_OF, NOW, "run-4")
    assert spark.read.parquet(store.path("runs")).filter("run_id = 'run-4'").isEmpty()
    # a run that stops keeps its counters
    with pytest.raises(GateFailed):
        run_defaulters(inputs, store, growth.unionByName(growth), profile, "062000", AS_OF, LATER, "run-5")
    failed = spark.read.parquet(store.path("runs")).filter("run_id = 'run-5'")
    assert sorted(r.status for r in failed.collect()) == ["FAILED", "RUNNING"]
    failed = failed.filter("status = 'FAILED'").first()
    assert failed.total_eligible == first["total_eligible"] and failed.scanned is None and failed.finished_at > LATER
    # a population of nobody is a run of its own
    nobody = Inputs(inputs.summary, inputs.registration.withColumn("auth_status", inputs.registration.auth_status.substr(1, 0)),
                    inputs.dealer, inputs.juri, inputs.due)
    empty = run_defaulters(nobody, store, growth, profile, "062000", AS_OF, LATER, "run-6")
    assert (empty["status"], empty["total_eligible"], empty["scanned"], empty["skipped"]) == ("COMPLETED", 0, 0, 0)
    logged = spark.read.parquet(store.path("runs")).filter("run_id = 'run-6' and finished_at is not null").first()
    assert (logged.status, logged.scanned, logged.notice_eligible) == ("COMPLETED", 0, 0)

    months = spark.read.parquet(store.path("monthly_runs"))
    assert {(r.run_id, r.status) for r in runs.latest_runs(months, ("run_id",)).collect()} == {
        ("1", "COMPLETED"), ("2", "COMPLETED"), ("3", "COMPLETED")}
    last = months.filter("run_id = '2' and status = 'COMPLETED'").first()
    assert (last.job_name, last.growth_rows, last.scored) == ("MONTHLY_ANALYTICS", again.growth_rows, again.scored)


def test_failing_rows_stop_the_monthly_run(spark, inputs, model, tmp_path):
    broken = Inputs(
        inputs.summary.withColumn("excess_itc", F.lit(float("inf"))), inputs.registration, inputs.dealer, inputs.juri,
        inputs.due)
    with pytest.raises(GateFailed):
        run_monthly(broken, Store(str(tmp_path)), model, "062000", NOW, batch_id=1)
    log = spark.read.parquet(f"{tmp_path}/monthly_runs").filter("status = 'FAILED'").first()
    assert log.failed == log.source_rows > 0 and log.growth_rows > 0 and "percent" in log.message


def test_office_revenue(spark, inputs, tmp_path):
    store = Store(str(tmp_path))
    results = [run_office_revenue(inputs, store, p, NOW, f"run-{p}") for p in ("042000", "052000")]
    assert all(r["offices_processed"] > 0 and r["stale_deleted"] == 0 for r in results)
    rows = table(spark, store, "offices").orderBy("ret_period", "st_juri").collect()
    # run again with a dealer less: its office is removed if nobody else is there, the other month stays
    office = rows[-1].st_juri
    fewer = Inputs(inputs.summary, inputs.registration, inputs.dealer.filter(f"st_juri <> '{office}'"), inputs.juri, inputs.due)
    result = run_office_revenue(fewer, store, "052000", LATER, "run-again")
    assert result["stale_deleted"] == 1
    after = table(spark, store, "offices").orderBy("ret_period", "st_juri").collect()
    kept = [r for r in rows if (r.ret_period, r.st_juri) != (rows[-1].ret_period, office)]
    assert [(r.ret_period, r.st_juri, r.output_tax, r.created_at) for r in after] == [
        (r.ret_period, r.st_juri, r.output_tax, r.created_at) for r in kept]
    with pytest.raises(GateFailed):
        doubled = inputs.dealer.unionByName(inputs.dealer.selectExpr("gstin", "'999' st_juri"))
        run_office_revenue(
            Inputs(inputs.summary, inputs.registration, doubled, inputs.juri, inputs.due), store, "052000", NOW, "bad")
    assert table(spark, store, "offices").count() == len(after)
    log = spark.read.parquet(store.path("revenue_runs"))
    assert {(r.run_id, r.status) for r in runs.latest_runs(log, ("run_id",)).collect()} == {
        ("run-042000", "SUCCESS"), ("run-052000", "SUCCESS"), ("run-again", "SUCCESS"), ("bad", "FAILED")}


def test_counts_observed_while_writing_equal_the_counters(spark, inputs, model, tmp_path, small):
    """Run logs hold what defaulter_counters and risk_counters give."""
    from returns_analytics.operators import defaulters
    from returns_analytics.parity.fixtures import DUE

    store = Store(str(tmp_path))
    run_monthly(inputs, store, model, "062000", NOW, batch_id=1, unique_rows=True)
    log = spark.read.parquet(store.path("monthly_runs")).filter("status = 'COMPLETED'").first()
    scored = runs.risk_counters(risk.scored_returns(inputs.summary, model, ["062000"])).first()
    assert (log.source_rows, log.growth_rows, log.scored, log.failed) == (
        scored.rows_read, scored.rows_read, scored.scored, scored.failed)
    growth, profile = table(spark, store, "growth"), table(spark, store, "risk")
    got = run_defaulters(inputs, store, growth, profile, "062000", AS_OF, NOW, "run-1")
    no_history = spark.createDataFrame([], "gstin string, ret_period string, filing_status string, active_flag string")
    candidates = defaulters.defaulter_candidates(
        inputs.registration, inputs.summary, growth, profile, no_history, inputs.juri, "062000", DUE)
    counters = runs.defaulter_counters(*defaulters.evaluate_defaulters(candidates, AS_OF))
    population = defaulters.eligible_count(inputs.registration, "062000").withColumn("ret_period", F.lit("062000"))
    want = runs.run_summary(counters, population, "run-1").first().asDict()
    assert {n: got[n] for n in want} == want


def test_late_returns_renew_what_they_reach(spark, small, model, tmp_path):
    before, after = small.table("summary_before"), small.table("summary")
    source = Inputs(before, *[small.table(name) for name in ("registration", "dealer", "juri", "due")])
    store, periods = Store(str(tmp_path)), ("052000", "062000", "072000")
    for period in periods:
        run_monthly(source, store, model, period, NOW, batch_id=1)
    number = store.table(spark, "growth").state().number
    changes = late.changed_dates(before, after)
    source = Inputs(after, source.registration, source.dealer, source.juri, source.due)
    outcome = run_late_returns(source, store, changes, LATER)
    assert outcome["periods"] == 3 and outcome["rows"] > 0
    assert store.table(spark, "growth").state().number == number + 1  # all periods at once
    stored = table(spark, store, "growth")
    names = [n for n in stored.columns if n not in ("created_at", "updated_at")]
    from returns_analytics.plans import pipelines

    whole = pipelines.growth_analytics(after, periods)
    assert collect(stored, *names) == collect(whole, *names)
    reached = late.reached_rows(stored, changes)
    assert reached.filter(F.col("updated_at") != LATER).isEmpty()
    assert stored.filter(F.col("updated_at") == LATER).count() == reached.count() < stored.count()
    assert not stored.filter(F.col("created_at") == NOW).isEmpty()
    # nothing changed: nothing is written
    assert run_late_returns(source, store, changes.limit(0), LATER) == {"rows": 0, "periods": 0}
    assert store.table(spark, "growth").state().number == number + 1


def test_log_texts_stay_whole(spark):
    rejects = spark.createDataFrame([("A", "012000", "C" * 150, "m" * 1500)],
                                    "gstin string, ret_period string, error_code string, error_message string")
    got = runs.reject_log(rejects, "r", NOW).first()
    assert (len(got.error_code), len(got.error_message), got.job_name) == (150, 1500, "RETURN_DEFAULTER")
