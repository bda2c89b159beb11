"""Shape of the physical plans, with broadcasts switched off so that every shuffle shows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from returns_analytics.operators import defaulters, growth, quality, risk, trees
from returns_analytics.parity import oracle
from returns_analytics.parity.fixtures import AS_OF, DUE, PERIOD
from returns_analytics.parity.queries import CATALOG
from returns_analytics.plans import pipelines
from returns_analytics.sources.sinks import staging_folder
from returns_analytics.sources.tables import read_parquet


@pytest.fixture
def plan_of(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(plan):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)\(?([^)]*)", plan)


def whole_plans(small):
    summary, stored = small.table("summary"), small.keep("growth", lambda: pipelines.growth_analytics(small.table("summary")))
    model = trees.load_model(oracle.MODEL_PATH, risk.FEATURES)
    profile = small.keep("risk", lambda: pipelines.risk_profile(summary, model)[0])
    dealer, juri = small.table("dealer"), small.table("juri")
    return {
        "growth": pipelines.growth_analytics(summary),
        "growth_unique": pipelines.growth_analytics(summary, unique_rows=True),
        "risk": pipelines.risk_profile(summary, model)[0],
        "offices": pipelines.office_revenue(summary, dealer, juri),
        "precheck": quality.office_precheck(summary, dealer, juri),
        "defaulters": pipelines.return_defaulters(
            small.table("registration"), summary, stored, profile, small.table("history"), juri, PERIOD, DUE, AS_OF)[0],
    }


def test_no_plan_has_a_product_or_a_single_task(small, plan_of):
    for name, frame in whole_plans(small).items():
        plan = plan_of(frame)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython"):
            assert word not in plan, (name, word)


def test_growth_over_unique_rows_shuffles_once(small, plan_of):
    assert [kind for kind, _ in shuffles(plan_of(whole_plans(small)["growth_unique"]))] == ["hashpartitioning"]


def test_growth_combines_rows_before_the_window(small, plan_of):
    plan = plan_of(whole_plans(small)["growth"])
    above, below = plan.split("Window [", 1)
    assert "partial_max" in below and "partial_max" not in above
    keys = [re.sub(r"#\d+", "", text) for _, text in shuffles(plan)]
    assert sorted(k.rsplit(",", 1)[0] for k in keys) == ["gstin"] + ["gstin, compare_date"] * 3


@pytest.mark.parametrize("unique", [False, True])
def test_growth_of_a_period_reads_its_reach_only(small, plan_of, unique):
    plan = plan_of(pipelines.growth_analytics(small.table("summary"), [PERIOD], unique))
    scans = re.findall(r"FileScan parquet .*", plan)
    assert all(re.search(r"PartitionFilters: \[[^\]]*ret_period", scan) for scan in scans)
    others = [s for s in (re.sub(r"#\d+", "", s) for s in scans) if "NOT (ret_period" in s]
    assert len(others) == 2
    # one fixed range, and one that is known when the scan starts
    assert sum("GreaterThanOrEqual(period_date,1999-06-01)" in s for s in others) == 1
    assert sum("Or(LessThan(period_date,1999-06-01)" in s for s in others) == 1
    assert "TakeOrderedAndProject(limit=1, orderBy=[date" in plan  # bounds of the second


def scanned_rows(frame):
    """Rows each scan of an executed plan gave out, by the text of its filters."""
    found, stack = {}, [frame._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet"):
            found[node.toString()] = node.metrics().get("numOutputRows").get().value()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            children.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            children.append(node.plan())
        stack += children
    return found


def test_dates_elsewhere_do_not_widen_the_scan(spark, small):
    """Rows dated in 1900 alone read nothing of the other partitions, rows dated within reach nothing more."""
    rows = small.table("summary")
    plain = growth.farther_rows(rows, [PERIOD])
    assert plain.count() == 0
    at_1900 = rows.withColumn("period_date", F.when(F.col("ret_period") == PERIOD, F.lit(dt.date(1900, 1, 1))).otherwise(F.col("period_date")))
    at_1900.write.partitionBy("ret_period").mode("overwrite").parquet(f"{staging_folder(spark)}/dated-1900")
    stored = read_parquet(spark, f"{staging_folder(spark)}/dated-1900", rows.schema)
    frame = growth.farther_rows(stored, [PERIOD])
    assert frame.collect() == []
    others = [n for text, n in scanned_rows(frame).items() if "NOT (ret_period" in re.sub(r"#\d+", "", text)]
    assert others == [0]
    assert rows.filter(F.col("ret_period") != PERIOD).count() > 500


def test_offices_of_a_period_share_one_exchange_per_side(small, plan_of):
    plan = plan_of(pipelines.office_revenue(small.table("summary"), small.table("dealer"), small.table("juri"), None, [PERIOD]))
    keys = [re.sub(r"#\d+", "", text).rsplit(",", 1)[0] for _, text in shuffles(plan)]
    # returns, registrations and the filers these are cut to
    assert keys.count("gstin") == 3 and "ret_period, gstin" not in keys


def ancestors(plan):
    """Each scan of a plan with the nodes above it, nearest first."""
    lines = plan.splitlines()
    indent = lambda line: len(re.match(r"[\s:+\-*()0-9]*", line).group())
    for at, line in enumerate(lines):
        if "FileScan parquet" in line:
            above, depth = [], indent(line)
            for other in reversed(lines[:at]):
                if indent(other) < depth:
                    above.append(other)
                    depth = indent(other)
            yield line, above


@pytest.mark.parametrize("what", ["offices", "precheck"])
def test_only_registrations_of_filers_are_grouped(small, plan_of, what):
    """Of a period, the dealer master meets its filers below the aggregate."""
    tables = [small.table(name) for name in ("summary", "dealer", "juri")]
    frame = pipelines.office_revenue(*tables, None, [PERIOD]) if what == "offices" else quality.office_precheck(*tables, [PERIOD])
    above = next(above for scan, above in ancestors(plan_of(frame)) if re.search(r"FileScan parquet \[gstin#\d+,st_juri", scan))
    kinds = [m.group() for line in above for m in [re.search(r"LeftSemi|HashAggregate", line)] if m]
    assert kinds.index("LeftSemi") < kinds.index("HashAggregate")


@pytest.mark.parametrize("name", ["upsert_growth_bucketed", "current_return_bucketed", "defaulter_candidates_bucketed"])
def test_stored_rows_stay_in_their_buckets(small, plan_of, name):
    """No exchange above the scan of a table bucketed by taxpayer; its slice is read by the period's partition."""
    frame = CATALOG[name].plan(small)
    scans = [(scan, above) for scan, above in ancestors(plan_of(frame)) if "Bucketed: true" in scan]
    assert scans and all("SelectedBucketsCount: 4 out of 4" in scan for scan, _ in scans)
    by_taxpayer = [(scan, above) for scan, above in scans if re.search(rf"= {PERIOD}\)", scan)]
    assert by_taxpayer
    for _, above in by_taxpayer:
        assert not [line for line in above if "Exchange" in line]


def test_registrations_of_a_quarter_read_one_partition(small, plan_of):
    plan = plan_of(defaulters.eligible(small.table("registration_by_quarter"), PERIOD))
    assert re.search(r"PartitionFilters: \[[^\]]*yy#\d+ = 00\), \(quarter#\d+ = apr_jun\)\]", plan)


def test_risk_is_narrow(small, plan_of):
    plan = plan_of(whole_plans(small)["risk"])
    assert not shuffles(plan) and "*(1)" in plan


def test_office_totals_are_evaluated_once(small, plan_of):
    plan = plan_of(whole_plans(small)["offices"])
    assert len(re.findall(r"FileScan parquet \[gstin#\d+,taxable_value", plan)) == 1
    assert plan.count("FileScan") == 3


def test_defaulters_keep_one_partitioning(small, plan_of):
    plan = plan_of(whole_plans(small)["defaulters"])
    # the pick of the current return is cut to one row per taxpayer before and after its shuffle
    assert plan.count("WindowGroupLimit") >= 2
    joins = [re.sub(r"#\d+", "", j) for j in re.findall(r"SortMergeJoin \[([^\]]*)\], \[[^\]]*\], LeftOuter", plan)]
    assert joins.count("gstin") == 5 and set(joins) == {"gstin", "st_juri"}
    assert plan.count(f"(ret_period") and re.search(rf"PartitionFilters: \[[^\]]*= {PERIOD}\)", plan)


@pytest.mark.parametrize("with_risk", [False, True])
def test_last_filed_deals_its_rows_once(small, plan_of, with_risk):
    """Growth, filings and risk of the lookback: one exchange, on gstin."""
    summary = small.table("summary")
    stored = small.keep("growth", lambda: pipelines.growth_analytics(summary))
    model = trees.load_model(oracle.MODEL_PATH, risk.FEATURES)
    profile = small.keep("risk", lambda: pipelines.risk_profile(summary, model)[0]) if with_risk else None
    plan = plan_of(defaulters.last_filed(stored, summary, PERIOD, risk=profile))
    keys = {re.sub(r"#\d+", "", text).rsplit(",", 1)[0] for _, text in shuffles(plan)}
    assert keys == {"gstin", "ret_period"}  # ret_period: the broadcast list of periods
    above = [line for _, lines in ancestors(plan) for line in lines if "Exchange hashpartitioning(gstin" in line]
    assert len(set(above)) == 1 and "Window" not in plan
    assert "SortMergeJoin" not in plan


def test_history_partitions_are_pruned_at_run_time(small, plan_of):
    stored = small.keep("growth", lambda: pipelines.growth_analytics(small.table("summary")))
    frame = defaulters.last_filed(stored, small.table("summary"), PERIOD)
    frame.collect()
    plan = plan_of(frame)
    assert "SubqueryAdaptiveBroadcast dynamicpruning#" in plan


def test_period_slice_reads_one_partition(small, plan_of):
    from returns_analytics.sources.tables import period_slice

    plan = plan_of(period_slice(small.table("summary"), PERIOD).select("gstin"))
    assert re.search(rf"PartitionFilters: \[[^\]]*= {PERIOD}\)", plan) and "ReadSchema: struct<gstin:string>" in plan
