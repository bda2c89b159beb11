"""Counts and gates."""

import pytest
from helpers import collect, row, summary

from returns_analytics.errors import GateFailed, MissingTable
from returns_analytics.operators import quality
from returns_analytics.sources import tables


def inputs(spark):
    table = summary(spark, [row(g, "012000") for g in ("A", "A", "B", "C", "D", "E", None)] + [row("A", "022000")])
    dealer = spark.createDataFrame(
        [("A", "001"), ("A", "001"), ("B", "001"), ("B", None), ("C", "009"), ("C", "001"), ("D", "009"), ("Z", "001")],
        "gstin string, st_juri string")
    juri = spark.createDataFrame([("001", "WEST"), ("001", "EAST")], "jurisdiction_code string, jurisdiction_name string")
    return table, dealer, juri


NAMES = ("ret_period", "source_rows", "source_gstins", "unmapped_registrations", "unmapped_jurisdictions",
         "duplicate_mappings", "duplicate_source_gstins")


def test_precheck(spark):
    counts = quality.office_precheck(*inputs(spark))
    assert collect(counts, *NAMES) == [("012000", 7, 5, 2, 2, 1, 1), ("022000", 1, 1, 0, 0, 0, 0)]
    assert collect(quality.office_precheck(*inputs(spark), ["022000"]), "ret_period") == [("022000",)]


def test_single_counts_agree(spark):
    table, dealer, juri = inputs(spark)
    assert collect(quality.unmapped_registrations(table, dealer), "ret_period", "unmapped_registrations") == [
        ("012000", 2), ("022000", 0)]
    assert collect(quality.unmapped_jurisdictions(table, dealer, juri), "unmapped_jurisdictions") == [(2,)]
    assert collect(quality.duplicate_mappings(table, dealer), "duplicate_mappings") == [(1,)]
    assert collect(quality.duplicate_source(table), "duplicate_gstins") == [(0,), (1,)]


def test_precheck_gate(spark):
    table, dealer, juri = inputs(spark)
    with pytest.raises(GateFailed, match="several offices"):
        quality.enforce_precheck(quality.office_precheck(table, dealer, juri))
    assert quality.enforce_precheck(quality.office_precheck(table, dealer, juri, ["022000"])) == []
    warnings = quality.enforce_precheck(quality.office_precheck(table.filter("gstin <> 'C'"), dealer, juri))
    assert len(warnings) == 2
    with pytest.raises(GateFailed, match="no valid source data"):
        quality.enforce_precheck(quality.office_precheck(table.filter("gstin is null"), dealer, juri))


def test_coverage(spark):
    table, _, _ = inputs(spark)
    growth = spark.createDataFrame([("A", "012000"), ("A", "032000")], "gstin string, ret_period string")
    assert collect(quality.growth_coverage(growth, table), "ret_period", "growth_rows", "summary_rows", "incomplete") == [
        ("012000", 1, 7, True), ("022000", 0, 1, True), ("032000", 1, 0, False)]
    assert "1 of 7" in quality.coverage_warning(growth, table, "022000")
    assert quality.coverage_warning(growth, table, "042000") is None
    assert quality.coverage_warning(growth, table, "092000") is None


def test_keys(spark):
    frame = spark.createDataFrame([("A",), (" a",), ("B",), ("  ",)], "gstin string")
    assert collect(quality.bad_taxpayer_keys(frame), "gstin", "n") == sorted([("A", 2), (None, 1)], key=str)
    table, _, _ = inputs(spark)
    assert not quality.has_unique_dates(table)
    assert quality.has_unique_dates(table.dropDuplicates(["gstin", "ret_period"]))


def test_required_inputs(spark):
    registration = spark.createDataFrame(
        [("A", "001", "A", "M", "00", "apr_jun")],
        "gstin_id string, state_jursd_cd string, auth_status string, pref string, yy string, quarter string")
    tables.require_registration(registration, "062000")
    with pytest.raises(MissingTable, match="jul_sep"):
        tables.require_registration(registration, "072000")
    with pytest.raises(MissingTable):
        tables.require_table(spark, "no_such_table")
    registration.createOrReplaceTempView("registration_for_test")
    assert tables.require_table(spark, "registration_for_test").count() == 1
