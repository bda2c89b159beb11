"""Schemas of the input tables and the keys of the output tables."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)
#: averages of amounts keep four more digits, as Spark's own avg() does
AVERAGE = T.DecimalType(22, 6)
#: a ratio of two decimal(18,2) amounts has at most 19 integer digits, so this never overflows
RATIO = T.DecimalType(28, 6)
#: office totals are sums of amounts
TOTAL = T.DecimalType(28, 2)
#: percent growth between two office totals
PERCENT = T.DecimalType(28, 2)
SCORE = T.DecimalType(5, 2)


def _struct(spec: str) -> T.StructType:
    """Build a schema from 'name type' lines; every column is nullable."""
    names = {
        "string": T.StringType(), "date": T.DateType(), "amount": AMOUNT, "int": T.IntegerType(),
        "ratio4": T.DecimalType(9, 4),
    }
    fields = [line.split() for line in spec.strip().splitlines()]
    return T.StructType([T.StructField(name, names[kind], True) for name, kind in fields])


SUMMARY = _struct("""
    gstin string
    ret_period string
    period_date date
    filing_date date
    taxable_value amount
    total_output_tax amount
    output_igst amount
    output_cgst amount
    output_sgst amount
    output_cess amount
    eligible_itc amount
    utilized_itc amount
    reversed_itc amount
    ineligible_itc amount
    excess_itc amount
    rcm_total_tax amount
    cash_tax_paid amount
    itc_payment_total amount
    nil_supply_ratio ratio4
    filing_delay_days int
""")

REGISTRATION = _struct("""
    gstin_id string
    state_jursd_cd string
    auth_status string
    pref string
""")

#: registrations of all quarters in one dataset, partitioned by (yy, quarter)
REGISTRATION_BY_QUARTER = T.StructType(
    REGISTRATION.fields + [T.StructField("yy", T.StringType()), T.StructField("quarter", T.StringType())]
)

DEALER = _struct("""
    gstin string
    st_juri string
""")

JURISDICTION = _struct("""
    jurisdiction_code string
    jurisdiction_name string
""")

DUE_DATE = _struct("""
    return_type string
    ret_period string
    effective_due_date date
    active_flag string
""")

TAXPAYER_KEY = ("gstin", "ret_period")
OFFICE_KEY = ("ret_period", "st_juri")
