"""Input tables derived from the generated test tables.

The derivation is one SQL text that runs in Spark and in DuckDB, so that both engines start from
the same rows. ``{idiv}`` is the only difference in dialect (integer division).
"""

from __future__ import annotations

import datetime as dt
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from returns_analytics.sources import bucketed
from returns_analytics.sources.sinks import staging_folder
from returns_analytics.sources.tables import read_parquet

# The standard case: a quarter end with filers, late filers and non-filers at the evaluation date.
PERIOD = "062000"
DUE = dt.date(2000, 7, 20)
AS_OF = dt.date(2000, 8, 15)
RUN_ID = "run-1"
RUN_AT = dt.datetime(2000, 8, 15, 2, 30)

#: buckets of the tables stored by taxpayer
BUCKETS = 4

BASE_TABLES = ("supplier", "lineitem", "nation")

#: tables stored by period or quarter, as in a deployment; the others are small or read whole
PARTITIONED = dict.fromkeys(
    ("summary", "summary_repeated", "summary_shifted", "summary_before", "history", "growth", "growth_before", "risk"),
    ("ret_period",),
) | {"registration_by_quarter": ("yy", "quarter")}

#: tables derived row by row from one stored by period: a part of it holds few periods, and so does what is made of it
BY_ROW = ("summary_repeated", "summary_shifted", "risk")

#: derived table -> SQL over base tables and earlier derived tables; IDIV(a, b) is integer division
DERIVED = {
    "sup": """
        select cast(s_suppkey as bigint) k,
          concat(lpad(cast(s_nationkey+10 as varchar(9)),2,'0'), 'ABCDE',
                 lpad(cast(s_suppkey%10000 as varchar(9)),4,'0'),
                 chr(cast(65+IDIV(s_suppkey,10000)%26 as int)),
                 case when s_suppkey%29=0 then '0' else '1' end, 'Z', cast(s_suppkey%10 as varchar(9))) gstin,
          s_nationkey n
        from supplier""",
    # every line item, grouped by supplier and ship month
    "cells": """
        select k, m, cast(sum(p) as bigint) tv, cast(sum(IDIV(p*r,100)) as bigint) ot,
          cast(sum(IDIV(p*q,100)) as bigint) ei,
          cast(sum(case when rf='R' then IDIV(p*q,100) else 0 end) as bigint) rv,
          cast(sum(case when ls='F' then IDIV(p*q,200) else 0 end) as bigint) ine,
          cast(sum(case when ln=1 then IDIV(p*r,100) else 0 end) as bigint) rcm,
          cast(sum(case when r=0 then 1 else 0 end) as bigint) nz, count(*) cnt
        from (
          select l_suppkey k, cast(year(cast(l_shipdate as date))*12+month(cast(l_shipdate as date))-1 as bigint) m,
            cast(round(l_extendedprice*100) as bigint) p, cast(round(l_tax*100) as bigint) r,
            cast(round(l_discount*100) as bigint) q, l_linenumber ln, l_returnflag rf, l_linestatus ls
          from lineitem) li
        group by k, m""",
    # one cell in eleven is a month without a return
    "summary": """
        select gstin,
          concat(lpad(cast(m%12+1 as varchar(9)),2,'0'), cast(IDIV(m,12) as varchar(9))) ret_period,
          case when (k*3+m)%41=0 then null else d0 end period_date,
          case when (k+m)%53=0 then null else due_day + cast((k*13+m*7)%120-25 as int) end filing_date,
          cast(tv/100 as decimal(18,2)) taxable_value,
          case when (k+m)%37=0 then null else cast(ot/100 as decimal(18,2)) end total_output_tax,
          cast(IDIV(ot,2)/100 as decimal(18,2)) output_igst, cast(IDIV(ot,4)/100 as decimal(18,2)) output_cgst,
          cast(IDIV(ot,4)/100 as decimal(18,2)) output_sgst,
          cast((ot-IDIV(ot,2)-2*IDIV(ot,4))/100 as decimal(18,2)) output_cess,
          cast(ei/100 as decimal(18,2)) eligible_itc, cast(least(ot,ei)/100 as decimal(18,2)) utilized_itc,
          cast(rv/100 as decimal(18,2)) reversed_itc, cast(ine/100 as decimal(18,2)) ineligible_itc,
          cast(greatest(ei-ot,0)/100 as decimal(18,2)) excess_itc, cast(rcm/100 as decimal(18,2)) rcm_total_tax,
          cast((ot-least(ot,ei))/100 as decimal(18,2)) cash_tax_paid,
          cast(least(ot,ei)/100 as decimal(18,2)) itc_payment_total,
          cast(IDIV(nz*10000,cnt)/10000 as decimal(9,4)) nil_supply_ratio,
          cast(greatest((k*13+m*7)%120-25,0) as int) filing_delay_days
        from (
          select c.*, s.gstin, make_date(cast(IDIV(m,12) as int), cast(m%12+1 as int), 1) d0,
            make_date(cast(IDIV((m+1),12) as int), cast((m+1)%12+1 as int), 20) due_day
          from cells c join sup s on s.k=c.k where (c.k*7+m)%11<>0) b""",
    "registration": """
        select case when k%7=0 then lower(gstin) else gstin end gstin_id,
          lpad(cast(n as varchar(9)),3,'0') state_jursd_cd,
          case when k%17=0 then 'C' else 'A' end auth_status,
          case when k%3=0 then 'Q' when k%3=1 then 'M' else 'm' end pref
        from sup""",
    # one row per taxpayer and quarter with a return; late changes of preference happen
    "registration_by_quarter": """
        select distinct r.gstin_id, r.state_jursd_cd, r.auth_status,
          case when IDIV(x.m,3)%5=0 then 'M' else r.pref end pref, x.yy, x.quarter
        from registration r join (
          select gstin, substr(ret_period,5,2) yy, cast(substr(ret_period,1,2) as bigint) m,
            case when substr(ret_period,1,2) in ('01','02','03') then 'jan_mar'
                 when substr(ret_period,1,2) in ('04','05','06') then 'apr_jun'
                 when substr(ret_period,1,2) in ('07','08','09') then 'jul_sep' else 'oct_dec' end as quarter
          from summary) x on x.gstin = upper(r.gstin_id)""",
    "dealer": """
        select gstin, case when k%23=0 then null else lpad(cast(n as varchar(9)),3,'0') end st_juri
        from sup where k%19<>0""",
    "juri": """
        select lpad(cast(n_nationkey as varchar(9)),3,'0') jurisdiction_code, n_name jurisdiction_name
        from nation where n_nationkey<>24""",
    "due": """
        select distinct 'GSTR3B' return_type, ret_period,
          make_date(cast(substr(ret_period,3,4) as int)+case when substr(ret_period,1,2)='12' then 1 else 0 end,
                    cast(substr(ret_period,1,2) as int)%12+1, 20) effective_due_date, 'Y' active_flag
        from summary""",
    # due dates with inactive rows, a second active date and rows of another return type
    "due_mixed": """
        select return_type, ret_period, effective_due_date, active_flag from due
        union all select 'GSTR1', ret_period, effective_due_date, 'Y' from due
        union all select return_type, ret_period, effective_due_date + 5, 'N' from due
        union all select return_type, ret_period, effective_due_date + 9, 'Y' from due
          where substr(ret_period,1,2)='02'
        union all select return_type, ret_period, cast(null as date), 'Y' from due
          where substr(ret_period,1,2)='03'""",
    # repeated returns and repeated or conflicting registrations
    "summary_repeated": """
        select * from summary
        union all select s.* from summary s join sup u on u.gstin=s.gstin where u.k%31=0""",
    # returns dated months before or behind their period, and a few dated in 1900
    "summary_shifted": """
        select gstin, ret_period,
          case when n%13=0 then cast(d - interval '40' month as date) when n%13=1 then cast(d + interval '5' month as date)
            when n%211=7 then make_date(1900,1,1) else period_date end period_date,
          filing_date, taxable_value, total_output_tax, output_igst, output_cgst, output_sgst, output_cess, eligible_itc,
          utilized_itc, reversed_itc, ineligible_itc, excess_itc, rcm_total_tax, cash_tax_paid, itc_payment_total,
          nil_supply_ratio, filing_delay_days
        from (select s.*, cast(s.taxable_value*100 as bigint) n,
                make_date(cast(substr(s.ret_period,3,4) as int), cast(substr(s.ret_period,1,2) as int), 1) d
              from summary s) t""",
    # the summary as it was before late, corrected and moved returns came in and some were withdrawn
    "summary_before": """
        select gstin, ret_period, case when n%29=3 then cast(d - interval '2' month as date) else period_date end period_date,
          filing_date, case when n%23=5 then cast(taxable_value + 100 as decimal(18,2)) else taxable_value end taxable_value,
          total_output_tax, output_igst, output_cgst, output_sgst, output_cess, eligible_itc, utilized_itc, reversed_itc,
          ineligible_itc, excess_itc, rcm_total_tax, cash_tax_paid, itc_payment_total, nil_supply_ratio, filing_delay_days
        from (select s.*, case when substr(s.gstin,11,1)='3' then cast(0 as bigint) else cast(s.taxable_value*100 as bigint) end n,
                make_date(cast(substr(s.ret_period,3,4) as int), cast(substr(s.ret_period,1,2) as int), 1) d
              from summary s) t
        where n%17<>2
        union all
        select gstin, '012010', make_date(2010,1,1), cast(null as date), max(taxable_value), max(total_output_tax),
          max(output_igst), max(output_cgst), max(output_sgst), max(output_cess), max(eligible_itc), max(utilized_itc),
          max(reversed_itc), max(ineligible_itc), max(excess_itc), max(rcm_total_tax), max(cash_tax_paid),
          max(itc_payment_total), cast(null as decimal(9,4)), cast(0 as int)
        from summary where substr(gstin,11,1) in ('4','5') group by gstin""",
    "dealer_repeated": """
        select gstin, st_juri from dealer
        union all select d.gstin, lpad(cast((u.n+1)%25 as varchar(9)),3,'0')
          from dealer d join sup u on u.gstin=d.gstin where u.k%31=0
        union all select d.gstin, d.st_juri from dealer d join sup u on u.gstin=d.gstin where u.k%13=0
        union all select d.gstin, cast(null as varchar(9)) from dealer d join sup u on u.gstin=d.gstin where u.k%37=0""",
    "juri_repeated": """
        select jurisdiction_code, jurisdiction_name from juri
        union all select jurisdiction_code, concat(jurisdiction_name, ' EAST') from juri
          where jurisdiction_code < '005'
        union all select cast(null as varchar(9)), 'NOWHERE' from juri where jurisdiction_code='000'""",
    # results of earlier runs: the months without a return, some of them closed or filed since
    "history": """
        select s.gstin,
          concat(lpad(cast(c.m%12+1 as varchar(9)),2,'0'), cast(IDIV(c.m,12) as varchar(9))) ret_period,
          case when (c.k+c.m)%6=0 then 'FILED_LATE' else 'NOT_FILED' end filing_status,
          case when (c.k+c.m)%5=0 then 'N' else 'Y' end active_flag
        from cells c join sup s on s.k=c.k where (c.k*7+c.m)%11=0
        union all select gstin, '13' || '2000', 'NOT_FILED', 'Y' from sup
        union all select gstin, '061800', 'NOT_FILED', 'Y' from sup""",
    # key texts as they arrive: padded, lower case, cut, blank, and without the fixed letter
    "key_texts": """
        select k, case when k%7=0 then null when k%7=1 then '   ' when k%7=2 then concat('  ', lower(gstin), ' ')
          when k%7=3 then substr(gstin,1,cast(k%10 as int)) when k%7=4 then concat(substr(gstin,1,13),'A',substr(gstin,15,1))
          when k%7=5 then concat(gstin, chr(9)) else gstin end txt
        from sup""",
    # free labels of earlier systems, one per return
    "labels_in": """
        select gstin, ret_period, taxable_value,
          case when n%9=0 then null when n%9=1 then ' sharp-decline ' when n%9=2 then 'Strong Decline'
            when n%9=3 then 'declining' when n%9=4 then 'DECLINE' when n%9=5 then 'high' when n%9=6 then 'Warning '
            when n%9=7 then 'critical' else 'LOW' end label
        from (select gstin, ret_period, taxable_value, cast(taxable_value*100 as bigint) n from summary) t""",
    # every taxpayer and month that had to be filed, with or without a return
    "obligations": """
        select s.gstin, s.ret_period, d.effective_due_date due_date, true filed, s.filing_date,
          cast(s.filing_delay_days%7-1 as bigint) past, cast(s.nil_supply_ratio*400-20 as double) risk_in, l.label
        from summary s join due d on d.ret_period=s.ret_period
          join labels_in l on l.gstin=s.gstin and l.ret_period=s.ret_period
        union all
        select h.gstin, h.ret_period, d.effective_due_date, false, cast(null as date), cast(3 as bigint),
          cast(55.5 as double), cast(null as varchar(9))
        from history h join due d on d.ret_period=h.ret_period""",
}


def _calls(text: str, divide: str) -> str:
    """Replace IDIV(a, b) by the engine's integer division, innermost call first."""
    pattern = re.compile(r"IDIV\(((?:[^()]|\([^()]*\))*?),([^(),]+)\)")
    while "IDIV(" in text:
        text = pattern.sub(lambda call: f"(({call[1]}) {divide} ({call[2]}))", text)
    return text


def table_sql(name: str, engine: str) -> str:
    return _calls(DERIVED[name], "div" if engine == "spark" else "//")


def needed(text: str) -> list[str]:
    """Derived tables a text uses, directly or not, in the order they must be defined."""
    names: set[str] = set()
    open_texts = [text]
    while open_texts:
        words = set(re.findall(r"[a-z_]+", open_texts.pop()))
        for name in words & set(DERIVED) - names:
            names.add(name)
            open_texts.append(DERIVED[name])
    return [name for name in DERIVED if name in names]


def direct(name: str) -> list[str]:
    """Derived and base tables a derivation reads itself."""
    words = set(re.findall(r"[a-z_]+", DERIVED[name]))
    return [other for other in (*BASE_TABLES, *DERIVED) if other != name and other in words]


#: paths written and tables opened, per application and session
_WRITTEN: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}
_OPENED: dict[tuple[SparkSession, str], DataFrame] = {}


@dataclass(frozen=True)
class Fixtures:
    """Derived tables of one data folder, as stored tables.

    A table is derived and written the first time it is asked for, in the shared checkpoint folder
    (see sources.sinks). Queries then read it as they would read the tables of a deployment.
    """

    spark: SparkSession
    folder: str

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return self.keep(name, lambda: self._derive(name))

    def _derive(self, name: str) -> DataFrame:
        sql, sources = table_sql(name, "spark"), {}
        for other in direct(name):
            sources[other] = self.base(other) if other in BASE_TABLES else self.table(other)
            sql = re.sub(rf"\b(from|join) {other}\b", rf"\1 {{{other}}}", sql)
        return self.spark.sql(sql, **sources)

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that is built and written once, and read from then on.

        Rows are dealt by period before they are written, so that a period is not one small file per task; those
        that lie by period already (BY_ROW) stay where they are.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _WRITTEN:
            rows = build()
            path = f"{staging_folder(self.spark)}/{zlib.crc32(self.folder.encode()):08x}/{name}"
            writer = rows.write
            if name in PARTITIONED:
                dealt = rows if name in BY_ROW else rows.hint("rebalance", *PARTITIONED[name])
                writer = dealt.write.partitionBy(*PARTITIONED[name])
            writer.mode("overwrite").parquet(path)
            _WRITTEN[key] = (path, rows.schema)
        path, schema = _WRITTEN[key]
        if (self.spark, path) not in _OPENED:
            _OPENED[(self.spark, path)] = read_parquet(self.spark, path, schema)
        return _OPENED[(self.spark, path)]

    def bucketed(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table bucketed by gstin and stored by period, built and written once."""
        table = f"bucketed_{zlib.crc32(self.folder.encode()):08x}_{name}"
        if not self.spark.catalog.tableExists(table):
            bucketed.save(build(), table, f"{staging_folder(self.spark)}/{table}", BUCKETS, ["ret_period"])
        return bucketed.read(self.spark, table)
