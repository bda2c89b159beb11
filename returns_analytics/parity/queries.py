"""The query catalogue: name -> Spark plan, compared columns, and SQL of the same rows.

Compared columns are cast to four plain types on both sides (text, double, bigint, boolean), with
dates as ISO text, so that the two engines' own types do not matter.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.functions import amounts, bands, filing, keys, periods
from returns_analytics.operators import bitmaps, defaulters, growth, late, office, quality, ranges, risk, runs, trees
from returns_analytics.operators.upsert import rows_without_target, stale_keys
from returns_analytics.parity import oracle
from returns_analytics.parity.fixtures import AS_OF, DUE, PERIOD, RUN_AT, RUN_ID, Fixtures
from returns_analytics.parity.oracle import cents, half_up
from returns_analytics.plans import pipelines
from returns_analytics.sources import tables
from returns_analytics.sources.published import Published
from returns_analytics.sources.sinks import staging_folder

_SPARK_KINDS = {"s": "string", "n": "double", "i": "bigint", "b": "boolean"}
_SQL_KINDS = {"s": "varchar", "n": "double", "i": "bigint", "b": "boolean"}


@dataclass(frozen=True)
class Query:
    plan: Callable[[Fixtures], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def frame(self, fixtures: Fixtures) -> DataFrame:
        rows = self.plan(fixtures)
        return rows.select(*[F.col(name).cast(_SPARK_KINDS[kind]).alias(name) for name, kind in self.columns.items()])

    def statement(self) -> str | None:
        if self.sql is None:
            return None
        return oracle.assemble(self.sql, {name: _SQL_KINDS[kind] for name, kind in self.columns.items()})


CATALOG: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None) -> Callable:
    """Register a plan. ``columns`` is 'kind: name name; kind: name' with the kinds s, n, i, b."""
    kinds = {}
    for part in columns.split(";"):
        kind, names = part.split(":")
        kinds.update({column: kind.strip() for column in names.split()})

    def register(plan: Callable[[Fixtures], DataFrame]) -> Callable:
        CATALOG[name] = Query(plan, kinds, sql)
        return plan

    return register


def _model() -> trees.TreeModel:
    return trees.load_model(oracle.MODEL_PATH, risk.FEATURES)


# Column lists used more than once.
_SUMMARY = (
    "s: gstin ret_period period_date filing_date; n: taxable_value total_output_tax output_igst output_cgst "
    "output_sgst output_cess eligible_itc utilized_itc reversed_itc ineligible_itc excess_itc rcm_total_tax "
    "cash_tax_paid itc_payment_total nil_supply_ratio; i: filing_delay_days")
_KEY = "s: gstin ret_period"
_MOM = "n: mom_taxable_growth mom_output_tax_growth mom_itc_growth mom_cash_growth"
_YOY = "n: yoy_taxable_growth yoy_output_tax_growth yoy_itc_growth yoy_cash_growth"
_AVG = "n: " + " ".join(growth.average_columns())
_GROWTH = (
    f"{_KEY} period_date growth_trend; n: taxable_value output_tax eligible_itc utilized_itc cash_tax_paid "
    f"rcm_total_tax; {_MOM}; {_YOY}; {_AVG}; i: filing_delay_days")
_OFFICE_TOTALS = (
    "s: ret_period st_juri period_date office_name; i: filed_gstins; n: taxable_value output_tax igst cgst sgst cess "
    "eligible_itc utilized_itc cash_tax_paid")
_OFFICE_GROWTH = (
    "s: ret_period st_juri growth_trend growth_status; n: mom_output_growth yoy_output_growth mom_cash_growth "
    "yoy_cash_growth avg_output_tax_3m avg_output_tax_6m avg_output_tax_12m avg_cash_tax_3m avg_cash_tax_6m "
    "avg_cash_tax_12m")
_RESULT = (
    "s: gstin ret_period due_date filing_status filing_date last_filed_period last_filing_date growth_status "
    "risk_level default_level notice_eligible st_juri office_name; i: delay_days historical_default_count; "
    "n: taxable_value output_tax avg_output_tax_3m avg_output_tax_6m avg_output_tax_12m risk_score default_score")
_FEATURES = f"{_KEY}; n: " + " ".join(risk.FEATURES)


# --- scans ---------------------------------------------------------------------------------

@query("scan_summary", _SUMMARY, "select * from summary")
def _(fx):
    return fx.table("summary")


@query("period_slice", _SUMMARY, f"select * from summary where ret_period = '{PERIOD}'")
def _(fx):
    return tables.period_slice(fx.table("summary"), PERIOD)


@query(
    "registration_quarter", "s: ret_period quarter yy; i: registrations",
    """select d.ret_period, case (cast(substr(d.ret_period,1,2) as int)+2)//3 when 1 then 'jan_mar' when 2 then 'apr_jun'
         when 3 then 'jul_sep' else 'oct_dec' end as quarter, substr(d.ret_period,5,2) yy, count(*) registrations
       from due d join registration_by_quarter r on r.yy = substr(d.ret_period,5,2) and r.quarter =
         case (cast(substr(d.ret_period,1,2) as int)+2)//3 when 1 then 'jan_mar' when 2 then 'apr_jun'
         when 3 then 'jul_sep' else 'oct_dec' end group by all""")
def _(fx):
    period = F.col("ret_period")
    named = fx.table("due").select(
        "ret_period", periods.quarter_name(period).alias("quarter"), periods.short_year(period).alias("yy"))
    counts = fx.table("registration_by_quarter").groupBy("yy", "quarter").agg(
        F.count(F.lit(1)).alias("registrations"))
    return named.join(counts, ["yy", "quarter"])


@query(
    "registration_slice", "s: gstin_id state_jursd_cd auth_status pref",
    "select gstin_id, state_jursd_cd, auth_status, pref from registration_by_quarter "
    "where yy = '00' and quarter = 'apr_jun'")
def _(fx):
    return tables.registration_slice(fx.table("registration_by_quarter"), PERIOD)


def _offices(fx: Fixtures) -> DataFrame:
    """The stored totals of all offices and periods."""
    return fx.keep("offices", lambda: office.office_totals(
        fx.table("summary"), fx.table("dealer"), fx.table("juri")))


def _repeated_offices(fx: Fixtures) -> DataFrame:
    """The same from the inputs with repeated rows."""
    return fx.keep("offices_repeated", lambda: office.office_totals(
        fx.table("summary_repeated"), fx.table("dealer_repeated"), fx.table("juri_repeated")))


@query("office_exact", _OFFICE_TOTALS,
       f"select {oracle.OFFICE_TOTAL_COLUMNS} from o_offices o where ret_period = '{PERIOD}' and st_juri = '003'")
def _(fx):
    return tables.office_exact(_offices(fx), "003", PERIOD)


@query("office_history", _OFFICE_TOTALS,
       f"select {oracle.OFFICE_TOTAL_COLUMNS} from o_offices o "
       "where period_date between date '1999-06-01' and date '2000-06-01'")
def _(fx):
    return tables.office_history(_offices(fx), PERIOD)


@query("office_list", "s: st_juri", f"select st_juri from o_offices where ret_period = '{PERIOD}'")
def _(fx):
    return tables.office_list(_offices(fx), PERIOD)


# --- periods and keys ----------------------------------------------------------------------

@query("period_parse", "s: ret_period first_day; b: valid",
       f"""select ret_period, regexp_full_match(ret_period,'(0[1-9]|1[0-2])[0-9]{{4}}') "valid",
         case when regexp_full_match(ret_period,'(0[1-9]|1[0-2])[0-9]{{4}}') then {oracle.day_of('ret_period')} end first_day
       from history""")
def _(fx):
    period = F.col("ret_period")
    return fx.table("history").select(
        "ret_period", periods.is_valid_period(period).alias("valid"), periods.first_day(period).alias("first_day"))


@query("period_format", "s: filing_date filed_in", "select filing_date, strftime(filing_date,'%m%Y') filed_in from summary")
def _(fx):
    return fx.table("summary").select("filing_date", periods.format_period(F.col("filing_date")).alias("filed_in"))


@query("period_prev", "s: ret_period previous",
       f"select ret_period, strftime({oracle.day_of('ret_period')} - interval 1 month,'%m%Y') previous from summary")
def _(fx):
    return fx.table("summary").select("ret_period", periods.previous_period(F.col("ret_period")).alias("previous"))


@query("period_date", f"{_KEY} period_date",
       f"select gstin, ret_period, coalesce(period_date, {oracle.day_of('ret_period')}) period_date from summary")
def _(fx):
    return fx.table("summary").select(
        "gstin", "ret_period", periods.effective_date(F.col("period_date"), F.col("ret_period")).alias("period_date"))


@query("quarter_end", "s: ret_period; b: quarter_end",
       "select ret_period, substr(ret_period,1,2) in ('03','06','09','12') quarter_end from summary")
def _(fx):
    return fx.table("summary").select("ret_period", periods.is_quarter_end(F.col("ret_period")).alias("quarter_end"))


@query("gstin_norm", "s: txt normalised", f"select txt, upper({oracle.trimmed('txt')}) normalised from key_texts")
def _(fx):
    return fx.table("key_texts").select("txt", keys.normalise(F.col("txt")).alias("normalised"))


@query("gstin_valid", "s: txt; b: strict relaxed",
       """select txt, coalesce(regexp_full_match(txt,'[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]'),false) "strict",
         coalesce(regexp_full_match(txt,'[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z][0-9A-Z]{2}'),false) relaxed
       from key_texts""")
def _(fx):
    text = F.col("txt")
    return fx.table("key_texts").select(
        "txt", keys.is_valid_gstin(text, strict=True).alias("strict"), keys.is_valid_gstin(text).alias("relaxed"))


@query("gstin_mask", "s: txt masked",
       "select txt, case when txt is null or length(txt) < 7 then '***' "
       "else substr(txt,1,2) || '*****' || substr(txt,length(txt)-3) end masked from key_texts")
def _(fx):
    return fx.table("key_texts").select("txt", keys.mask(F.col("txt")).alias("masked"))


# --- amounts -------------------------------------------------------------------------------

@query("nz_amounts", f"{_KEY}; n: total_output_tax eligible_itc",
       "select gstin, ret_period, coalesce(total_output_tax,0) total_output_tax, coalesce(eligible_itc,0) eligible_itc "
       "from summary")
def _(fx):
    return fx.table("summary").select(
        "gstin", "ret_period",
        *[amounts.zero_if_null(F.col(c)).alias(c) for c in ("total_output_tax", "eligible_itc")])


@query("output_tax", f"{_KEY}; n: output_tax",
       "select gstin, ret_period, coalesce(total_output_tax, output_igst+output_cgst+output_sgst+output_cess) output_tax "
       "from summary")
def _(fx):
    return fx.table("summary").select(
        "gstin", "ret_period",
        amounts.output_tax(*[F.col(c) for c in defaulters.OUTPUT_TAX_COLUMNS]).alias("output_tax"))


@query("money", f"{_KEY}; n: third",
       f"select gstin, ret_period, {half_up('coalesce(' + cents('total_output_tax') + ',0)', '3')}/100 third from summary")
def _(fx):
    return fx.table("summary").select(
        "gstin", "ret_period", amounts.money(F.col("total_output_tax") / 3).alias("third"))


@query("score_clamp", f"{_KEY}; n: score",
       f"select gstin, ret_period, {oracle.score_cents('risk_in')}/100 score from obligations")
def _(fx):
    return fx.table("obligations").select("gstin", "ret_period", amounts.clamp_score(F.col("risk_in")).alias("score"))


@query("growth_ratio", f"{_KEY}; n: ratio",
       f"""select gstin, ret_period, case when reversed_itc <> 0 then {half_up(
           f"cast({cents('coalesce(total_output_tax,0)')} - {cents('reversed_itc')} as hugeint)*1000000",
           f"abs({cents('reversed_itc')})")}/1e6 end ratio from summary""")
def _(fx):
    ratio = amounts.growth_ratio(F.col("total_output_tax"), F.col("reversed_itc"))
    return fx.table("summary").select("gstin", "ret_period", F.round(ratio, 6).alias("ratio"))


@query("growth_percent", f"{_KEY}; n: percent",
       f"""select gstin, ret_period, {oracle._percent(cents('total_output_tax'), cents('reversed_itc'))}/100 as "percent"
       from summary""")
def _(fx):
    percent = amounts.growth_percent(F.col("total_output_tax"), F.col("reversed_itc"))
    return fx.table("summary").select("gstin", "ret_period", percent.alias("percent"))


@query("clipped_ratio", f"{_KEY}; n: ratio",
       """select gstin, ret_period, case when reversed_itc <= 0 then 0::double else least(greatest(
         cast(total_output_tax as double)/cast(reversed_itc as double), -9.9999::double), 9.9999::double)
         + 0 * cast(total_output_tax as double) end ratio
       from summary""")
def _(fx):
    ratio = amounts.clipped_ratio(F.col("total_output_tax").cast("double"), F.col("reversed_itc").cast("double"))
    return fx.table("summary").select("gstin", "ret_period", ratio.alias("ratio"))


# --- labels and bands ----------------------------------------------------------------------

@query("growth_label", f"{_KEY} label trend",
       f"select gstin, ret_period, label, {oracle.growth_label('label')} trend from labels_in")
def _(fx):
    return fx.table("labels_in").select(
        "gstin", "ret_period", "label", bands.growth_label(F.col("label")).alias("trend"))


@query("risk_level_final", f"{_KEY} level",
       f"""select gstin, ret_period, case when {oracle.label_of('label')} in ('NORMAL','WARNING','HIGH','CRITICAL')
         then {oracle.label_of('label')} else {oracle.level_of(oracle.score_cents('risk_in'))} end as "level"
       from obligations""")
def _(fx):
    level = bands.existing_level_or_derived(F.col("label"), amounts.clamp_score(F.col("risk_in")))
    return fx.table("obligations").select("gstin", "ret_period", level.alias("level"))


@query("growth_trend", f"{_KEY} growth_trend", "select gstin, ret_period, trend growth_trend from o_growth")
def _(fx):
    return pipelines.growth_analytics(fx.table("summary"), unique_rows=True).select(
        "gstin", "ret_period", "growth_trend")


@query("office_trend", "s: ret_period st_juri growth_trend", "select ret_period, st_juri, growth_trend from o_office_growth")
def _(fx):
    return office.office_growth(_offices(fx)).select("ret_period", "st_juri", "growth_trend")


@query("office_status", "s: ret_period st_juri growth_status",
       "select ret_period, st_juri, growth_status from o_office_growth")
def _(fx):
    return office.office_growth(_offices(fx)).select("ret_period", "st_juri", "growth_status")


# --- filing --------------------------------------------------------------------------------

_OB_STATUS = oracle.status_of("filed", "filing_date", "due_date", oracle.AS_OF)
_OB_DELAY = oracle.delay_of("filed", "filing_date", "due_date", oracle.AS_OF)
_OB_SCORE = oracle.default_cents("filing_status", "delay_days", "past", "risk_in", "label")
_OB_SOUND = f"select *, {_OB_STATUS} filing_status, {_OB_DELAY} delay_days from obligations"


def _obligations(fx: Fixtures) -> DataFrame:
    today = F.lit(AS_OF)
    rows = fx.table("obligations")
    case = (F.col("filed"), F.col("filing_date"), F.col("due_date"), today)
    rows = rows.withColumns({
        "filing_status": filing.filing_status(*case), "delay_days": filing.delay_days(*case)})
    return rows.withColumn("default_score", filing.default_score(
        *[F.col(c) for c in ("filing_status", "delay_days", "past", "risk_in", "label")]))


@query("filing_status", f"{_KEY} filing_status; i: delay_days",
       f"select gstin, ret_period, filing_status, delay_days from ({_OB_SOUND}) x")
def _(fx):
    return _obligations(fx).select("gstin", "ret_period", "filing_status", "delay_days")


@query("default_score", f"{_KEY}; n: default_score",
       f"select gstin, ret_period, {_OB_SCORE}/100 default_score from ({_OB_SOUND}) x")
def _(fx):
    return _obligations(fx).select("gstin", "ret_period", "default_score")


@query("default_level", f"{_KEY} default_level",
       f"select gstin, ret_period, {oracle.level_of('points')} default_level from "
       f"(select *, {_OB_SCORE} points from ({_OB_SOUND}) x) y")
def _(fx):
    return _obligations(fx).select("gstin", "ret_period", bands.default_level(F.col("default_score")).alias("default_level"))


@query("notice_eligible", f"{_KEY}; b: eligible",
       f"select gstin, ret_period, filing_status = 'NOT_FILED' and {oracle.AS_OF} > due_date eligible from ({_OB_SOUND}) x")
def _(fx):
    flag = filing.notice_eligible(F.col("filing_status"), F.col("due_date"), F.lit(AS_OF))
    return _obligations(fx).select("gstin", "ret_period", flag.alias("eligible"))


# --- taxpayer growth -----------------------------------------------------------------------

def _repeated_growth(fx: Fixtures) -> DataFrame:
    """Growth over a table with repeated returns."""
    return pipelines.growth_analytics(fx.table("summary_repeated"))


@query("growth_history", f"{_KEY} compare_date; n: mom_taxable_value yoy_taxable_value mom_total_output_tax "
       f"yoy_total_output_tax; {_AVG}",
       "select gstin, ret_period, cur compare_date, p_mom_taxable/100 mom_taxable_value, "
       "p_yoy_taxable/100 yoy_taxable_value, p_mom_output_tax/100 mom_total_output_tax, "
       f"p_yoy_output_tax/100 yoy_total_output_tax, {oracle.growth_select(('avg',))} from o_repeated")
def _(fx):
    return growth.growth_history(fx.table("summary_repeated"))


@query("growth_mom", f"{_KEY}; {_MOM}", f"select gstin, ret_period, {oracle.growth_select(('mom',))} from o_repeated")
def _(fx):
    return _repeated_growth(fx)


@query("growth_yoy", f"{_KEY}; {_YOY}", f"select gstin, ret_period, {oracle.growth_select(('yoy',))} from o_repeated")
def _(fx):
    return _repeated_growth(fx)


@query("growth_avg", f"{_KEY}; {_AVG}", f"select gstin, ret_period, {oracle.growth_select(('avg',))} from o_repeated")
def _(fx):
    return _repeated_growth(fx)


@query("growth_analytics", _GROWTH, oracle.GROWTH_TABLE)
def _(fx):
    return pipelines.growth_analytics(fx.table("summary"))


_SHIFTED = oracle.growth_rows("o_shifted")


@query("growth_period", _GROWTH, f"{_SHIFTED} where ret_period = '{PERIOD}'")
def _(fx):
    return pipelines.growth_analytics(fx.table("summary_shifted"), [PERIOD])


@query("growth_periods", _GROWTH, f"{_SHIFTED} where ret_period in ('{PERIOD}', '051997', '011999')")
def _(fx):
    return pipelines.growth_analytics(fx.table("summary_shifted"), [PERIOD, "051997", "011999"])


@query("growth_analytics_unique", _GROWTH, oracle.GROWTH_TABLE)
def _(fx):
    return pipelines.growth_analytics(fx.table("summary"), unique_rows=True)


# --- late returns --------------------------------------------------------------------------

def _growth_before(fx: Fixtures) -> DataFrame:
    """The growth table as it was stored before the summary changed."""
    return fx.keep("growth_before", lambda: pipelines.growth_analytics(fx.table("summary_before")))


def _changes(fx: Fixtures) -> DataFrame:
    return fx.keep("changed_dates", lambda: late.changed_dates(fx.table("summary_before"), fx.table("summary")))


@query("changed_dates", "s: gstin changed_date", "select gstin, cur changed_date from o_changed")
def _(fx):
    return late.changed_dates(fx.table("summary_before"), fx.table("summary"))


@query("growth_late_rows", _GROWTH,
       f"""{oracle.GROWTH_TABLE} where exists (select 1 from o_changed c where c.gstin = o_growth.gstin
         and c.cur between cast(o_growth.cur - interval 12 month as date) and o_growth.cur)""")
def _(fx):
    return late.late_growth(fx.table("summary"), _changes(fx))


@query("growth_late_returns", _GROWTH, oracle.GROWTH_TABLE)
def _(fx):
    changes = _changes(fx)
    return late.merge_late_growth(_growth_before(fx), late.late_growth(fx.table("summary"), changes), changes, RUN_AT)


# --- office --------------------------------------------------------------------------------

@query("office_totals", _OFFICE_TOTALS, f"select {oracle.OFFICE_TOTAL_COLUMNS} from o_offices_repeated o")
def _(fx):
    return office.office_totals(
        fx.table("summary_repeated"), fx.table("dealer_repeated"), fx.table("juri_repeated"))


@query("office_growth", _OFFICE_GROWTH,
       f"select g.ret_period, g.st_juri, {oracle.OFFICE_GROWTH_COLUMNS} from o_office_growth_stored g")
def _(fx):
    # the periods of a run are its parameter; earlier months are looked up in the stored table
    wanted = [f"{month:02d}{year}" for year in range(1998, 2011) for month in range(1, 13)]
    return pipelines.office_revenue(
        fx.table("summary"), fx.table("dealer"), fx.table("juri"), _repeated_offices(fx), wanted)


@query("office_revenue_period", f"{_OFFICE_TOTALS}; {_OFFICE_GROWTH}",
       f"select {oracle.OFFICE_TOTAL_COLUMNS}, {oracle.OFFICE_GROWTH_COLUMNS} from o_offices o "
       f"join o_office_growth g on g.ret_period = o.ret_period and g.st_juri = o.st_juri where o.ret_period = '{PERIOD}'")
def _(fx):
    return pipelines.office_revenue(fx.table("summary"), fx.table("dealer"), fx.table("juri"), _offices(fx), [PERIOD])


@query("office_revenue", f"{_OFFICE_TOTALS}; {_OFFICE_GROWTH}",
       f"select {oracle.OFFICE_TOTAL_COLUMNS}, {oracle.OFFICE_GROWTH_COLUMNS} from o_offices o "
       "join o_office_growth g on g.ret_period = o.ret_period and g.st_juri = o.st_juri")
def _(fx):
    return pipelines.office_revenue(fx.table("summary"), fx.table("dealer"), fx.table("juri"))


@query("master_dedup", "s: code value",
       """select gstin code, max(st_juri) as "value" from dealer_repeated where gstin is not null and st_juri is not null group by 1
       union all select jurisdiction_code, max(jurisdiction_name) from juri_repeated
         where jurisdiction_code is not null group by 1""")
def _(fx):
    return office.dealer_offices(fx.table("dealer_repeated")).toDF("code", "value").unionByName(
        office.office_names(fx.table("juri_repeated")).toDF("code", "value"))


@query("dealers_in_period", "s: gstin st_juri",
       f"select * from dealer_repeated where gstin in (select gstin from summary where ret_period = '{PERIOD}')")
def _(fx):
    return office.dealers_in_period(fx.table("dealer_repeated"), fx.table("summary"), [PERIOD])


# --- distinct taxpayers --------------------------------------------------------------------

def _filer_bits(fx: Fixtures) -> DataFrame:
    """The stored bitmaps of all periods and offices."""
    def build() -> DataFrame:
        ids = fx.keep("taxpayer_ids", lambda: bitmaps.taxpayer_ids(fx.table("summary_repeated")))
        return bitmaps.filer_bitmaps(
            fx.table("summary_repeated"), ids, fx.table("dealer_repeated"), fx.table("juri_repeated"))

    return bitmaps.with_calendar(fx.keep("filer_bits", build))


_OFFICE_FILERS = """
    select substr(ret_period,3,4) "year", (cast(substr(ret_period,1,2) as int)+2)//3 "quarter", st_juri, gstin from (
      select ret_period, gstin, (select max(m.st_juri) from dealer_repeated m where m.gstin = s.gstin) st_juri
      from summary_repeated s where gstin is not null) t
    where st_juri in (select jurisdiction_code from juri_repeated where jurisdiction_code is not null)"""


@query("filed_gstins_by_quarter", "s: year st_juri; i: quarter filed_gstins",
       f'select "year", "quarter", st_juri, count(distinct gstin) filed_gstins from ({_OFFICE_FILERS}) x group by all')
def _(fx):
    return bitmaps.distinct_filers(_filer_bits(fx), "year", "quarter", "st_juri")


@query("filed_gstins_by_year", "s: year; i: filed_gstins",
       f'select "year", count(distinct gstin) filed_gstins from ({_OFFICE_FILERS}) x group by all')
def _(fx):
    return bitmaps.distinct_filers(_filer_bits(fx), "year")


# --- quality -------------------------------------------------------------------------------

@query("source_counts", "s: ret_period; i: source_rows source_gstins",
       "select ret_period, count(*) source_rows, count(distinct gstin) source_gstins from summary_repeated group by 1")
def _(fx):
    return quality.source_counts(fx.table("summary_repeated"))


@query("duplicate_source", "s: ret_period; i: duplicate_gstins",
       "select ret_period, count(case when n > 1 then 1 end) duplicate_gstins from "
       "(select ret_period, gstin, count(*) n from summary_repeated group by 1, 2) x group by 1")
def _(fx):
    return quality.duplicate_source(fx.table("summary_repeated"))


@query("missing_period_date", "s: ret_period; i: missing_dates",
       "select ret_period, count(*) - count(period_date) missing_dates from summary_repeated group by 1")
def _(fx):
    return quality.missing_period_dates(fx.table("summary_repeated"))


@query("unmapped_registrations", "s: ret_period; i: unmapped_registrations",
       "select ret_period, count(*) filter (no_office) unmapped_registrations from o_flags_repeated group by 1")
def _(fx):
    return quality.unmapped_registrations(fx.table("summary_repeated"), fx.table("dealer_repeated"))


@query("unmapped_jurisdictions", "s: ret_period; i: unmapped_jurisdictions",
       "select ret_period, count(*) unmapped_jurisdictions from o_flags_repeated where unknown_office group by 1")
def _(fx):
    return quality.unmapped_jurisdictions(
        fx.table("summary_repeated"), fx.table("dealer_repeated"), fx.table("juri_repeated"))


@query("duplicate_mappings", "s: ret_period; i: duplicate_mappings",
       "select ret_period, count(*) duplicate_mappings from o_flags_repeated where several_offices group by 1")
def _(fx):
    return quality.duplicate_mappings(fx.table("summary_repeated"), fx.table("dealer_repeated"))


_PRECHECK_COLUMNS = (
    "s: ret_period; i: source_rows source_gstins unmapped_registrations unmapped_jurisdictions duplicate_mappings "
    "duplicate_source_gstins")


@query("office_precheck", _PRECHECK_COLUMNS,
       """select ret_period, sum(n) source_rows, count(gstin) source_gstins,
         count(*) filter (no_office) unmapped_registrations, count(*) filter (unknown_office) unmapped_jurisdictions,
         count(*) filter (several_offices) duplicate_mappings, count(*) filter (n > 1) duplicate_source_gstins
       from o_flags_repeated group by 1""")
def _(fx):
    return quality.office_precheck(
        fx.table("summary_repeated"), fx.table("dealer_repeated"), fx.table("juri_repeated"))


@query("duplicate_keys", f"{_KEY}; i: n",
       "select gstin, ret_period, count(*) n from summary_repeated group by 1, 2 having count(*) > 1")
def _(fx):
    return quality.duplicate_keys(fx.table("summary_repeated"), ["gstin", "ret_period"])


@query("bad_taxpayer_keys", "s: gstin; i: n",
       f"select * from (select upper({oracle.trimmed('txt')}) gstin, count(*) n from key_texts group by 1) x "
       "where gstin is null or n > 1")
def _(fx):
    return quality.bad_taxpayer_keys(fx.table("key_texts").withColumnRenamed("txt", "gstin"))


@query("invalid_periods", "s: ret_period; i: rows",
       """select ret_period, count(*) as "rows" from history
       where not coalesce(regexp_full_match(ret_period, '(0[1-9]|1[0-2])[0-9]{4}'), false) group by 1""")
def _(fx):
    return quality.invalid_periods(fx.table("history"))


@query("duplicate_office_month", "s: st_juri; i: month_idx n",
       """select st_juri, month_idx, count(*) n from (
         select st_juri, year(period_date)*12 + month(period_date) - 1 month_idx from o_offices union all
         select st_juri, year(period_date)*12 + month(period_date) - 1 from o_offices_repeated) x
       group by 1, 2 having count(*) > 1""")
def _(fx):
    return quality.duplicate_office_months(_offices(fx).unionByName(_repeated_offices(fx)))


@query("growth_coverage", "s: ret_period; i: growth_rows summary_rows; b: incomplete",
       """select coalesce(g.ret_period, s.ret_period) ret_period, coalesce(g.n,0) growth_rows, coalesce(s.n,0) summary_rows,
         coalesce(g.n,0) < coalesce(s.n,0) incomplete
       from (select ret_period, count(*) n from summary_before where gstin is not null group by 1) g full join
         (select ret_period, count(*) n from summary group by 1) s on s.ret_period = g.ret_period""")
def _(fx):
    return quality.growth_coverage(_growth_before(fx), fx.table("summary"))


# --- risk ----------------------------------------------------------------------------------

def _huge(fx: Fixtures) -> DataFrame:
    """Amounts as doubles in a unit so small that the largest overflow 32-bit floats."""
    return fx.table("summary").withColumns({
        name: F.coalesce(F.col(name), F.lit(0)).cast("double") * F.lit(1e33) for name in risk.AMOUNTS})


@query("risk_features", _FEATURES, "select * from o_features")
def _(fx):
    return risk.risk_features(fx.table("summary"))


@query("risk_score", f"{_KEY}; n: risk_score", "select * from o_scores")
def _(fx):
    return risk.risk_features(fx.table("summary")).withColumn("risk_score", trees.score(_model(), arrow=False))


@query("risk_score_arrow", f"{_KEY}; n: risk_score", "select * from o_scores")
def _(fx):
    return risk.risk_features(fx.table("summary")).withColumn("risk_score", trees.score(_model(), arrow=True))


@query("risk_band", f"{_KEY} risk_level", "select gstin, ret_period, risk_level from o_risk")
def _(fx):
    scored = risk.risk_features(fx.table("summary")).withColumn("risk_score", trees.score(_model()))
    return scored.withColumn("risk_level", bands.risk_band(F.col("risk_score")))


@query("risk_rejects", f"{_KEY} error_message",
       f"""select gstin, ret_period, 'Feature ' || {oracle.first_infinite()} || ' contains infinite value' error_message
       from o_huge_features where {oracle.first_infinite()} is not null""")
def _(fx):
    return pipelines.risk_profile(_huge(fx), _model())[1]


@query("risk_counters", "s: ret_period; i: rows_read scored failed; n: failed_percent",
       f"""select ret_period, count(*) rows_read, count(*) - count({oracle.first_infinite()}) scored,
         count({oracle.first_infinite()}) failed, count({oracle.first_infinite()})*100.0::double/count(*) failed_percent
       from o_huge_features group by 1""")
def _(fx):
    return runs.risk_counters(risk.scored_returns(_huge(fx), _model()))


_PROFILE = f"{_KEY} risk_level model_name model_version feature_version; n: risk_score"
_PROFILE_SQL = ("select gstin, ret_period, risk_level, 'sample_trees' model_name, '1' model_version, "
                "'18' feature_version, risk_score from o_risk")


@query("risk_profile", _PROFILE, _PROFILE_SQL)
def _(fx):
    return pipelines.risk_profile(fx.table("summary"), _model())[0]


# --- defaulters ----------------------------------------------------------------------------

@query("eligible", "s: gstin st_juri",
       """select upper(gstin_id) gstin, max(state_jursd_cd) st_juri from registration_by_quarter
       where yy = '00' and quarter = 'apr_jun' and gstin_id is not null and auth_status = 'A' and upper(pref) = 'M'
       group by 1""")
def _(fx):
    return defaulters.eligible(fx.table("registration_by_quarter"), "052000")


@query("eligible_count", "i: eligible", "select count(*) eligible from o_eligible")
def _(fx):
    return defaulters.eligible_count(fx.table("registration"), PERIOD)


@query("due_date", "s: ret_period due_date; i: active_dates",
       """select ret_period, count(*) active_dates, case when count(*) = 1 then max(effective_due_date) end due_date
       from due_mixed where return_type = 'GSTR3B' and active_flag = 'Y' and effective_due_date is not null group by 1""")
def _(fx):
    return defaulters.due_dates(fx.table("due_mixed"))


@query("current_return", "s: gstin filing_date; n: total_output_tax taxable_value",
       """select gstin, filing_date, total_output_tax, taxable_value from (
         select s.*, row_number() over (partition by s.gstin order by filing_date desc nulls last,
           total_output_tax desc nulls last, taxable_value desc nulls last) rn
         from summary_repeated s join o_eligible e on e.gstin = s.gstin where ret_period = '062000') x where rn = 1""")
def _(fx):
    return defaulters.current_return(
        fx.table("summary_repeated"), defaulters.eligible(fx.table("registration"), PERIOD), PERIOD)


def _growth(fx: Fixtures) -> DataFrame:
    """The stored growth table."""
    return fx.keep("growth", lambda: pipelines.growth_analytics(fx.table("summary"), most_rows=growth.MOST_ROWS))


def _risk(fx: Fixtures) -> DataFrame:
    """The stored risk table."""
    return fx.keep("risk", lambda: pipelines.risk_profile(fx.table("summary"), _model())[0])


@query("last_filed", "s: gstin last_filed_period last_filing_date; n: avg_output_tax_3m avg_output_tax_6m avg_output_tax_12m",
       """select gstin, ret_period last_filed_period, filing_date last_filing_date, a3/1e6 avg_output_tax_3m,
         a6/1e6 avg_output_tax_6m, a12/1e6 avg_output_tax_12m from o_last_filed""")
def _(fx):
    return defaulters.last_filed(_growth(fx), fx.table("summary"), PERIOD)


@query("historical_defaults", "s: gstin; i: default_count", "select gstin, n default_count from o_past")
def _(fx):
    return defaulters.historical_defaults(fx.table("history"), PERIOD)


@query("effective_period_join", "s: gstin effective_period growth_trend risk_level; n: risk_score; b: filed",
       """select c.gstin, c.filed, c.effective_period, c.growth_status growth_trend, c.risk_level, r.risk_score
       from o_candidates c left join o_risk r on r.gstin = c.gstin and r.ret_period = c.effective_period""")
def _(fx):
    summary = fx.table("summary")
    return defaulters.with_effective_period(
        defaulters.eligible(fx.table("registration"), PERIOD),
        defaulters.latest_return(summary, PERIOD),
        defaulters.last_filed(_growth(fx), summary, PERIOD, risk=_risk(fx)),
        _growth(fx),
        _risk(fx),
        PERIOD,
    )


def _candidates(fx: Fixtures) -> DataFrame:
    return defaulters.defaulter_candidates(
        fx.table("registration"), fx.table("summary"), _growth(fx), _risk(fx), fx.table("history"), fx.table("juri"),
        PERIOD, DUE)


@query("defaulter_candidates",
       "s: gstin ret_period due_date filing_date last_filed_period last_filing_date growth_status risk_level st_juri "
       "office_name; b: filed; i: historical_default_count; n: taxable_value output_tax avg_output_tax_3m "
       "avg_output_tax_6m avg_output_tax_12m risk_score",
       """select gstin, ret_period, due_date, filed, filing_date, tv/100 taxable_value, ot/100 output_tax,
         last_filed_period, last_filing_date, a3/1e6 avg_output_tax_3m, a6/1e6 avg_output_tax_6m,
         a12/1e6 avg_output_tax_12m, growth_status, risk_level, risk_score, past historical_default_count, st_juri,
         office_name from o_candidates""")
def _(fx):
    return _candidates(fx)


@query("return_defaulters", _RESULT, oracle.RESULT_SELECT)
def _(fx):
    return defaulters.evaluate_defaulters(_candidates(fx), AS_OF)[0]


@query("reject_split", f"{_KEY} error_code error_message",
       """select gstin, ret_period, error_code, case error_code when 'INVALID_GSTIN' then 'Invalid GSTIN format'
         when 'FILING_DATE_MISSING' then 'Filed return requires FILING_DATE' end error_message from o_checked""")
def _(fx):
    results, rejects = defaulters.evaluate_defaulters(_candidates(fx), AS_OF)
    return results.select("gstin", "ret_period").unionByName(rejects, allowMissingColumns=True)


_COUNTERS = "i: scanned written skipped not_filed filed_late filed_on_time notice_eligible"
_COUNTERS_SQL = f"""
    select '{PERIOD}' ret_period, count(*) scanned, count(*) - count(error_code) written, count(error_code) skipped,
      count(case when e.filing_status = 'NOT_FILED' then 1 end) not_filed,
      count(case when e.filing_status = 'FILED_LATE' then 1 end) filed_late,
      count(case when e.filing_status = 'FILED_ON_TIME' then 1 end) filed_on_time,
      count(case when e.filing_status = 'NOT_FILED' and {oracle.AS_OF} > c.due_date then 1 end) notice_eligible
    from o_checked c left join (select gstin g, filing_status from o_evaluated) e on e.g = c.gstin"""


@query("defaulter_counters", f"s: ret_period; {_COUNTERS}", _COUNTERS_SQL)
def _(fx):
    return runs.defaulter_counters(*defaulters.evaluate_defaulters(_candidates(fx), AS_OF))


# --- logs ----------------------------------------------------------------------------------

@query("reject_log", f"s: run_id job_name gstin ret_period error_code error_message created_at; i: retry_count",
       f"""select '{RUN_ID}' run_id, 'RETURN_DEFAULTER' job_name, gstin, ret_period, error_code,
         case error_code when 'INVALID_GSTIN' then 'Invalid GSTIN format' else 'Filed return requires FILING_DATE' end
         error_message, 0 retry_count, '{RUN_AT}' created_at from o_checked where error_code is not null""")
def _(fx):
    return runs.reject_log(defaulters.evaluate_defaulters(_candidates(fx), AS_OF)[1], RUN_ID, RUN_AT)


@query("run_summary", f"s: run_id job_name ret_period status message; i: total_eligible; {_COUNTERS}",
       f"""select '{RUN_ID}' run_id, 'RETURN_DEFAULTER' job_name, x.*, (select count(*) from o_eligible) total_eligible,
         case when skipped > 0 then 'COMPLETED_WITH_ERRORS' else 'COMPLETED' end status,
         case when skipped > 0 then 'Completed with quarantined invalid source records'
           else 'Completed successfully' end message from ({_COUNTERS_SQL}) x""")
def _(fx):
    counters = runs.defaulter_counters(*defaulters.evaluate_defaulters(_candidates(fx), AS_OF))
    population = defaulters.eligible_count(fx.table("registration"), PERIOD).withColumn("ret_period", F.lit(PERIOD))
    return runs.run_summary(counters, population, RUN_ID)


@query("run_summary_empty", f"s: run_id job_name ret_period status message; i: total_eligible; {_COUNTERS}",
       f"""select '{RUN_ID}' run_id, 'RETURN_DEFAULTER' job_name, '{PERIOD}' ret_period, 'COMPLETED' status,
         'Completed successfully' message, n total_eligible, n scanned, n written, n skipped, n not_filed, n filed_late,
         n filed_on_time, n notice_eligible
       from (select count(*) n from registration where auth_status = 'NOBODY') x""")
def _(fx):
    nobody = fx.table("registration").filter("auth_status = 'NOBODY'")
    candidates = defaulters.defaulter_candidates(
        nobody, fx.table("summary"), _growth(fx), _risk(fx), fx.table("history"), fx.table("juri"), PERIOD, DUE)
    counters = runs.defaulter_counters(*defaulters.evaluate_defaulters(candidates, AS_OF))
    return runs.run_summary(
        counters, defaulters.eligible_count(nobody, PERIOD).withColumn("ret_period", F.lit(PERIOD)), RUN_ID)


@query("revenue_run_summary",
       "s: run_id ret_period status message; i: source_rows source_gstins offices_processed unmapped_registrations "
       "unmapped_jurisdictions duplicate_mappings",
       f"""select '{RUN_ID}' run_id, ret_period, 'SUCCESS' status, sum(n) source_rows, count(gstin) source_gstins,
         (select count(*) from o_offices o where o.ret_period = f.ret_period) offices_processed,
         count(*) filter (no_office) unmapped_registrations, count(*) filter (unknown_office) unmapped_jurisdictions,
         count(*) filter (several_offices) duplicate_mappings, 'Office revenue batch completed successfully' message
       from o_flags f group by ret_period""")
def _(fx):
    precheck = quality.office_precheck(fx.table("summary"), fx.table("dealer"), fx.table("juri"))
    return runs.revenue_run_summary(precheck, _offices(fx), RUN_ID)


_AGAIN = [f"{month:02d}2000" for month in range(1, 13)]


@query("latest_runs", "s: job_name ret_period run_id started_at status",
       f"""select 'OFFICE_REVENUE' job_name, ret_period, case when ret_period like '__2000' then 'run-2' else 'run-1' end run_id,
         case when ret_period like '__2000' then '2000-08-15 03:30:00' else '{RUN_AT}' end started_at, 'SUCCESS' status
       from summary where ret_period is not null group by ret_period
       union all select 'RETURN_DEFAULTER', ret_period, '{RUN_ID}', '{RUN_AT}',
         case when skipped > 0 then 'COMPLETED_WITH_ERRORS' else 'COMPLETED' end from ({_COUNTERS_SQL}) x""")
def _(fx):
    """Over the rows two office runs and a defaulter run write; the months of 2000 were run again."""
    inputs = [fx.table(name) for name in ("summary", "dealer", "juri")]
    again = dt.timedelta(hours=1)
    log = [
        runs.revenue_run_summary(quality.office_precheck(*inputs, periods), _offices(fx), run).select(
            F.lit("OFFICE_REVENUE").alias("job_name"), "ret_period", "run_id", F.lit(start).cast("timestamp").alias("started_at"), "status")
        for run, start, periods in (("run-1", RUN_AT, None), ("run-2", RUN_AT + again, _AGAIN))
    ]
    counters = runs.defaulter_counters(*defaulters.evaluate_defaulters(_candidates(fx), AS_OF))
    population = defaulters.eligible_count(fx.table("registration"), PERIOD).withColumn("ret_period", F.lit(PERIOD))
    evaluated = runs.run_summary(counters, population, RUN_ID).select(
        "job_name", "ret_period", "run_id", F.lit(RUN_AT).cast("timestamp").alias("started_at"), "status")
    return runs.latest_runs(log[0].unionByName(log[1]).unionByName(evaluated))


# --- pages and ranges ----------------------------------------------------------------------

@query("page_after", "s: gstin st_juri",
       "select * from o_eligible where gstin > '11ABCDE' order by gstin limit 40")
def _(fx):
    return ranges.page_after(defaulters.eligible(fx.table("registration"), PERIOD), "gstin", 40, " 11abcde ")


@query("key_slice", f"{_KEY}; n: taxable_value",
       "select gstin, ret_period, taxable_value from summary where gstin between '15' and '25'")
def _(fx):
    return ranges.key_slice(fx.table("summary"), "gstin", "15", "25")


@query("equi_depth_ranges", "s: lo hi; i: bucket rows",
       """select bucket, min(gstin) lo, max(gstin) hi, count(*) as "rows" from
         (select gstin, ntile(7) over (order by gstin) bucket from summary) x group by 1""")
def _(fx):
    return ranges.equi_depth_ranges(fx.table("summary"), "gstin", 7)


# --- upserts -------------------------------------------------------------------------------

# the table as an earlier run left it: periods before 1998, with other values, created earlier
_EARLIER = "timestamp '1999-01-01 00:00:00'"
_OLD = "cast(substr(ret_period,3,4) as int) < 1998"


def _with_times(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.expr(_EARLIER) for name in names})


@query("upsert_growth", f"{_KEY} growth_trend created_at updated_at; n: taxable_value yoy_taxable_growth avg_6m_itc",
       f"""select gstin, ret_period, trend growth_trend, tv/100 taxable_value, g_yoy_taxable/1e6 yoy_taxable_growth,
         a_6_itc/1e6 avg_6m_itc, case when {_OLD} then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at,
         '{RUN_AT}' updated_at from o_growth""")
def _(fx):
    rows = pipelines.growth_analytics(fx.table("summary"))
    stored = _with_times(_growth(fx).filter(_OLD).withColumns({
        "taxable_value": F.lit(0).cast("decimal(18,2)"), "growth_trend": F.lit("NA")}), "created_at", "updated_at")
    return pipelines.merge_growth(stored, rows, RUN_AT)


@query("upsert_growth_bucketed", f"{_KEY} growth_trend created_at updated_at; n: taxable_value yoy_taxable_growth avg_6m_itc",
       f"""select gstin, ret_period, trend growth_trend, tv/100 taxable_value, g_yoy_taxable/1e6 yoy_taxable_growth,
         a_6_itc/1e6 avg_6m_itc, case when tv % 2 = 0 then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at,
         '{RUN_AT}' updated_at from o_growth where ret_period = '{PERIOD}'""")
def _(fx):
    return pipelines.merge_growth_period(
        tables.period_slice(_growth_by_taxpayer(fx), PERIOD), pipelines.growth_analytics(fx.table("summary"), [PERIOD]),
        PERIOD, RUN_AT)


def _growth_by_taxpayer(fx: Fixtures) -> DataFrame:
    """Growth as an earlier run left it, without every other row and with other values, bucketed by taxpayer."""
    return fx.bucketed("growth", lambda: _with_times(
        _growth(fx).filter("cast(taxable_value*100 as bigint) % 2 = 0").withColumn("growth_trend", F.lit("NA")),
        "created_at", "updated_at"))


@query("current_return_bucketed", "s: gstin filing_date; n: total_output_tax taxable_value", CATALOG["current_return"].sql)
def _(fx):
    stored = fx.bucketed("summary_repeated", lambda: fx.table("summary_repeated"))
    return defaulters.current_return(stored, defaulters.eligible(fx.table("registration"), PERIOD), PERIOD)


@query("defaulter_candidates_bucketed",
       "s: gstin effective_period growth_trend risk_level; n: risk_score; b: filed", CATALOG["effective_period_join"].sql)
def _(fx):
    summary, stored, risks = (
        fx.bucketed(name, build) for name, build in (
            ("summary", lambda: fx.table("summary")), ("growth_now", lambda: _growth(fx)), ("risk", lambda: _risk(fx))))
    return defaulters.with_effective_period(
        defaulters.eligible(fx.table("registration"), PERIOD), defaulters.latest_return(summary, PERIOD),
        defaulters.last_filed(stored, summary, PERIOD, risk=risks), stored, risks, PERIOD)


@query("upsert_risk", f"{_PROFILE}; s: created_at updated_at processed_at; i: batch_id",
       f"""select p.*, case when {_OLD} then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at, '{RUN_AT}' updated_at,
         '{RUN_AT}' processed_at, 7 batch_id from ({_PROFILE_SQL}) p""")
def _(fx):
    profile = pipelines.risk_profile(fx.table("summary"), _model())[0]
    stored = _with_times(
        _risk(fx).filter(_OLD).withColumns({"risk_score": F.lit(0.0), "model_version": F.lit("0"),
                                          "batch_id": F.lit(1).cast("bigint")}),
        "processed_at", "created_at", "updated_at")
    return pipelines.merge_risk(stored, profile, RUN_AT, 7)


@query("upsert_defaulter",
       "s: gstin ret_period filing_status default_level notice_status active_flag first_detected_at last_evaluated_at "
       "created_at; i: delay_days; n: default_score",
       f"""select gstin, ret_period, filing_status, {oracle.level_of('points')} default_level,
         case when filing_status = 'NOT_FILED' then 'ISSUED' else 'NOT_ISSUED' end notice_status, 'Y' active_flag,
         case when filing_status = 'NOT_FILED' then '1999-01-01 00:00:00' else '{RUN_AT}' end first_detected_at,
         '{RUN_AT}' last_evaluated_at,
         case when filing_status = 'NOT_FILED' then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at,
         delay_days, points/100 default_score from o_results""")
def _(fx):
    # an earlier evaluation found the non-filers and notices went out; the rows were closed since
    checked = defaulters.checked_candidates(_candidates(fx))
    results = defaulters.results_of(checked, AS_OF)
    earlier = defaulters.results_of(checked, DUE.replace(day=25)).filter("filing_status = 'NOT_FILED'")
    stored = _with_times(
        earlier.withColumns({"notice_status": F.lit("ISSUED"), "active_flag": F.lit("N")}),
        "first_detected_at", "last_evaluated_at", "created_at", "updated_at")
    return pipelines.merge_defaulters(stored, results, RUN_AT)


def _stored_offices(fx: Fixtures) -> DataFrame:
    """The office table an earlier run left, from the repeated inputs."""
    def build() -> DataFrame:
        return _with_times(office.office_growth(_repeated_offices(fx)), "created_at", "updated_at")

    return fx.keep("offices_stored", build)


@query("upsert_office", f"{_OFFICE_TOTALS}; s: growth_status created_at; n: yoy_output_growth",
       f"""select coalesce(o.ret_period, r.ret_period) ret_period, coalesce(o.st_juri, r.st_juri) st_juri,
         coalesce(o.period_date, r.period_date) period_date, coalesce(o.office_name, r.office_name) office_name,
         coalesce(o.filed_gstins, r.filed_gstins) filed_gstins, {', '.join(
             f"coalesce(o.{c}, r.{c})/100 {c}" for c in
             ('taxable_value', 'output_tax', 'igst', 'cgst', 'sgst', 'cess', 'eligible_itc', 'utilized_itc', 'cash_tax_paid'))},
         g.growth_status, g.yoy_output/100 yoy_output_growth,
         case when r.ret_period is not null then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at
       from o_offices o full join o_offices_repeated r on r.ret_period = o.ret_period and r.st_juri = o.st_juri
         left join o_office_growth_repeated g on g.ret_period = r.ret_period and g.st_juri = r.st_juri""")
def _(fx):
    return pipelines.merge_office_totals(_stored_offices(fx), _offices(fx), RUN_AT)


@query("office_growth_update", f"{_OFFICE_GROWTH}; n: output_tax",
       f"""select o.ret_period, o.st_juri, o.output_tax/100 output_tax, {oracle.OFFICE_GROWTH_COLUMNS}
       from o_offices o left join o_office_growth g on g.ret_period = o.ret_period and g.st_juri = o.st_juri
         and g.growth_trend <> 'MIXED'""")
def _(fx):
    totals = _offices(fx)
    fresh = office.office_growth(totals)
    empty = fresh.withColumns({name: F.lit(None).cast(fresh.schema[name].dataType) for name in office.GROWTH_COLUMNS})
    return pipelines.update_office_growth(
        _with_times(empty, "created_at", "updated_at"), fresh.filter("growth_trend <> 'MIXED'"), RUN_AT)


@query("office_growth_missing", "s: ret_period st_juri",
       """select g.ret_period, g.st_juri from o_office_growth_repeated g where not exists (
         select 1 from o_offices o where o.ret_period = g.ret_period and o.st_juri = g.st_juri)""")
def _(fx):
    return rows_without_target(_offices(fx), _stored_offices(fx), ["ret_period", "st_juri"])


@query("office_stale", "s: ret_period st_juri",
       """select ret_period, st_juri from o_offices_repeated except
       select ret_period, st_juri from o_offices""")
def _(fx):
    return stale_keys(_stored_offices(fx), _offices(fx), ["ret_period", "st_juri"])


@query("office_period_write", f"{_OFFICE_TOTALS}; {_OFFICE_GROWTH}; s: created_at",
       f"""select {oracle.OFFICE_TOTAL_COLUMNS}, {oracle.OFFICE_GROWTH_COLUMNS},
         case when r.ret_period is not null then '1999-01-01 00:00:00' else '{RUN_AT}' end created_at
       from o_offices o join o_office_growth g on g.ret_period = o.ret_period and g.st_juri = o.st_juri
         left join o_offices_repeated r on r.ret_period = o.ret_period and r.st_juri = o.st_juri""")
def _(fx):
    """What is read back after a second write replaced the periods of a first one."""
    offices = pipelines.office_revenue(fx.table("summary"), fx.table("dealer"), fx.table("juri"))
    store = Published(fx.spark, f"{staging_folder(fx.spark)}/published-{uuid.uuid4().hex}")
    store.publish(_stored_offices(fx))
    stored = store.read(_stored_offices(fx).schema)
    store.publish(pipelines.merge_offices(stored, offices, RUN_AT), periods=[d.removeprefix("ret_period=") for d in store.state().versions])
    return store.read(stored.schema)
