"""Registered queries: snowflake model (K)."""

from __future__ import annotations

from ledgerline.operators import model as M
from ledgerline.plans.catalog import register
from ledgerline.plans.oracle_sql import typed_sql
from ledgerline.plans.tables import Tables
from ledgerline.sources.layouts import DIMENSIONS, FACTS, LAYOUTS

T = {n: typed_sql(n) for n in LAYOUTS}


def _canon_sql() -> str:
    cols = ["cycle"] + LAYOUTS["pas2"].names
    return "select " + ", ".join(f"{c} as {M.CANONICAL_NAMES.get(c, c)}" for c in cols) + f" from {T['pas2']} p"


def _canon_union_sql(tables) -> str:
    renamed = lambda n: ", ".join(f"{c} as {M.CANONICAL_NAMES.get(c, c)}" for c in ["cycle"] + LAYOUTS[n].names)
    return " union all by name ".join(f"select '{n}' as source_table, {renamed(n)} from {T[n]} x{i}" for i, n in enumerate(tables))


def _latest_sql(table: str, key: str, select: str) -> str:
    return (f"select {select}, cycle as latest_cycle, n_cycles from (select *, row_number() over "
            f"(partition by {key} order by cycle desc) as rn, count(*) over (partition by {key}) as n_cycles "
            f"from {T[table]} s where {key} is not null) x where rn = 1")


DIM_CANDIDATE_SQL = _latest_sql(
    "cn", "CAND_ID",
    "CAND_ID as candidate_id, CAND_NAME as candidate_name, CAND_PTY_AFFILIATION as party, CAND_OFFICE as office, "
    "CAND_OFFICE_ST as office_state, CAND_OFFICE_DISTRICT as office_district, CAND_ICI as incumbent_status, "
    "CAND_STATUS as candidate_status, CAND_ELECTION_YR as election_year, CAND_PCC as principal_committee_id")
DIM_COMMITTEE_SQL = _latest_sql(
    "cm", "CMTE_ID",
    "CMTE_ID as committee_id, CMTE_NM as committee_name, CMTE_TP as committee_type, CMTE_DSGN as designation, "
    "CMTE_PTY_AFFILIATION as party, CMTE_FILING_FREQ as filing_frequency, ORG_TP as org_type, "
    "CMTE_ST as state, CAND_ID as candidate_id")

_ALL_FACT_DATES = " union all ".join(f"select TRANSACTION_DT as d from {T[f]} x{i}" for i, f in enumerate(FACTS))
DIM_TIME_SQL = (
    f"select cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_key, d as date, "
    f"cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month, "
    f"cast(weekofyear(d) as integer) as iso_week, cast(day(d) as integer) as day, "
    f"cast(isodow(d) as integer) as iso_day_of_week, cast(year(d) + year(d) % 2 as integer) as cycle "
    f"from (select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as d "
    f"from ({_ALL_FACT_DATES}) u having min(d) is not null) s")

_ALL_PGI = " union all ".join(f"select TRANSACTION_PGI as c from {T[f]} x{i}" for i, f in enumerate(FACTS))
DIM_ELECTION_SQL = (
    f"select c as election_code, substr(c, 1, 1) as election_type, try_cast(substr(c, 2, 4) as integer) "
    f"as election_year, count(*) as n_rows from ({_ALL_PGI}) u where c is not null group by c")

_NAMED = lambda code, names: f"case {code} " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + " end"
_TYPES = ", ".join(f"('{t}')" for t in M.ELECTION_TYPES)
DIM_TYPE_SQL = (
    f"select election_type, {_NAMED('election_type', M.ELECTION_TYPES)} as type_name, "
    f"coalesce(n_elections, 0) as n_elections, cast(coalesce(n_rows, 0) as bigint) as n_rows from (values {_TYPES}) t(election_type) "
    f"full join (select election_type, count(*) as n_elections, sum(n_rows) as n_rows from ({DIM_ELECTION_SQL}) e "
    f"group by election_type) c using (election_type)")

_OFFICE_KEY = "case when CAND_OFFICE is not null then concat_ws('-', CAND_OFFICE, CAND_OFFICE_ST) end"
DIM_OFFICE_SQL = (
    f"select {_OFFICE_KEY} as office_key, CAND_OFFICE as office, {_NAMED('CAND_OFFICE', M.OFFICES)} as office_name, "
    f"CAND_OFFICE_ST as state, count(distinct CAND_ID) as n_candidates from {T['cn']} c where CAND_OFFICE is not null "
    f"group by CAND_OFFICE, CAND_OFFICE_ST")

_CONTEST_ROWS = " union all ".join(
    f"select cycle, TRANSACTION_PGI as code, CMTE_ID, {'CAND_ID' if 'CAND_ID' in LAYOUTS[f].names else 'null::varchar as CAND_ID'} "
    f"from {T[f]} x{i} where TRANSACTION_PGI is not null" for i, f in enumerate(FACTS))
DIM_CONTEST_SQL = (
    f"with f as ({_CONTEST_ROWS}), r as (select f.cycle, f.code, coalesce(f.CAND_ID, m.CAND_ID) as CAND_ID from f left join "
    f"{T['cm']} m on f.CAND_ID is null and m.cycle = f.cycle and m.CMTE_ID = f.CMTE_ID), "
    f"o as (select r.code, {_OFFICE_KEY} as office_key from r left join {T['cn']} n on n.cycle = r.cycle and n.CAND_ID = r.CAND_ID) "
    f"select code || '/' || coalesce(office_key, '-') as contest_key, code as election_code, substr(code, 1, 1) as election_type, "
    f"try_cast(substr(code, 2, 4) as integer) as election_year, office_key, count(*) as n_rows from o group by code, office_key")

DIM_CODES_SQL = (
    "select domain, code, count(*) as n_rows, null::varchar as name from ("
    + " union all ".join(f"select '{d}' as domain, {c} as code from {T[t]} x{i}"
                         for i, (d, t, c) in enumerate(M.CODE_DOMAINS))
    + ") u where code is not null group by domain, code")

BRIDGE_SQL = (f"select cycle, CAND_ID, CMTE_ID, count(*) as n_links from {T['ccl']} c "
              f"where CAND_ID is not null and CMTE_ID is not null group by all")

_CONTRIB = ", ".join(M.CONTRIB_COLUMNS)
CONTRIB_SQL = (f"select {_CONTRIB.replace('CAND_ID', 'null::varchar as CAND_ID')}, 'indiv' as source_table "
               f"from {T['indiv']} i union all select {_CONTRIB}, 'pas2' as source_table from {T['pas2']} p")

DISB_SQL = (f"select cycle, SUB_ID, CMTE_ID, RPT_YR, TRANSACTION_DT, TRANSACTION_AMT, PURPOSE, CATEGORY, "
            f"ENTITY_TP, STATE, FILE_NUM from {T['oppexp']} o")

TRANSFERS_SQL = (
    f"select o.cycle, o.SUB_ID, o.CMTE_ID as source_committee_id, s.CMTE_NM as source_committee_name, "
    f"o.OTHER_ID as destination_committee_id, d.CMTE_NM as destination_committee_name, o.TRANSACTION_DT, "
    f"o.TRANSACTION_AMT from {T['oth']} o left join {T['cm']} s on o.cycle = s.cycle and o.CMTE_ID = s.CMTE_ID "
    f"left join {T['cm']} d on o.cycle = d.cycle and o.OTHER_ID = d.CMTE_ID")

FILINGS_SQL = (
    "select cycle, FILE_NUM, source_table, count(*) as n_transactions, "
    "cast(sum(TRANSACTION_AMT) as decimal(38,2)) as total_amount, min(TRANSACTION_DT) as first_date, "
    "max(TRANSACTION_DT) as last_date, count(distinct CMTE_ID) as n_committees from ("
    + " union all ".join(f"select cycle, FILE_NUM, CMTE_ID, TRANSACTION_DT, TRANSACTION_AMT, '{f}' as source_table "
                         f"from {T[f]} x{i}" for i, f in enumerate(FACTS))
    + ") u where FILE_NUM is not null group by all")

_MEASURES = [m for ms in M.FINANCE_MEASURES.values() for m in ms]
_GROUP_CASE = "case " + " ".join(
    f"when measure in ({', '.join(repr(m) for m in ms)}) then '{g}'" for g, ms in M.FINANCE_MEASURES.items()) + " end"
FINANCE_SQL = (
    f"select cycle, CAND_ID, {_GROUP_CASE} as measure_group, measure, amount from "
    f"(unpivot (select cycle, CAND_ID, {', '.join(_MEASURES)} from {T['weball']} w) "
    f"on {', '.join(_MEASURES)} into name measure value amount) u where amount is not null")

MONEY_BY_PARTY_SQL = (
    f"select f.cycle, c.CMTE_PTY_AFFILIATION as party, f.flow, count(*) as n_transactions, "
    f"cast(sum(f.TRANSACTION_AMT) as decimal(38,2)) as total_amount, count(distinct f.CMTE_ID) as n_committees "
    f"from (select cycle, CMTE_ID, TRANSACTION_AMT, 'receipts' as flow from {T['indiv']} i "
    f"union all select cycle, CMTE_ID, TRANSACTION_AMT, 'receipts' from {T['pas2']} p "
    f"union all select cycle, CMTE_ID, TRANSACTION_AMT, 'spending' from {T['oppexp']} o) f "
    f"left join (select * from {T['cm']} cc where CMTE_ID is not null) c "
    f"on f.cycle = c.cycle and f.CMTE_ID = c.CMTE_ID group by all")


@register("canonical_columns", _canon_sql())
def canonical_columns(spark, sf_dir):
    return M.canonical_columns(Tables(spark, sf_dir).pas2)


@register("canonical_facts", _canon_union_sql(FACTS))
def canonical_facts(spark, sf_dir):
    """All four fact tables as one table of canonical columns."""
    t = Tables(spark, sf_dir)
    return M.canonical_union({n: t.get(n) for n in FACTS})


@register("canonical_entities", _canon_union_sql(DIMENSIONS))
def canonical_entities(spark, sf_dir):
    """Committees, candidates, linkages and totals as one table of canonical columns."""
    t = Tables(spark, sf_dir)
    return M.canonical_union({n: t.get(n) for n in DIMENSIONS})


@register("dim_candidate", DIM_CANDIDATE_SQL)
def dim_candidate(spark, sf_dir):
    return M.dim_candidate(Tables(spark, sf_dir).cn)


@register("dim_committee", DIM_COMMITTEE_SQL)
def dim_committee(spark, sf_dir):
    return M.dim_committee(Tables(spark, sf_dir).cm)


@register("dim_time", DIM_TIME_SQL)
def dim_time(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.dim_time([t.get(f) for f in FACTS])


@register("dim_election", DIM_ELECTION_SQL)
def dim_election(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.dim_election([t.get(f, filtered=True) for f in FACTS])


@register("dim_election_type", DIM_TYPE_SQL)
def dim_election_type(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.dim_election_type([t.get(f, filtered=True) for f in FACTS])


@register("dim_office", DIM_OFFICE_SQL)
def dim_office(spark, sf_dir):
    return M.dim_office(Tables(spark, sf_dir).cn)


@register("dim_contest", DIM_CONTEST_SQL)
def dim_contest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.dim_contest({f: t.get(f, filtered=True) for f in FACTS}, t.cm, t.cn)


@register("dim_codes", DIM_CODES_SQL)
def dim_codes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.dim_codes({n: t.get(n) for n in {tb for _, tb, _ in M.CODE_DOMAINS}})


@register("bridge_linkage", BRIDGE_SQL)
def bridge_linkage(spark, sf_dir):
    return M.bridge_linkage(Tables(spark, sf_dir).ccl)


@register("fact_contributions", CONTRIB_SQL)
def fact_contributions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.fact_contributions(t.indiv, t.pas2)


@register("fact_disbursements", DISB_SQL)
def fact_disbursements(spark, sf_dir):
    return M.fact_disbursements(Tables(spark, sf_dir).oppexp)


@register("fact_transfers", TRANSFERS_SQL)
def fact_transfers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.fact_transfers(t.oth, t.cm)


@register("fact_filings", FILINGS_SQL)
def fact_filings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.fact_filings({f: t.get(f, filtered=True) for f in FACTS})


@register("fact_candidate_finance", FINANCE_SQL)
def fact_candidate_finance(spark, sf_dir):
    return M.fact_candidate_finance(Tables(spark, sf_dir).weball)


@register("money_by_party", MONEY_BY_PARTY_SQL)
def money_by_party(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.money_by_party(M.fact_contributions(t.indiv, t.pas2), M.fact_disbursements(t.oppexp), t.cm)
