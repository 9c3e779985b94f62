"""Registered queries: QA audits (H1..H6) and the audit-log slice replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ledgerline.operators import audits as A
from ledgerline.operators.checks import DATA_TESTS
from ledgerline.plans.catalog import register
from ledgerline.plans.oracle_sql import every_cycle_sql, typed_sql
from ledgerline.plans.tables import Tables
from ledgerline.sources.layouts import ALL_TABLES, FACTS, LAYOUTS

RUN_ID = A.DEFAULT_RUN_ID
RUN_TS = A.DEFAULT_RUN_TS
TS_SQL = f"TIMESTAMP '{RUN_TS}'"
RERUN_OLD_HI = 10000.0
DOMAIN_HI = 50000.0


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------------------- Spark side


def _null_rate(t: Tables) -> DataFrame:
    return _union([A.null_rate(t.get(n), n, cycles=t.cycles) for n in ALL_TABLES])


RAW = ("TRANSACTION_AMT", "TRANSACTION_DT")


def _table(t: Tables, n: str, keep_raw=()) -> DataFrame:
    """Facts always with their raw amount/date text, so every audit of a query shares one plan per table."""
    return t.get(n, keep_raw=RAW if n in FACTS else ())


def _dup_issues(t: Tables) -> DataFrame:
    return _union([A.duplicate_key_issues(_table(t, n).select("cycle", A.DUPLICATE_KEYS[n]), n) for n in ALL_TABLES])


def _dup_summary(t: Tables) -> DataFrame:
    return _union([A.duplicate_key_summary(_table(t, n).select("cycle", A.DUPLICATE_KEYS[n]), n, cycles=t.cycles)
                   for n in ALL_TABLES])


def _orphans(t: Tables) -> DataFrame:
    children = sorted({d.table for d in DATA_TESTS if d.test_name == "relationships"})
    return _union([A.referential_orphans(t.get, c, parents=t.parents, cycles=t.cycles) for c in children])


def _domain(t: Tables, hi: float = DOMAIN_HI) -> DataFrame:
    raw = ("TRANSACTION_AMT", "TRANSACTION_DT")
    return _union([
        A.amount_date_domain(t.get(n, keep_raw=raw).select("cycle", *raw, *[f"{r}_raw" for r in raw]), n, hi=hi,
                             cycles=t.cycles)
        for n in FACTS])


FAMILIES = ("null_rate", "referential_orphan", "amount_date_domain")


def _pass(t: Tables, ranges=None, **options) -> tuple[DataFrame, DataFrame]:
    """Groups and counts of every table from one scan each."""
    return A.audit_pass(lambda n: _table(t, n), ALL_TABLES, ranges or {"d": (0.0, DOMAIN_HI)}, parents=t.parents, **options)


def _metrics(t: Tables, wide: DataFrame, families=FAMILIES, domain: str = "d") -> DataFrame:
    parts = [A.pass_metrics(wide, n, families, RUN_ID, RUN_TS, domain=domain, cycles=t.cycles) for n in ALL_TABLES]
    return _union([p for p in parts if p is not None])


def _issue_log(t: Tables) -> DataFrame:
    groups, wide = _pass(t)
    return A.issue_log(_metrics(t, wide)).unionByName(A.pass_duplicate_issues(groups).withColumn("detected_at", A._ts(RUN_TS)))


def rerun_metrics(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics of null rate, of the domain audit with a tighter range and of the domain audit: one scan per table."""
    _, wide = _pass(t, {"d": (0.0, DOMAIN_HI), "old": (0.0, RERUN_OLD_HI)}, edges=False, duplicates=False)
    domain = ("amount_date_domain",)
    return _metrics(t, wide, ("null_rate",)), _metrics(t, wide, domain, "old"), _metrics(t, wide, domain)


@register("qa_null_rate")
def qa_null_rate(spark, sf_dir):
    return _null_rate(Tables(spark, sf_dir))


@register("qa_duplicate_key")
def qa_duplicate_key(spark, sf_dir):
    return _dup_issues(Tables(spark, sf_dir))


@register("qa_duplicate_summary")
def qa_duplicate_summary(spark, sf_dir):
    return _dup_summary(Tables(spark, sf_dir))


@register("qa_referential_orphan")
def qa_referential_orphan(spark, sf_dir):
    return _orphans(Tables(spark, sf_dir))


@register("qa_amount_date_domain")
def qa_amount_date_domain(spark, sf_dir):
    return _domain(Tables(spark, sf_dir))


@register("qa_run_summary")
def qa_run_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    _, wide = _pass(t)
    return A.summary(_metrics(t, wide)).unionByName(_union([A.pass_duplicate_summary(wide, n, cycles=t.cycles) for n in ALL_TABLES]))


@register("qa_issue_log")
def qa_issue_log(spark, sf_dir):
    return _issue_log(Tables(spark, sf_dir))


@register("qa_issue_ids")
def qa_issue_ids(spark, sf_dir):
    return A.assign_issue_ids(_issue_log(Tables(spark, sf_dir)), mode="batch")


@register("qa_issue_ids_unique")
def qa_issue_ids_unique(spark, sf_dir):
    return A.assign_issue_ids(_issue_log(Tables(spark, sf_dir)), mode="unique")


@register("qa_rerun_replace")
def qa_rerun_replace(spark, sf_dir):
    """Old log (null-rate + domain with a tighter range) re-run for the domain audit."""
    t = Tables(spark, sf_dir)
    old_null, old_domain, new_metrics = rerun_metrics(t)
    old = A.issue_log(old_null).unionByName(A.issue_log(old_domain))
    covered = new_metrics.select("run_id", "cycle", "table_name", new_metrics["metric_name"].alias("issue_type"))
    return A.replace_slices(old, A.issue_log(new_metrics), covered)


# ---------------------------------------------------------------- oracle side


def _metric_sql(table: str, metric: str, details: str, inner: str, rows_col: str = "rows") -> str:
    """``inner`` yields (cycle, issue_key, issue_count, rows)."""
    return (
        f"select {RUN_ID}::bigint as run_id, cycle::bigint as cycle, '{table}' as table_name, "
        f"'{metric}' as metric_name, (case when {rows_col} > 0 then issue_count / {rows_col} else 0 end)::double "
        f"as metric_value, case when issue_count > 0 then 'warn' else 'pass' end as status, {TS_SQL} as computed_at, "
        f"issue_key, issue_count::bigint as issue_count, '{details}=' || issue_count as issue_details from ({inner}) m"
    )


def _null_rate_sql(table: str) -> str:
    cols = LAYOUTS[table].names
    counts = ", ".join(f'count(*) filter (where {c} is null) as "{c}"' for c in cols)
    wide = every_cycle_sql(f"select cycle, count(*) as rows, {counts} from {typed_sql(table)} s group by cycle")
    inner = (f"unpivot ({wide}) "
             f"on {', '.join(cols)} into name issue_key value issue_count")
    return _metric_sql(table, "null_rate", "null_rows", f"select * from ({inner})")


def _dup_groups_sql(table: str) -> str:
    return (f"select cycle, cast({A.DUPLICATE_KEYS[table]} as varchar) as issue_key, count(*) as issue_count "
            f"from {typed_sql(table)} s group by all")


def _dup_issue_sql(table: str) -> str:
    return (f"select {RUN_ID}::bigint as run_id, cycle::bigint as cycle, '{table}' as table_name, "
            f"'duplicate_key' as issue_type, 'warn' as severity, issue_key, issue_count::bigint as issue_count, "
            f"'duplicate_rows=' || cast(issue_count as varchar) as issue_details "
            f"from ({_dup_groups_sql(table)}) g where issue_count > 1")


def _dup_summary_sql(table: str) -> str:
    per_cycle = (f"select cycle, sum(issue_count) filter (where issue_count > 1) as n "
                 f"from ({_dup_groups_sql(table)}) g group by cycle")
    return (f"select {RUN_ID}::bigint as run_id, cycle::bigint as cycle, '{table}' as table_name, "
            f"'duplicate_key' as metric_name, cast(n as double) as metric_value, "
            f"case when n > 0 then 'warn' else 'pass' end as status, {TS_SQL} as computed_at, "
            f"null::varchar as issue_key from ({every_cycle_sql(per_cycle)}) e")


def _orphan_sql(child: str) -> str:
    parts = []
    for t in DATA_TESTS:
        if t.test_name != "relationships" or t.table != child:
            continue
        key = f"{child}.{t.column}->{t.parent_table}.{t.parent_column}"
        inner = (f"select c.cycle, count(*) filter (where c.{t.column} is not null and p.k is null) as issue_count, "
                 f"count(*) filter (where c.{t.column} is not null) as nn "
                 f"from {typed_sql(child)} c left join (select distinct cycle, {t.parent_column} as k "
                 f"from {typed_sql(t.parent_table)} pp where {t.parent_column} is not null) p "
                 f"on c.cycle = p.cycle and c.{t.column} = p.k group by c.cycle")
        inner = f"select *, '{key}' as issue_key from ({every_cycle_sql(inner)}) e"
        parts.append(_metric_sql(child, "referential_orphan", "orphan_rows", inner, rows_col="nn"))
    return " union all ".join(parts)


def _domain_sql(table: str, hi: float = DOMAIN_HI) -> str:
    src = typed_sql(table, ("TRANSACTION_AMT", "TRANSACTION_DT"))
    wide = (
        "select cycle, count(*) as rows, "
        "count(*) filter (where coalesce(trim(TRANSACTION_AMT_raw), '') <> '' and TRANSACTION_AMT is null) "
        "as amount_unparseable, "
        f"count(*) filter (where TRANSACTION_AMT < 0 or TRANSACTION_AMT > {hi}) as amount_out_of_range, "
        "count(*) filter (where coalesce(trim(TRANSACTION_DT_raw), '') <> '' and TRANSACTION_DT is null) "
        "as date_unparseable, "
        "count(*) filter (where TRANSACTION_DT is not null and year(TRANSACTION_DT) not in (cycle - 1, cycle)) "
        f"as date_out_of_cycle from {src} s group by cycle")
    inner = (
        f"unpivot ({every_cycle_sql(wide)}) "
        "on amount_unparseable, amount_out_of_range, date_unparseable, date_out_of_cycle "
        "into name issue_key value issue_count")
    return _metric_sql(table, "amount_date_domain", "rows", f"select * from ({inner})")


def _u(parts: list[str]) -> str:
    return " union all ".join(f"({p})" for p in parts)


NULL_RATE_SQL = _u([_null_rate_sql(n) for n in ALL_TABLES])
DUP_ISSUE_SQL = _u([_dup_issue_sql(n) for n in ALL_TABLES])
DUP_SUMMARY_SQL = _u([_dup_summary_sql(n) for n in ALL_TABLES])
ORPHAN_SQL = _u([_orphan_sql(c) for c in sorted({d.table for d in DATA_TESTS if d.test_name == "relationships"})])
DOMAIN_SQL = _u([_domain_sql(n) for n in FACTS])


def _summary_sql(metrics: str) -> str:
    return (f"select run_id, cycle, table_name, metric_name, metric_value, status, computed_at, issue_key "
            f"from ({metrics}) x")


def _issue_sql(metrics: str) -> str:
    return (f"select run_id, cycle, table_name, metric_name as issue_type, 'warn' as severity, issue_key, "
            f"issue_count, issue_details, computed_at as detected_at from ({metrics}) x where issue_count > 0")


ISSUE_LOG_SQL = _u([
    _issue_sql(NULL_RATE_SQL),
    f"select *, {TS_SQL} as detected_at from ({DUP_ISSUE_SQL}) d",
    _issue_sql(ORPHAN_SQL),
    _issue_sql(DOMAIN_SQL),
])

_ORDER = ", ".join(f"'{a}'" for a in A.AUDIT_ORDER)
ISSUE_IDS_SQL = (
    f"with log as ({ISSUE_LOG_SQL}), "
    f"b as (select issue_type, dense_rank() over (order by list_position([{_ORDER}], issue_type)) as rk "
    f"from (select distinct issue_type from log) d) "
    f"select cast(b.rk as bigint) as issue_id, log.* from log join b using (issue_type)"
)

ISSUE_IDS_UNIQUE_SQL = (
    f"select cast(row_number() over (order by list_position([{_ORDER}], issue_type), table_name, cycle, "
    f"issue_key nulls first) as bigint) as issue_id, log.* from ({ISSUE_LOG_SQL}) log"
)

RERUN_OLD_SQL = _u([_issue_sql(NULL_RATE_SQL), _issue_sql(_u([_domain_sql(n, RERUN_OLD_HI) for n in FACTS]))])

RERUN_SQL = (
    f"with old as ({RERUN_OLD_SQL}), "
    f"newm as ({DOMAIN_SQL}), "
    f"covered as (select distinct run_id, cycle, table_name, metric_name as issue_type from newm) "
    f"select * from old where not exists (select 1 from covered c where c.run_id = old.run_id and "
    f"c.cycle = old.cycle and c.table_name = old.table_name and c.issue_type = old.issue_type) "
    f"union all {_issue_sql('select * from newm')}"
)

for _n, _sql in {
    "qa_null_rate": NULL_RATE_SQL,
    "qa_duplicate_key": DUP_ISSUE_SQL,
    "qa_duplicate_summary": DUP_SUMMARY_SQL,
    "qa_referential_orphan": ORPHAN_SQL,
    "qa_amount_date_domain": DOMAIN_SQL,
    "qa_run_summary": _u([_summary_sql(NULL_RATE_SQL), DUP_SUMMARY_SQL, _summary_sql(ORPHAN_SQL),
                          _summary_sql(DOMAIN_SQL)]),
    "qa_issue_log": ISSUE_LOG_SQL,
    "qa_issue_ids": ISSUE_IDS_SQL,
    "qa_issue_ids_unique": ISSUE_IDS_UNIQUE_SQL,
    "qa_rerun_replace": RERUN_SQL,
}.items():
    from ledgerline.plans.catalog import ORACLE

    ORACLE[_n] = _sql
