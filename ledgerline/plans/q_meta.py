"""Registered queries: coverage + load metadata (I, A11) and the load-timing report (L)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators import manifest as I
from ledgerline.operators import state as S
from ledgerline.operators import timing as L
from ledgerline.plans.catalog import register
from ledgerline.plans.joins import shared_folder
from ledgerline.plans.oracle_sql import typed_sql
from ledgerline.plans.tables import Tables, lines, expected_cycles
from ledgerline.sources import derived as D
from ledgerline.sources.delimited import rejected_lines
from ledgerline.sources.layouts import ALL_TABLES, DIMENSIONS, FACTS, LAYOUTS

# Coverage configuration used by the registered queries (parameters).
COVERAGE = I.Coverage(coverage=(1994, 2000), facts=(1998, 2000))
RUN_TS = "2026-01-01 00:00:00"
LABEL, APPROACH = "bench", "spark"


# ---------------------------------------------------------------- Spark side


def _manifest(spark, sf_dir):
    return I.coverage_manifest(expected_cycles(spark, sf_dir), COVERAGE)


def _present(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return I.present_counts({n: t.get(n).select("cycle") for n in ALL_TABLES})


def _targets(spark, sf_dir):
    return I.target_row_counts(_manifest(spark, sf_dir), _present(spark, sf_dir))


def _metrics(spark, sf_dir):
    durations = L.latest_durations(L.run_result_metrics(D.run_results_docs(spark, sf_dir)))
    return L.load_metrics(_targets(spark, sf_dir).select("cycle", "table_name", "row_count"), durations)


@register("coverage_manifest")
def coverage_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


@register("target_row_counts")
def target_row_counts(spark, sf_dir):
    return _targets(spark, sf_dir)


@register("coverage_gap")
def coverage_gap(spark, sf_dir):
    return I.coverage_gap(_manifest(spark, sf_dir), _present(spark, sf_dir))


@register("load_history")
def load_history(spark, sf_dir):
    rej = reduce(lambda a, b: a.unionByName(b), [
        rejected_lines(lines(spark, sf_dir, n), LAYOUTS[n]).groupBy("cycle")
        .agg(F.count(F.lit(1)).alias("rejected_rows")).withColumn("table_name", F.lit(n)) for n in ALL_TABLES])
    return I.load_history(_manifest(spark, sf_dir), _present(spark, sf_dir), rej, RUN_TS)


@register("fetch_change_status")
def fetch_change_status(spark, sf_dir):
    return I.fetch_change_status(D.fetch_log(spark, sf_dir))


@register("current_state")
def current_state(spark, sf_dir):
    """State of every source file after a first batch of operations and a second one of late arrivals."""
    root = f"{shared_folder(spark)}/state-{uuid.uuid4().hex}"
    every = D.operations(spark, sf_dir)
    late = (F.col("op_id") % 7 == 0) & (F.col("cycle") > 1994)
    S.apply_batch(spark, root, every.where(~late))
    S.apply_batch(spark, root, every.where(late))
    return S.state_rows(S.read_state(spark, root), _manifest(spark, sf_dir))


@register("run_result_metrics")
def run_result_metrics(spark, sf_dir):
    return L.run_result_metrics(D.run_results_docs(spark, sf_dir).drop("started_at"))


@register("load_metrics")
def load_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@register("load_report")
def load_report(spark, sf_dir):
    runs = L.latest_runs(L.run_events(D.run_results_docs(spark, sf_dir)))
    return L.load_report(_metrics(spark, sf_dir), LABEL, APPROACH, RUN_TS, runs)


@register("load_fact_subtotal")
def load_fact_subtotal(spark, sf_dir):
    return L.fact_subtotal(_metrics(spark, sf_dir))


# ---------------------------------------------------------------- oracle side

_TABS = ", ".join(
    [f"('{t}', 'dimension', {i})" for i, t in enumerate(DIMENSIONS)]
    + [f"('{t}', 'fact', {len(DIMENSIONS) + i})" for i, t in enumerate(FACTS)])
_ENTRY = "case table_name " + " ".join(
    f"when '{t.name}' then " + (f"'{t.member.split('{yy}')[0]}' || yy || '{t.member.split('{yy}')[1]}'"
                                if "{yy}" in t.member else f"'{t.member}'")
    for t in LAYOUTS.values()) + " end"
(C0, C1), (F0, F1) = COVERAGE.coverage, COVERAGE.facts
MANIFEST_SQL = (
    f"with yrs as (select min(year(l_shipdate)) - 2 as lo, max(year(l_shipdate)) as hi from lineitem), "
    f"cyc as (select cast(unnest(range(lo + lo % 2, hi + 1, 2)) as integer) as cycle from yrs), "
    f"tabs as (select * from (values {_TABS}) t(table_name, table_group, position)), "
    f"m as (select cycle, table_name, min(table_group) as table_group, min(position) as position, "
    f"right(cast(cycle as varchar), 2) as yy from cyc, tabs "
    f"where cycle % 2 = 0 and cycle between {C0} and {C1} "
    f"and (table_group = 'dimension' or cycle between {F0} and {F1}) group by cycle, table_name) "
    f"select cycle, table_name, table_group, cast(position as integer) as position, "
    f"'{I.BASE_URL}/' || cycle || '/' || table_name || yy || '.zip' as url, "
    f"'data/' || cycle || '/' || table_name || yy || '.zip' as zip_path, {_ENTRY} as source_entry, "
    f"table_name || '_' || cycle as target_table from m")

PRESENT_SQL = " union all ".join(
    f"select '{n}' as table_name, cycle, count(*) as row_count from {typed_sql(n)} x{i} group by cycle"
    for i, n in enumerate(ALL_TABLES))

TARGETS_SQL = (
    f"select m.cycle, m.table_name, m.target_table, p.row_count, "
    f"case when p.row_count is not null then 'success' else 'missing' end as status "
    f"from ({MANIFEST_SQL}) m left join ({PRESENT_SQL}) p on m.cycle = p.cycle and m.table_name = p.table_name")

GAP_SQL = (f"select m.cycle, m.table_name, m.target_table, 'missing' as status from ({MANIFEST_SQL}) m "
           f"where not exists (select 1 from ({PRESENT_SQL}) p where p.cycle = m.cycle and p.table_name = m.table_name)")

LOAD_HISTORY_SQL = (
    f"select row_number() over (order by m.cycle, m.position) as load_id, cast(m.cycle as bigint) as cycle, "
    f"m.table_name, m.zip_path as source_zip_path, m.source_entry as source_entry_name, "
    f"m.target_table as target_table_name, p.row_count, cast(0 as bigint) as rejected_rows, "
    f"TIMESTAMP '{RUN_TS}' as loaded_at from ({MANIFEST_SQL}) m join ({PRESENT_SQL}) p "
    f"on m.cycle = p.cycle and m.table_name = p.table_name")

FETCH_SQL = (
    f"with f as (select *, nullif(regexp_replace(trim(etag), '^W/', ''), '') as tag, "
    f"try_strptime(last_modified, '%a, %d %b %Y %H:%M:%S GMT') as modified from {D.fetch_log_sql()} x), "
    f"r as (select *, row_number() over (partition by cycle, table_name "
    f"order by fetched_at desc, fetch_id desc) as rn, count(*) over (partition by cycle, table_name) as n "
    f"from f) select a.cycle, a.table_name, a.fetched_at as last_fetched_at, a.n as n_fetches, a.etag, "
    f"b.etag as previous_etag, a.modified as modified_at, b.modified as previous_modified_at, "
    f"case when a.fetch_status = 'error' then 'error' when a.n = 1 then 'new' "
    f"when a.fetch_status = 'not_modified' then 'unchanged' "
    f"when a.tag is not null and b.tag is not null then case when a.tag = b.tag then 'unchanged' else 'changed' end "
    f"when a.modified <= b.modified then 'unchanged' else 'changed' end as change_status from r a "
    f"left join r b on a.cycle = b.cycle and a.table_name = b.table_name and b.rn = 2 where a.rn = 1")

CURRENT_SQL = (
    f"with o as (select * from {D.operations_sql()} x), s as (select cycle, table_name, "
    + ", ".join(f"arg_max({c}, (op_time, op_id)) filter (where {c} is not null) as {c}" for c in S.FOLDED)
    + f", max(op_time) as updated_at from o group by cycle, table_name) "
    f"select row_number() over (order by s.cycle, s.table_name) as state_id, 'source_file' as entity_type, cast(s.cycle as bigint) as cycle, s.table_name, "
    f"s.table_name || '_' || s.cycle as entity_name, s.last_operation, s.operation_status, s.quality_status, m.url as source_url, "
    f"m.zip_path as source_zip_path, m.source_entry as source_entry_name, m.target_table as target_table_name, s.http_status, s.content_length, "
    f"s.row_count, s.duration_ms, s.response_date, s.last_modified, s.etag, nullif(s.error_text, '') as error_text, s.updated_at "
    f"from s left join ({MANIFEST_SQL}) m on m.cycle = s.cycle and m.table_name = s.table_name")

RUN_METRICS_SQL = (
    f"with d as {D.run_results_sql()}, e as (select cycle, run_id, unnest(from_json(json_text::json -> '$.results', "
    f"'[\"JSON\"]')) as r from d) "
    f"select cycle, run_id, r ->> '$.unique_id' as unique_id, "
    f"string_split(r ->> '$.unique_id', '.')[-1] as table_name, "
    f"case when json_type(r, '$.execution_time') in ('DOUBLE', 'UBIGINT', 'BIGINT') "
    f"then cast(trunc(cast(r ->> '$.execution_time' as double) * 1000) as bigint) end as duration_ms "
    f"from e where starts_with(r ->> '$.unique_id', 'model.')")

_FACT_LIST = ", ".join(f"'{f}'" for f in FACTS)
METRICS_SQL = (
    f"with t as ({TARGETS_SQL}), rm as ({RUN_METRICS_SQL}), "
    f"dur as (select cycle, table_name, arg_max_null(duration_ms, run_id) as duration_ms from rm group by all) "
    f"select t.cycle, t.table_name, case when t.table_name in ({_FACT_LIST}) then 'fact' else 'dimension' end "
    f"as scope, dur.duration_ms, t.row_count, case when t.row_count is not null then 'success' else 'missing' end "
    f"as status from t left join dur on t.cycle = dur.cycle and t.table_name = dur.table_name")

_TAIL = f"'logs/load-timing/run.log' as log_path, 'warehouse' as db_path, '' as metadata_db_path, " \
        f"'{RUN_TS}' as measured_at_utc"
REPORT_SQL = (
    f"with m as ({METRICS_SQL}), d as {D.run_results_sql()}, "
    f"x as (select cycle, started_at, unnest(from_json(json_text::json -> '$.results', '[\"JSON\"]')) as r from d), "
    f"e as (select cycle, started_at, json_type(r, '$.execution_time') in ('DOUBLE', 'UBIGINT', 'BIGINT') as ok, "
    f"case when ok then cast(trunc(cast(r ->> '$.execution_time' as double) * 1000) as bigint) else 0 end as ms from x), "
    f"g as (select *, max(started_at + to_milliseconds(ms + 1800000)) over (partition by cycle order by started_at "
    f"rows between unbounded preceding and 1 preceding) as open_until from e), "
    f"i as (select *, count(*) filter (where open_until is null or started_at > open_until) over (partition by cycle order by started_at) as run from g), "
    f"runs as (select cycle, run, cast(floor(epoch_us(max(started_at + to_milliseconds(ms)) - min(started_at)) / 1000) as bigint) as duration_ms, "
    f"count(*) filter (where not coalesce(ok, false)) as failed from i group by cycle, run), "
    f"last as (select * from runs qualify row_number() over (partition by cycle order by run desc) = 1) "
    f"select cast(c.cycle as bigint) as cycle, '{LABEL}' as label, '{APPROACH}' as approach, 'summary' as scope, "
    f"'' as table_name, l.duration_ms, null::bigint as row_count, "
    f"case when l.cycle is null then 'missing' when l.failed > 0 then 'failed(1)' else 'success' end as status, "
    f"{_TAIL} from (select distinct cycle from m) c left join last l on l.cycle = c.cycle "
    f"union all select cast(cycle as bigint), '{LABEL}', '{APPROACH}', scope, table_name, "
    f"cast(duration_ms as bigint), cast(row_count as bigint), status, {_TAIL} from m")

SUBTOTAL_SQL = (
    f"with m as ({METRICS_SQL}) select cycle, "
    f"cast(sum(coalesce(duration_ms, 0)) filter (where scope = 'fact') as bigint) as fact_duration_ms, "
    f"coalesce(string_agg(table_name, ',' order by table_name) filter (where scope = 'fact'), '') as fact_tables, "
    f"coalesce(string_agg(table_name, ',' order by table_name) filter (where status = 'missing'), '') "
    f"as missing_tables from m group by cycle")

from ledgerline.plans.catalog import ORACLE  # noqa: E402

ORACLE.update({
    "coverage_manifest": MANIFEST_SQL,
    "target_row_counts": TARGETS_SQL,
    "coverage_gap": GAP_SQL,
    "load_history": LOAD_HISTORY_SQL,
    "fetch_change_status": FETCH_SQL,
    "current_state": CURRENT_SQL,
    "run_result_metrics": RUN_METRICS_SQL,
    "load_metrics": METRICS_SQL,
    "load_report": REPORT_SQL,
    "load_fact_subtotal": SUBTOTAL_SQL,
})
