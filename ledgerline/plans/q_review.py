"""Registered queries: review and investigation analytics (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import review as R
from ledgerline.operators.explain import explain_missing_candidates
from ledgerline.plans.catalog import register
from ledgerline.plans.oracle_sql import typed_sql
from ledgerline.plans.tables import Tables
from ledgerline.sources.derived import review_log, review_log_sql

PAS2, CCL, CN, WEBALL = typed_sql("pas2"), typed_sql("ccl"), typed_sql("cn"), typed_sql("weball")

LINKS_SQL = (f"select cycle, CMTE_ID, count(distinct CAND_ID) as n_candidates, min(CAND_ID) as first_cand, "
             f"array_to_string(list_sort(list(distinct CAND_ID)), ',') as candidate_ids from {CCL} c "
             f"where CMTE_ID is not null and CAND_ID is not null group by cycle, CMTE_ID")

CLASS_SQL = ("case when coalesce(n_candidates, 0) = 0 then 'none' when n_candidates = 1 then 'unique' "
             "else 'ambiguous' end")


@register("null_key_profile",
          f"select cycle, count(*) as total_rows, count(*) filter (where CAND_ID is null) as null_rows, "
          f"cast(sum(TRANSACTION_AMT) filter (where CAND_ID is null) as decimal(38,2)) as affected_amount "
          f"from {PAS2} p group by cycle")
def null_key_profile(spark, sf_dir):
    return R.null_key_profile(Tables(spark, sf_dir).pas2)


@register("infer_candidate",
          f"select p.cycle, p.SUB_ID, p.CMTE_ID, p.OTHER_ID, p.TRANSACTION_AMT, "
          f"cast(coalesce(l.n_candidates, 0) as bigint) as n_candidates, "
          f"case when l.n_candidates = 1 then l.first_cand end as inferred_cand_id, {CLASS_SQL} as inference "
          f"from {PAS2} p left join ({LINKS_SQL}) l on p.cycle = l.cycle and p.OTHER_ID = l.CMTE_ID "
          f"where p.CAND_ID is null")
def infer_candidate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.infer_candidate(t.get("pas2", filtered=True), t.ccl)


@register("infer_candidate_summary",
          f"select p.cycle, {CLASS_SQL} as inference, count(*) as rows, "
          f"cast(sum(p.TRANSACTION_AMT) as decimal(38,2)) as amount "
          f"from {PAS2} p left join ({LINKS_SQL}) l on p.cycle = l.cycle and p.OTHER_ID = l.CMTE_ID "
          f"where p.CAND_ID is null group by all")
def infer_candidate_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.infer_candidate_summary(t.get("pas2", filtered=True), t.ccl)


@register("affected_by_committee",
          f"select cycle, OTHER_ID, count(*) as affected_rows, "
          f"cast(sum(TRANSACTION_AMT) as decimal(38,2)) as affected_amount from {PAS2} p "
          f"where CAND_ID is null group by cycle, OTHER_ID")
def affected_by_committee(spark, sf_dir):
    return R.affected_by_committee(Tables(spark, sf_dir).get("pas2", filtered=True))


@register("ambiguous_linkage",
          f"select * from (select cycle, CMTE_ID, CAND_ID, count(*) over (partition by cycle, CMTE_ID) as n_candidates, n_links "
          f"from (select cycle, CMTE_ID, CAND_ID, count(*) as n_links from {CCL} l where CMTE_ID is not null and CAND_ID is not null "
          f"group by cycle, CMTE_ID, CAND_ID) p) q where n_candidates > 1")
def ambiguous_linkage(spark, sf_dir):
    return R.ambiguous_linkage(Tables(spark, sf_dir).ccl)


@register("committee_candidates",
          f"select l.cycle, l.CMTE_ID, l.CAND_ID, c.CAND_NAME, c.CAND_OFFICE, c.CAND_OFFICE_ST, "
          f"c.CAND_OFFICE_DISTRICT, c.CAND_ELECTION_YR, c.CAND_ICI, w.TTL_RECEIPTS from {CCL} l "
          f"join {CN} c on l.cycle = c.cycle and l.CAND_ID = c.CAND_ID "
          f"join {WEBALL} w on l.cycle = w.cycle and l.CAND_ID = w.CAND_ID")
def committee_candidates(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.committee_candidates(t.ccl, t.cn, t.weball)


# ---------------------------------------------------------------- J6 / J7 (issue tables derived from findings)

from ledgerline.operators.checks import run_tests  # noqa: E402
from ledgerline.plans.q_checks import _suite_sql  # noqa: E402

_ALL_TESTS = ("not_null", "unique", "relationships")


def _review_tables(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.derive_issues(run_tests(t.get, _ALL_TESTS, parents=t.parents, cycles=t.cycles), R.ambiguous_linkage(t.ccl), R.affected_by_committee(t.get("pas2", filtered=True)))


ISSUES_CTE = (
    f"suite as ({_suite_sql(_ALL_TESTS)}), links as ({LINKS_SQL}), "
    f"aff as (select cycle, OTHER_ID as CMTE_ID, count(*) as affected_rows, "
    f"cast(sum(TRANSACTION_AMT) as decimal(38,2)) as affected_amount from {PAS2} p where CAND_ID is null group by all), "
    f"tests as (select cycle || '_' || table_name || '_' || test_name || '_' || column_name as issue_key, "
    f"'data_quality_test' as issue_type, severity, cast(cycle as bigint) as cycle, "
    f"cast(failures as bigint) as detected_row_count, cast(null as decimal(38,2)) as detected_amount, test_id, table_name "
    f"from suite where failures > 0), "
    f"dups as (select l.cycle || '_' || l.CMTE_ID || '_duplicate_candidate_ids' as issue_key, "
    f"'duplicate_id' as issue_type, 'low' as severity, cast(l.cycle as bigint) as cycle, "
    f"cast(a.affected_rows as bigint) as detected_row_count, a.affected_amount as detected_amount, l.candidate_ids "
    f"from links l join aff a on l.cycle = a.cycle and l.CMTE_ID = a.CMTE_ID where l.n_candidates > 1), "
    f"issue as (select issue_key, issue_type, severity, cycle, table_name, detected_row_count, detected_amount, cast(2 as bigint) as n_entities "
    f"from tests union all select issue_key, issue_type, severity, cycle, 'ccl', detected_row_count, detected_amount, "
    f"cast(1 + len(string_split(candidate_ids, ',')) as bigint) from dups)")

#: The issues are looked at as of this time; each one was opened so many days after its cycle's first log entry.
STATUS_AT = "2024-01-21 12:00:00"

ROLLUP_SQL = (
    f"with {ISSUES_CTE}, log as (select * from {review_log_sql()} l), "
    f"first as (select cycle, min(logged_at) as first_at from log group by cycle), "
    f"opened as (select i.*, f.first_at + to_days(cast(detected_row_count % 25 as integer)) as opened_at from issue i left join first f using (cycle)), "
    f"past as (select * from log where logged_at <= timestamp '{STATUS_AT}') "
    f"select o.issue_key, o.issue_type, o.severity, o.cycle, o.detected_row_count, o.detected_amount, o.opened_at, o.n_entities, "
    f"count(*) filter (where l.kind = 'evidence' and l.logged_at > o.opened_at) as n_evidence, "
    f"count(*) filter (where l.kind = 'metric' and l.logged_at > o.opened_at) as n_metric, "
    f"count(*) filter (where l.kind = 'decision' and l.logged_at > o.opened_at) as n_decision, "
    f"arg_max(l.decision, (l.logged_at, l.log_id)) filter (where l.kind = 'decision' and l.logged_at <= o.opened_at) as inherited_decision, "
    f"arg_max(l.decision, (l.logged_at, l.log_id)) filter (where l.kind = 'decision' and l.logged_at > o.opened_at) as latest_decision, "
    f"max(l.logged_at) filter (where l.kind = 'decision' and l.logged_at > o.opened_at) as decided_at "
    f"from opened o left join past l on l.cycle = o.cycle and l.table_name = o.table_name group by all")

#: Rows without a candidate and the issues they belong to, row by row.
MEMBERS_CTE = (
    f"links as ({LINKS_SQL}), missing as (select row_number() over () as rid, p.cycle, p.OTHER_ID, p.RPT_TP, p.STATE, p.AMNDT_IND, "
    f"coalesce(l.n_candidates, 0) as n from {PAS2} p left join links l on p.cycle = l.cycle and p.OTHER_ID = l.CMTE_ID where p.CAND_ID is null), "
    f"kinds as (select rid, cycle || '_null_candidate' as k0, case when n <> 1 then cycle || '_unresolved' end as k1, "
    f"case when n > 1 then cycle || '_' || OTHER_ID end as k2, case when n > 1 then cycle || '_' || OTHER_ID || '_' || RPT_TP end as k3, "
    f"cycle || '_state_' || STATE as k4, case when AMNDT_IND = 'A' then cycle || '_amended' end as k5 from missing), "
    f"member as (select distinct rid, unnest([k0, k1, k2, k3, k4, k5]) as issue_key from kinds), "
    f"edges as (select distinct e.f, e.t from (select unnest([{{'f': k3, 't': k2}}, {{'f': k2, 't': k1}}, {{'f': k1, 't': k0}}, {{'f': k4, 't': k0}}, "
    f"{{'f': k4, 't': k2}}, {{'f': k5, 't': k0}}, {{'f': k1, 't': k5}}, {{'f': k5, 't': k1}}]) as e from kinds) where e.f is not null and e.t is not null)")

EXPLAINS_SQL = (
    f"with recursive {MEMBERS_CTE}, "
    f"walk(d, a, depth) as (select f, t, 1 from edges union select w.d, e.t, w.depth + 1 from walk w join edges e on w.a = e.f where w.depth < 8), "
    f"pairs as (select a, d, min(depth) as depth from walk where a <> d group by all), "
    f"held as (select * from member where issue_key is not null), "
    f"size as (select issue_key, count(*) as n from held group by all), "
    f"common as (select p.a, p.d, x.rid from pairs p join held x on x.issue_key = p.d join held y on y.issue_key = p.a and y.rid = x.rid), "
    f"part as (select a, d, count(*) as n from common group by all), whole as (select a, count(distinct rid) as n from common group by all) "
    f"select p.a as ancestor_key, p.d as descendant_key, cast(p.depth as integer) as depth, s.n as ancestor_rows, coalesce(c.n, 0) as explained_rows, "
    f"coalesce(w.n, 0) as union_rows, coalesce(c.n, 0) / s.n as explained_share, coalesce(w.n, 0) / s.n as union_share "
    f"from pairs p join size s on s.issue_key = p.a left join part c on c.a = p.a and c.d = p.d left join whole w on w.a = p.a")


@register("issue_rollup", ROLLUP_SQL)
def issue_rollup(spark, sf_dir):
    """Issues derived from findings, with their review log as of STATUS_AT."""
    t = _review_tables(spark, sf_dir)
    log = review_log(spark, sf_dir)
    first = log.groupBy("cycle").agg(F.min("logged_at").alias("_first"))  # one row per cycle
    days = F.make_dt_interval(days=(F.col("detected_row_count") % 25).cast("int"))
    issue = t["issue"].join(first, "cycle", "left").withColumn("opened_at", F.col("_first") + days).drop("_first")
    out = R.issue_status(issue, t["issue_entity"], log, STATUS_AT)
    return out.select("issue_key", "issue_type", "severity", "cycle", "detected_row_count", "detected_amount", "opened_at", "n_entities", "n_evidence",
                      "n_metric", "n_decision", "inherited_decision", "latest_decision", "decided_at")


@register("issue_explains", EXPLAINS_SQL)
def issue_explains(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return explain_missing_candidates(t.pas2, t.ccl)
