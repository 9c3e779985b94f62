"""Registered queries: round trips through storage -- archives (A2, I4) and refreshed tables and logs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators import audits as A
from ledgerline.operators import manifest as I
from ledgerline.plans import q_audits as Q
from ledgerline.plans.catalog import register
from ledgerline.plans.joins import materialize, shared_folder
from ledgerline.plans.oracle_sql import lines_sql, typed_sql
from ledgerline.plans.tables import Tables
from ledgerline.sources import sinks
from ledgerline.sources.archives import remove_archives, write_archives
from ledgerline.sources.layouts import ALL_TABLES, LAYOUTS
from ledgerline.sources.render import BAD_BYTES, BLANK, OVER_LONG, archived_lines, rendered_cycles
from ledgerline.sources.zipped import load_zip, member_stats, zip_members

LOADED_AT = "2026-01-01 00:00:00"
# The second generation leaves one cycle out, empties one and reloads the others with changed rows.
KEPT, EMPTIED = 1994, 1996
CHANGED = "FILE_NUM % 3 <> 0"


def _folder(spark, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


# --- A2, I4: archives --------------------------------------------------------------------------


@register("load_zip_pas2", f"select * from {typed_sql('pas2')} t")
def load_zip_pas2(spark, sf_dir):
    """pas2 written as archives by the executors and read back, planted bad lines and line ends included."""
    root = _folder(spark, "archives")
    archives = write_archives(archived_lines(spark, sf_dir, ["pas2"]), root)
    return load_zip(spark, archives, LAYOUTS["pas2"], root, bronze_path=f"{root}/bronze").drop("source_entry")


def _archive_sql() -> str:
    parts = []
    for t in ALL_TABLES:
        n = len(LAYOUTS[t].columns)
        ok = f"value <> '' and (len(f) <= {n} or (len(f) = {n + 1} and f[{n + 1}] = ''))"
        planted = " + ".join(f"count(*) filter (where {p})" for p in (BAD_BYTES, OVER_LONG, BLANK))
        parts.append(
            f"select '{t}' as table_name, cast(cycle as bigint) as cycle, count(*) filter (where {ok}) as row_count, "
            f"count(*) filter (where not ({ok})) + {planted} as rejected_rows, true as hash_agrees, true as timed "
            f"from (select cycle, value, string_split(value, '|') as f from {lines_sql(t)} l) s group by cycle")
    return " union all ".join(parts)


@register("archive_load_history", _archive_sql())
def archive_load_history(spark, sf_dir):
    """Load history of all tables' archives, by table and cycle: the digest read is the digest written."""
    lines, stats, written = archived_lines(spark, sf_dir, list(ALL_TABLES)), [], []
    for cycle in rendered_cycles(spark, sf_dir):
        # A cycle's archives are written, read and counted before those of the next, so the disk holds one cycle at a time.
        root = _folder(spark, "archives")
        archives = write_archives(lines.where(F.col("cycle").eqNullSafe(F.lit(cycle).cast("int"))), root)
        stats.append(materialize(member_stats(zip_members(spark, archives, root))))
        remove_archives(archives, root)
        written.append(archives.select(F.col("zip_path").alias("source_zip_path"), "written_hash"))
    stats, written = (reduce(lambda a, b: a.unionByName(b), parts) for parts in (stats, written))
    history = I.archive_history(stats, LOADED_AT)
    return history.join(written, "source_zip_path").groupBy("table_name", "cycle").agg(
        F.sum("row_count").alias("row_count"), F.sum("rejected_rows").alias("rejected_rows"),
        F.bool_and(F.col("source_file_hash").eqNullSafe(F.col("written_hash"))).alias("hash_agrees"),
        F.bool_and(F.coalesce(F.col("duration_ms") >= 0, F.lit(False))).alias("timed"))


# --- A4, A7, E7: two generations of a table and of a log ------------------------------------------


@register("refresh_cycles", (
    f"select * from {typed_sql('pas2')} t where cycle = {KEPT} "
    f"or (cycle <> {EMPTIED} and coalesce({CHANGED}, false))"))
def refresh_cycles(spark, sf_dir):
    """pas2 stored by cycle, then refreshed by a load that leaves one cycle out and empties another."""
    root = _folder(spark, "tables")
    rows = Tables(spark, sf_dir).get("pas2")
    sinks.write_table(rows, root, "pas2")
    second = rows.where((F.col("cycle") != KEPT) & (F.col("cycle") != EMPTIED) & F.coalesce(F.expr(CHANGED), F.lit(False)))
    sinks.replace_cycles(second, root, "pas2", [EMPTIED])
    return sinks.read_table(spark, root, "pas2").select(*rows.columns)


@register("refresh_issue_log", (
    f"with old as ({Q.RERUN_OLD_SQL}), newm as ({Q.DOMAIN_SQL}), "
    f"o as (select *, dense_rank() over (order by list_position([{Q._ORDER}], issue_type)) as issue_id from old), "
    f"kept as (select * from o where issue_type <> 'amount_date_domain'), "
    f"top as (select coalesce(max(issue_id), 0) + 1 as issue_id from kept) "
    f"select * from kept union all select n.*, top.issue_id from ({Q._issue_sql('select * from newm')}) n, top"))
def refresh_issue_log(spark, sf_dir):
    """The audit log stored in slices, then the domain audit re-run: its slices replaced, ids going on from the rest."""
    root = _folder(spark, "issue-log")
    t = Tables(spark, sf_dir)
    old_null, old_domain, again = Q.rerun_metrics(t)
    first = A.assign_issue_ids(A.issue_log(old_null).unionByName(A.issue_log(old_domain)))
    sinks.replace_log_slices(first, _covered(old_null.unionByName(old_domain)), root)
    covered = _covered(again)
    last = sinks.last_issue_id(spark, covered, root)
    sinks.replace_log_slices(A.assign_issue_ids(A.issue_log(again), existing_max=last), covered, root)
    return sinks.read_log(spark, root).select("issue_id", *[
        F.col(c).cast("bigint") if c in ("run_id", "cycle") else F.col(c) for c in A.ISSUE_COLUMNS])


def _covered(metrics):
    """The slices that an audit covers, and whether they got rows."""
    return metrics.select("run_id", "cycle", "table_name", F.col("metric_name").alias("issue_type"),
                          (F.col("issue_count") > 0).alias("has_rows"))
