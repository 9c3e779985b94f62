"""End-to-end runs over stored tables (the three lifecycles of SURVEY §3).

* ``load_cycle``: manifest -> ZIP members (one task each) -> layout scan ->
  cycle-partitioned tables; returns the load-history rows.
* ``audit_run``: audits over stored tables -> run summary + issue log, each
  replacing exactly the slices this run covered (re-runs are idempotent).
* ``timing_report``: run-result documents + stored row counts -> report rows.

The only driver-side loops are over table names and audit types (metadata);
all data work is Spark jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import audits as A
from ledgerline.operators import manifest as I
from ledgerline.operators import timing as L
from ledgerline.operators.checks import DATA_TESTS
from ledgerline.plans.joins import every_cycle, materialize
from ledgerline.sources import sinks
from ledgerline.sources.delimited import parse_lines, rejected
from ledgerline.sources.layouts import FACTS, LAYOUTS
from ledgerline.sources.zipped import write_bronze, zip_lines

RAW_COLUMNS = ("TRANSACTION_AMT", "TRANSACTION_DT")
AMOUNTS = (0.0, 50000.0)  # range of the domain audit
# Stated, not inferred: a load without any line still has a readable schema.
BRONZE_SCHEMA = "zip_path string, source_entry string, line_no bigint, value string, cycle int"


def load_cycle(spark: SparkSession, manifest: DataFrame, archive_root: str, warehouse: str,
               bronze_root: str | None = None, loaded_at: str = "1970-01-01 00:00:00") -> DataFrame:
    """Load every (cycle, table) of ``manifest`` into ``warehouse/<table>``, replacing its cycle.

    The extracted lines are stored under ``bronze_root`` (``<warehouse>/_bronze`` by default), so
    the counts and the parse read them and not the archives.  A cycle without usable lines ends up
    empty, with 0 rows in the returned history.  Fact tables keep their raw amount and date texts
    (``*_raw``) for the domain audit.
    """
    bronze_root = bronze_root or f"{warehouse.rstrip('/')}/_bronze"
    counts = []
    tables = sorted(r.table_name for r in manifest.select("table_name").distinct().collect())  # <= 8 names
    for t in tables:
        m = manifest.where(F.col("table_name") == t)
        bronze = f"{bronze_root.rstrip('/')}/{t}"
        write_bronze(zip_lines(spark, m, archive_root), bronze)
        stored = spark.read.schema(BRONZE_SCHEMA).parquet(bronze)
        per_cycle = line_counts(stored, LAYOUTS[t], m)
        empty = [r.cycle for r in per_cycle.where("row_count = 0").collect()]  # bounded: cycles of the load
        raw = RAW_COLUMNS if t in FACTS else ()
        sinks.replace_cycles(parse_lines(stored, LAYOUTS[t], keep_raw=raw), warehouse, t, empty)
        counts.append(per_cycle.withColumn("table_name", F.lit(t)))
    counted = reduce(lambda a, b: a.unionByName(b), counts)
    present = counted.select("table_name", "cycle", "row_count")
    rejects = counted.select("table_name", "cycle", "rejected_rows")
    return I.load_history(manifest, present, rejects, loaded_at)


def line_counts(lines: DataFrame, layout, manifest: DataFrame) -> DataFrame:
    """``(cycle, row_count, rejected_rows)`` of landing lines in one pass; zeros for cycles of ``manifest`` without lines."""
    bad = rejected(F.col("value"), layout)
    counts = lines.groupBy("cycle").agg(F.count_if(~bad).alias("row_count"), F.count_if(bad).alias("rejected_rows"))
    return every_cycle(counts, manifest)


def audit_metrics(table, run_id: int, run_ts: str, names: list[str], cycles: DataFrame | None = None) -> DataFrame:
    """Metric-contract rows of the null-rate, orphan and domain audits, one fused pass per table.

    Every parent table of a relationship must be readable, and fact tables must carry their raw
    amount and date texts; a missing one raises instead of leaving its audit out.
    """
    _, wide = A.audit_pass(table, names, {"d": AMOUNTS}, duplicates=False)
    parts = [A.pass_metrics(wide, n, ("null_rate", "referential_orphan", "amount_date_domain"), run_id, run_ts, cycles=cycles) for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


def audit_run(spark: SparkSession, warehouse: str, log_root: str, summary_root: str, names: list[str],
              run_id: int = A.DEFAULT_RUN_ID, run_ts: str = A.DEFAULT_RUN_TS,
              cycles: DataFrame | None = None) -> None:
    """Run the audits and replace this run's slices in the summary and issue-log tables.

    ``cycles`` names the expected cycles (default: every cycle that one of the tables holds); a
    table without rows of one gets ``pass`` rows, and its old issues go.  Issue ids continue from
    the largest one left in the log.
    """
    missing = sorted({t.parent_table for t in DATA_TESTS if t.table in names and t.parent_table} - set(names))
    if missing:
        raise ValueError(f"parent tables missing from the run: {', '.join(missing)}")
    cache: dict[str, DataFrame] = {}

    def table(n: str) -> DataFrame:
        if n not in cache:
            cache[n] = sinks.read_table(spark, warehouse, n)
        return cache[n]

    # The metrics feed two sinks: compute them once (findings-sized).
    if cycles is None:
        cycles = materialize(reduce(lambda a, b: a.unionByName(b),
                                    [table(n).select("cycle").distinct() for n in names]).distinct())
    metrics = materialize(audit_metrics(table, run_id, run_ts, names, cycles))
    dups = reduce(lambda a, b: a.unionByName(b), [
        A.duplicate_key_issues(table(n).select("cycle", A.DUPLICATE_KEYS[n]), n, run_id) for n in names])
    dup_summary = materialize(reduce(lambda a, b: a.unionByName(b), [
        A.duplicate_key_summary(table(n).select("cycle", A.DUPLICATE_KEYS[n]), n, run_id, run_ts, cycles)
        for n in names]))
    summary = A.summary(metrics).unionByName(dup_summary)
    issues = A.issue_log(metrics).unionByName(dups.withColumn("detected_at", F.lit(run_ts).cast("timestamp_ntz")))
    covered = summary.select("run_id", "cycle", "table_name", F.col("metric_name").alias("issue_type"),
                             (F.col("status") != "pass").alias("has_rows"))
    last = sinks.last_issue_id(spark, covered, log_root)
    sinks.replace_log_slices(A.assign_issue_ids(issues, existing_max=last), covered, log_root)
    (summary.withColumn("issue_type", F.col("metric_name"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*sinks.LOG_KEYS).parquet(summary_root))


def timing_report(spark: SparkSession, run_results_paths: str | list[str], manifest: DataFrame,
                  warehouse: str, label: str, approach: str, measured_at: str) -> DataFrame:
    """Benchmark-load report rows from run-result files and the stored tables."""
    docs = L.read_run_results(spark, run_results_paths)
    docs = docs.withColumn("cycle", F.regexp_extract("path", r"/(\d{4})/", 1).cast("int")) \
        .withColumn("run_id", F.struct("written_at", "path"))
    durations = L.latest_durations(L.run_result_metrics(docs))
    names = sorted(r.table_name for r in manifest.select("table_name").distinct().collect())
    present = I.present_counts({t: sinks.read_table(spark, warehouse, t) for t in names})
    targets = I.target_row_counts(manifest, present).select("cycle", "table_name", "row_count")
    return L.load_report(L.load_metrics(targets, durations), label, approach, measured_at)
