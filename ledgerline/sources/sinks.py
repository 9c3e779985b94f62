"""Table sinks: cycle-partitioned raw tables, audit logs, reports, listing.

* A4 ``replace_cycle``: full refresh of one cycle = static overwrite of the
  ``cycle=Y`` leaf path.  Dynamic partition overwrite is *not* used: a load
  that produces no rows would leave the stale partition in place, while a
  leaf-path overwrite with an empty frame clears it.
* A7 ``replace_log_slices``: the audit log is partitioned by
  ``(run_id, cycle, table_name, issue_type)``; every slice the audit covered
  is replaced -- slices with new rows through a dynamic overwrite, covered
  slices that are now empty through an overwrite of their leaf path.  The
  covered-slice list is metadata (tables x cycles x audit types), so it is
  the only thing brought to the driver.
* A9 / A10 report sinks (CSV with header, JSON lines), A5/A12 catalog.

Writes go through Spark's commit protocol: a lost executor's task is
re-run, and readers never see a half-written partition.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.audits import ISSUE_COLUMNS

LOG_KEYS = ("run_id", "cycle", "table_name", "issue_type")


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def replace_cycle(df: DataFrame, root: str, table: str, cycle: int) -> None:
    """A4: overwrite exactly ``<root>/<table>/cycle=<cycle>`` (empty frame clears it)."""
    body = df.where(F.col("cycle") == cycle).drop("cycle")
    body.write.mode("overwrite").parquet(f"{table_path(root, table)}/cycle={int(cycle)}")


def write_table(df: DataFrame, root: str, table: str) -> None:
    """A4 for every cycle present in ``df`` (dynamic: only those partitions are replaced)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("cycle").parquet(table_path(root, table)))


def replace_cycles(df: DataFrame, root: str, table: str, empty: list[int]) -> None:
    """A4 for a load of several cycles: those in ``df`` are replaced, those in ``empty`` cleared."""
    write_table(df, root, table)
    blank = df.sparkSession.createDataFrame([], df.schema)
    for cycle in empty:  # bounded: cycles of one load
        replace_cycle(blank, root, table, cycle)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(root, table))


def _leaf(root: str, key: dict) -> str:
    return root.rstrip("/") + "/" + "/".join(f"{k}={key[k]}" for k in LOG_KEYS)


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored audit log, None where no run has written one yet."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_issue_id(spark: SparkSession, covered: DataFrame, root: str) -> int:
    """Largest issue id of the log at ``root`` outside the slices about to be replaced, 0 if none."""
    log = read_log(spark, root)
    if log is None or "issue_id" not in log.columns:
        return 0
    kept = log.join(covered.select(*LOG_KEYS).distinct(), list(LOG_KEYS), "left_anti")
    return kept.agg(F.max("issue_id")).first()[0] or 0


def replace_log_slices(new_rows: DataFrame, covered: DataFrame, root: str) -> None:
    """Replace every covered slice of the partitioned audit log at ``root``.

    ``new_rows`` may carry ``issue_id``.  A boolean ``has_rows`` in ``covered``
    says which slices got rows and spares a second evaluation of ``new_rows``.
    """
    spark = new_rows.sparkSession
    columns = (["issue_id"] if "issue_id" in new_rows.columns else []) + ISSUE_COLUMNS
    rows = new_rows.select(*columns)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LOG_KEYS).parquet(root))
    if "has_rows" in covered.columns:
        empty = covered.groupBy(*LOG_KEYS).agg(F.max("has_rows").alias("_any")).where(~F.col("_any")).drop("_any")
    else:
        with_rows = rows.select(*LOG_KEYS).distinct()
        empty = covered.select(*LOG_KEYS).distinct().join(with_rows, list(LOG_KEYS), "left_anti")
    body_cols = [c for c in columns if c not in LOG_KEYS]
    blank = spark.createDataFrame([], rows.select(*body_cols).schema)
    for key in empty.collect():  # covered-but-empty slices: bounded metadata
        blank.write.mode("overwrite").parquet(_leaf(root, key.asDict()))


def write_report_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Report rows with a fixed header."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """A10: JSON lines report."""
    df.write.mode("overwrite").json(path)


def register_tables(spark: SparkSession, root: str, database: str, tables: list[str]) -> list[str]:
    """A5 + A12: expose written tables in a namespace and list them ordered by name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for t in tables:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} USING parquet LOCATION '{table_path(root, t)}'")
    return sorted(t.name for t in spark.catalog.listTables(database))
