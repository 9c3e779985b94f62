"""Load-timing report as table jobs (L1..L4).

* run-result parse: keep ``model.*`` ids, table = last dotted token,
  ``duration_ms = int(seconds * 1000)`` (truncation) for JSON numbers, NULL for
  anything else (strings, null);
* metric join: expected targets left-joined to durations and row counts,
  status ``success`` when the target has a row count, else ``missing``;
* runs: results of a cycle whose times overlap, or follow each other within a gap, are one run
  (session windows); its wall time is its span, not the sum of its results;
* report rows: one ``summary`` row per cycle (its latest run) plus one ``fact`` / ``dimension``
  row per table, in the fixed 12-column report layout;
* fact subtotal: sum of fact durations (NULL as 0), fact table list, failures.

Documents are parsed with ``parse_json`` (VARIANT) so the JSON type of
``execution_time`` is known -- a numeric string is *not* a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.layouts import FACTS

REPORT_COLUMNS = ["cycle", "label", "approach", "scope", "table_name", "duration_ms", "row_count", "status",
                  "log_path", "db_path", "metadata_db_path", "measured_at_utc"]

_NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def read_run_results(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole run-results JSON files -> ``(path, json_text, written_at)`` (one row per file)."""
    return spark.read.option("wholetext", True).text(paths).select(
        F.input_file_name().alias("path"), F.col("value").alias("json_text"), F.col("_metadata.file_modification_time").alias("written_at"))


def run_result_metrics(docs: DataFrame, keep: tuple[str, ...] = ("cycle", "run_id")) -> DataFrame:
    """L1: ``docs(json_text, keep...)`` -> one row per model result."""
    keep = tuple(k for k in keep if k in docs.columns)
    v = F.try_parse_json("json_text")
    results = docs.select(*keep, F.explode(F.try_variant_get(v, "$.results", "array<variant>")).alias("r"))
    uid = F.try_variant_get("r", "$.unique_id", "string")
    et = F.variant_get("r", "$.execution_time", "variant")
    numeric = F.schema_of_variant(et).rlike(_NUMERIC)
    ms = F.when(numeric, (F.try_variant_get(et, "$", "double") * 1000).cast("bigint"))
    return results.where(uid.startswith("model.")).select(
        *keep, uid.alias("unique_id"), F.element_at(F.split(uid, r"\."), -1).alias("table_name"),
        ms.alias("duration_ms"))


def latest_durations(metrics: DataFrame) -> DataFrame:
    """Per (cycle, table): duration of the latest run (partial aggregation, no sort)."""
    return metrics.groupBy("cycle", "table_name").agg(F.max_by("duration_ms", "run_id").alias("duration_ms"))


def run_events(docs: DataFrame) -> DataFrame:
    """``docs(json_text, cycle, run_id, started_at)`` -> one row per result of any kind: when, how long, whether it failed.

    A result without a numeric time failed and takes no time.
    """
    v = F.try_parse_json("json_text")
    results = docs.select("cycle", "started_at", F.explode(F.try_variant_get(v, "$.results", "array<variant>")).alias("r"))
    et = F.variant_get("r", "$.execution_time", "variant")
    numeric = F.schema_of_variant(et).rlike(_NUMERIC)
    ms = F.when(numeric, (F.try_variant_get(et, "$", "double") * 1000).cast("bigint"))
    return results.select("cycle", "started_at", F.coalesce(ms, F.lit(0)).alias("duration_ms"), F.coalesce(~numeric, F.lit(True)).alias("failed"))


def latest_runs(events: DataFrame, gap_ms: int = 1_800_000) -> DataFrame:
    """The latest run of each cycle: (cycle, started_at, duration_ms, n_results, return_code).

    A run is a session: each result opens a window of its own time plus the gap, and windows that overlap
    are one.  ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` lets tasks merge sessions before
    the shuffle, so that a cycle with most of the results arrives as its sessions.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    window = F.session_window("started_at", F.concat((F.col("duration_ms") + gap_ms).cast("string"), F.lit(" milliseconds")))
    ended = F.unix_micros(F.col("started_at").cast("timestamp")) + F.col("duration_ms") * 1000
    runs = events.where(F.col("started_at").isNotNull()).groupBy("cycle", window.alias("w")).agg(
        F.min("started_at").alias("started_at"), F.max(ended).alias("_end"), F.count(F.lit(1)).alias("n_results"), F.count_if("failed").alias("_failed"))
    span = F.col("_end") - F.unix_micros(F.col("started_at").cast("timestamp"))
    rows = runs.select("cycle", F.struct("started_at", (span / 1000).cast("bigint").alias("duration_ms"), "n_results",
                                         F.when(F.col("_failed") > 0, 1).otherwise(0).alias("return_code")).alias("run"))
    return rows.groupBy("cycle").agg(F.max_by("run", "run.started_at").alias("run")).select("cycle", "run.*")


def load_metrics(targets: DataFrame, durations: DataFrame) -> DataFrame:
    """L2: ``targets(cycle, table_name, row_count)`` x durations -> status per table."""
    j = targets.join(durations, ["cycle", "table_name"], "left")
    return j.select(
        "cycle", "table_name",
        F.when(F.col("table_name").isin(*FACTS), "fact").otherwise("dimension").alias("scope"),
        "duration_ms", "row_count",
        F.when(F.col("row_count").isNotNull(), "success").otherwise("missing").alias("status"))


def load_report(metrics: DataFrame, label: str, approach: str, measured_at: str, runs: DataFrame | None = None,
                log_path: str = "logs/load-timing/run.log", db_path: str = "warehouse") -> DataFrame:
    """L3: summary row per cycle + one row per table (12-column layout).

    With ``runs`` (see ``latest_runs``) the summary is the wall time of the cycle's latest run and
    ``success`` or ``failed(code)``; a cycle without a run has no time and is ``missing``.  Without, only
    durations are known: their sum, ``incomplete`` if a table is missing.
    """
    common = [F.lit(label).alias("label"), F.lit(approach).alias("approach")]
    tail = [F.lit(log_path).alias("log_path"), F.lit(db_path).alias("db_path"),
            F.lit("").alias("metadata_db_path"), F.lit(measured_at).alias("measured_at_utc")]
    per_table = metrics.select(
        F.col("cycle").cast("bigint").alias("cycle"), *common, "scope", "table_name",
        F.col("duration_ms").cast("bigint").alias("duration_ms"),
        F.col("row_count").cast("bigint").alias("row_count"), "status", *tail)
    summary = metrics.groupBy("cycle").agg(
        F.sum(F.coalesce("duration_ms", F.lit(0))).cast("bigint").alias("duration_ms"),
        F.count_if(F.col("status") == "missing").alias("_missing")).select(
        F.col("cycle").cast("bigint").alias("cycle"), *common, F.lit("summary").alias("scope"),
        F.lit("").alias("table_name"), "duration_ms", F.lit(None).cast("bigint").alias("row_count"),
        F.when(F.col("_missing") == 0, "success").otherwise("incomplete").alias("status"), *tail)
    if runs is not None:
        known = runs.select(F.col("cycle").cast("bigint").alias("cycle"), F.col("duration_ms").alias("_ms"), "return_code")
        status = F.when(F.col("return_code") == 0, "success").otherwise(
            F.coalesce(F.concat(F.lit("failed("), F.col("return_code").cast("string"), F.lit(")")), F.lit("missing")))
        summary = (summary.join(known, "cycle", "left").withColumn("duration_ms", F.col("_ms")).withColumn("status", status))
    return summary.select(*REPORT_COLUMNS).unionByName(per_table.select(*REPORT_COLUMNS))


def fact_subtotal(metrics: DataFrame) -> DataFrame:
    """L4: per cycle, fact duration subtotal (NULL as 0), fact tables and missing tables."""
    is_fact = F.col("scope") == "fact"
    return metrics.groupBy("cycle").agg(
        F.sum(F.when(is_fact, F.coalesce("duration_ms", F.lit(0)))).cast("bigint").alias("fact_duration_ms"),
        F.array_join(F.sort_array(F.collect_list(F.when(is_fact, F.col("table_name")))), ",").alias("fact_tables"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == "missing", F.col("table_name")))),
                     ",").alias("missing_tables"))
