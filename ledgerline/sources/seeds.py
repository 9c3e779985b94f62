"""Review seed tables: CSV with header, read with a fixed schema (A6, §1 review tables).

Fixed values: the column names and order of the six review tables.  Ids are
BIGINT, but entity ids stay text (a 19-digit transaction id must never pass
through a double); timestamps are ``yyyy-MM-dd HH:mm:ss`` without a zone.

``review_tables`` adapts the seeds to the keys used by the roll-up and
closure operators (``issue_key`` / ``from_issue_key`` / ``to_issue_key`` /
``decision_seq``), so hand-maintained seeds and findings-derived issues are
analysed by the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Review table layouts (column:type, in file order).
REVIEW_SCHEMAS = {
    "issue": (
        "issue_id bigint, issue_key string, title string, issue_type string, issue_subtype string, "
        "severity string, status string, confidence string, cycle bigint, source_schema string, "
        "source_table string, source_column string, detection_method string, detection_name string, "
        "detected_row_count bigint, detected_amount decimal(38,2), summary string, current_explanation string, "
        "accepted_reason string, opened_by string, opened_at timestamp_ntz, updated_at timestamp_ntz, "
        "accepted_by string, accepted_at timestamp_ntz, closed_at timestamp_ntz"),
    "issue_relationship": (
        "relationship_id bigint, from_issue_id bigint, to_issue_id bigint, relationship_type string, "
        "relationship_note string, created_at timestamp_ntz"),
    "issue_entity": (
        "issue_entity_id bigint, issue_id bigint, entity_type string, entity_id string, entity_label string, "
        "role string, source_table string, source_column string, notes string"),
    "issue_evidence": (
        "evidence_id bigint, issue_id bigint, evidence_type string, source_label string, source_url string, "
        "evidence_text string, query_text string, observed_value string, observed_at timestamp_ntz, "
        "added_by string"),
    "issue_decision": (
        "decision_id bigint, issue_id bigint, decision string, decision_reason string, decided_by string, "
        "decided_at timestamp_ntz"),
    "issue_metric": (
        "issue_metric_id bigint, issue_id bigint, metric_name string, metric_value double, metric_unit string, "
        "measured_at timestamp_ntz, query_text string"),
}


def read_seed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One seed CSV (header row) with the table's fixed schema; malformed rows fail loudly."""
    return (spark.read.schema(REVIEW_SCHEMAS[table]).option("header", True).option("mode", "FAILFAST")
            .option("timestampNTZFormat", TS_FORMAT).csv(path))


def review_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All six seeds under ``root/<table>.csv``, keyed for ``issue_rollup`` / ``explains_closure``."""
    t = {name: read_seed(spark, f"{root.rstrip('/')}/{name}.csv", name) for name in REVIEW_SCHEMAS}
    # the seed's own text key becomes ``issue_name``; ``issue_key`` is the id every child table carries
    t["issue"] = t["issue"].withColumnRenamed("issue_key", "issue_name")
    key = F.col("issue_id").cast("string").alias("issue_key")
    out = {name: df.select(key, *[c for c in df.columns if c != "issue_id"])
           for name, df in t.items() if name != "issue_relationship"}
    out["issue_decision"] = out["issue_decision"].withColumnRenamed("decision_id", "decision_seq")
    out["issue_relationship"] = t["issue_relationship"].select(
        F.col("from_issue_id").cast("string").alias("from_issue_key"),
        F.col("to_issue_id").cast("string").alias("to_issue_key"), "relationship_type")
    return out
