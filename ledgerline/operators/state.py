"""Current state of every source file as a fold over several logs.

Fetches, loads and audits are operations on one entity, a table of a cycle.  Each state column
takes the value of the latest operation that says anything about it: an answer without a body
leaves the tag of the last download, an audit leaves the row count.  The stored state keeps the
time and id beside every value, so folding is a maximum per column: batches may come late, twice
or in any order, and give the same state.  A batch rewrites the cycles it touches and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.plans.joins import materialize

#: Columns an operation may set; ``error_text`` and the three that name the operation are set by every one.
FOLDED = {
    "last_operation": "string", "operation_status": "string", "quality_status": "string", "http_status": "bigint", "content_length": "bigint",
    "row_count": "bigint", "duration_ms": "bigint", "response_date": "string", "last_modified": "string", "etag": "string", "error_text": "string",
}
#: The columns of the state table, in order.
STATE_COLUMNS = (
    "state_id entity_type cycle table_name entity_name last_operation operation_status quality_status source_url source_zip_path "
    "source_entry_name target_table_name http_status content_length row_count duration_ms response_date last_modified etag error_text updated_at").split()
STORED = "table_name string, " + ", ".join(f"{c} struct<at:timestamp_ntz,id:bigint,value:{t}>" for c, t in FOLDED.items()) + ", cycle int"


def fold(operations: DataFrame) -> DataFrame:
    """(cycle, table_name, and per column its latest value with time and id) of ``operations``.

    ``operations`` has cycle, table_name, op_time, op_id and the columns of FOLDED, null where an operation
    is silent.  A null time is older than all others; ties go to the larger id.
    """
    stamp = [F.col("op_time").cast("timestamp_ntz").alias("at"), F.col("op_id").cast("bigint").alias("id")]
    return operations.groupBy(F.col("cycle").cast("int").alias("cycle"), "table_name").agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(*stamp, F.col(c).cast(t).alias("value")))).alias(c) for c, t in FOLDED.items()])


def merge(states: DataFrame) -> DataFrame:
    """One state per entity from several of the same or of different times."""
    return states.groupBy("cycle", "table_name").agg(*[F.max(c).alias(c) for c in FOLDED])


def apply_batch(spark: SparkSession, root: str, operations: DataFrame) -> None:
    """Fold a batch into the state stored below ``root`` (by cycle); cycles without a new operation are not rewritten."""
    new = materialize(fold(operations))  # one row per entity
    stored = read_state(spark, root)
    if stored is not None:
        touched = new.select("cycle").distinct()
        new = materialize(merge(stored.join(touched, "cycle", "left_semi").unionByName(new)))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cycle").parquet(root)


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored state, or None before the first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(STORED).parquet(root)


def state_rows(state: DataFrame, places: DataFrame) -> DataFrame:
    """The 21 columns of the state table.

    ``places`` has (cycle, table_name, url, zip_path, source_entry, target_table) per expected target; entities
    outside of it have no place.  Ids run by cycle and table; entities are few (tables x cycles).
    """
    value = {c: F.col(f"{c}.value") for c in FOLDED}
    place = places.select("cycle", "table_name", F.col("url").alias("source_url"), F.col("zip_path").alias("source_zip_path"),
                          F.col("source_entry").alias("source_entry_name"), F.col("target_table").alias("target_table_name"))
    flat = state.select("cycle", "table_name", F.col("last_operation.at").alias("updated_at"), *[v.alias(c) for c, v in value.items()])
    flat = flat.withColumn("error_text", F.nullif("error_text", F.lit("")))
    return (flat.join(place, ["cycle", "table_name"], "left")
            .withColumn("entity_type", F.lit("source_file"))
            .withColumn("entity_name", F.concat_ws("_", "table_name", F.col("cycle").cast("string")))
            .withColumn("state_id", F.row_number().over(Window.orderBy("cycle", "table_name")).cast("bigint"))
            .withColumn("cycle", F.col("cycle").cast("bigint")).select(*STATE_COLUMNS))
