"""Join helpers.

Joins carry no broadcast hint and no row-count probe: Catalyst broadcasts a side whose
estimated bytes are under ``spark.sql.autoBroadcastJoinThreshold``, and AQE decides again
from the measured shuffle bytes, skew splitting included.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def every_cycle(counts: DataFrame, cycles: DataFrame | None) -> DataFrame:
    """``counts`` (one row per cycle) with a row of zeros for each expected cycle that has none.

    ``cycles``: the expected cycles (a bounded list), or None for those of the counts alone.
    """
    if cycles is None:
        return counts
    expected = cycles.select(F.col("cycle").cast("int").alias("cycle")).distinct()
    return expected.join(counts, "cycle", "full").na.fill(0)


SPREAD = "spark.ledgerline.fixturePartitions"


def spread(df: DataFrame) -> DataFrame:
    """Fixture frames only: hash-spread over as many partitions as the session setting ``SPREAD`` names.

    Unset, the default, the scan is left as it is: no shuffle and no listing of
    files.  A single-row-group fixture file arrives as one partition, so a local
    benchmark names its cores here.
    """
    want = df.sparkSession.conf.get(SPREAD, None)
    # Hash, not round-robin: deterministic on task retry without an extra sort.
    return df.repartition(int(want), F.xxhash64(*df.columns)) if want else df


def dealt(df: DataFrame) -> DataFrame:
    """Fixture frames of narrow rows that many lines are made of: dealt over all cores, or as ``spread`` says.

    A file of less than a row group (a million rows) is one task otherwise, whatever is computed from its rows.
    """
    want = df.sparkSession.conf.get(SPREAD, None) or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(int(want))  # in turn: Spark sorts rows first, so a retried task deals them alike


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.  Unset: a local one on a local master (tests), else an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerline-shared-"))
    return named or sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small, reused intermediate once and cut its lineage: a reliable checkpoint in ``shared_folder``.

    Only used for findings-sized frames (tests, issues), never facts.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
