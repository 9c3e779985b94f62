"""Session defaults for local runs and tests (a cluster passes its own conf)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# HotSpot interprets methods of more bytecode than this for good.
JIT_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Lower the session's limit for generated methods to what the JVM compiles.

    A wide render or parse in one whole-stage method exceeds it and would run interpreted;
    behind the limit Spark runs the stage operator by operator, each expression in methods of its own.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > JIT_BYTES:
        spark.conf.set(name, str(JIT_BYTES))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", str(JIT_BYTES))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if not sc.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        # Local runs only: a cluster names its shared folder in spark.checkpoint.dir.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir="/tmp"))
    return spark
