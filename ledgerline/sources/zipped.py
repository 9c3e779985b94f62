"""ZIP-member landing source (A2): ``(archive, member)`` -> raw lines on executors.

A DEFLATE member is not splittable, so exactly one task streams one member.
The manifest (one row per archive) is repartitioned to one archive per
partition; each task opens its archive with ``zipfile`` and yields Arrow
batches of **binary** lines (``\\r`` stripped), never materialising the member.
Bytes become strings only afterwards (``cast``), and lines that are not valid
UTF-8 are dropped by the layout scan -- exactly like the text source.

The archives must be readable by every executor under the same path (a
shared or mounted filesystem).  After extraction the lines are spread over
the cluster (or written to a bronze table) so the parse runs in parallel; a
lost task simply re-reads its archive (the output is deterministic, with a
line number per row).
"""

from __future__ import annotations

import os
import time
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.sources.archives import file_hash, mounted
from ledgerline.sources.delimited import line_shape_ok, parse_lines, usable, width_of
from ledgerline.sources.layouts import Layout

LINES_SCHEMA = "cycle int, zip_path string, source_entry string, line_no bigint, raw binary"
_OUT = pa.schema([("cycle", pa.int32()), ("zip_path", pa.string()), ("source_entry", pa.string()),
                  ("line_no", pa.int64()), ("raw", pa.binary())])
MEMBERS_SCHEMA = LINES_SCHEMA + ", table_name string, source_file_hash string, duration_ms bigint"
_MEMBERS = pa.schema([*_OUT, ("table_name", pa.string()), ("source_file_hash", pa.string()), ("duration_ms", pa.int64())])
BATCH_LINES = 65536
BLOCK_BYTES = 8 << 20


def _member_blocks(path: str, member: str) -> Iterator[tuple[int, list[bytes]]]:
    """``(first line number, lines)`` per block read from one member.

    Lines are cut with C-level ``bytes`` methods on whole blocks (no per-line
    Python loop); a trailing ``\r`` is dropped per line, including on a last
    line without ``\n``.  A line cut by a block border is carried over.
    """
    no, carry = 0, b""
    with zipfile.ZipFile(path) as zf, zf.open(member) as fh:
        while block := fh.read(BLOCK_BYTES):
            data = carry + block
            cut = data.rfind(b"\n")
            if cut < 0:
                carry = data
                continue
            carry = data[cut + 1:]
            lines = data[:cut + 1].replace(b"\r\n", b"\n")[:-1].split(b"\n")
            yield no, lines
            no += len(lines)
    if carry:
        yield no, [carry[:-1] if carry.endswith(b"\r") else carry]


def _extract(root: str, members: bool = False):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():  # manifest rows: one archive member each
                began = time.monotonic()
                path = os.path.join(root, row["zip_path"]) if root else row["zip_path"]
                for first, lines in _member_blocks(path, row["source_entry"]):
                    for s in range(0, len(lines), BATCH_LINES):
                        part = lines[s:s + BATCH_LINES]
                        out = _batch(row, range(first + s, first + s + len(part)), part)
                        yield _of_member(out, row) if members else out
                if members:
                    digest = file_hash(path)
                    yield _of_member(_batch(row, range(-1, 0), [None]), row, digest, int((time.monotonic() - began) * 1000))

    return fn


def _of_member(lines: pa.RecordBatch, row: dict, digest: str | None = None, ms: int | None = None) -> pa.RecordBatch:
    n = lines.num_rows
    return pa.RecordBatch.from_arrays([
        *lines.columns, *(pa.repeat(pa.scalar(v, t), n) for v, t in zip((row["table_name"], digest, ms), _MEMBERS.types[-3:]))], schema=_MEMBERS)


def _batch(row: dict, nos: range, raws: list[bytes]) -> pa.RecordBatch:
    n = len(raws)
    return pa.RecordBatch.from_arrays([
        *(pa.repeat(pa.scalar(row[c], t), n) for c, t in zip(_OUT.names[:3], _OUT.types)),
        pa.array(np.arange(nos.start, nos.stop)), pa.array(raws, pa.binary())], schema=_OUT)


def _one_per_task(m: DataFrame) -> tuple[DataFrame, int]:
    """``m`` with one archive per partition, and the number of archives."""
    n_archives = max(1, m.count())  # manifest size: one row per archive (metadata, bounded)
    # Dense index over the (bounded) manifest, range-placed: one archive per task,
    # where hash placement would pile two large archives onto one task.
    idx = m.withColumn("_i", F.row_number().over(Window.orderBy("zip_path", "source_entry")))
    return idx.repartitionByRange(n_archives, "_i").drop("_i"), n_archives


def zip_lines(spark: SparkSession, manifest: DataFrame, root: str = "",
              spread_to: int | None = None) -> DataFrame:
    """``manifest(cycle, zip_path, source_entry)`` -> ``(cycle, zip_path, source_entry, line_no, value)``."""
    m, n_archives = _one_per_task(manifest.select(F.col("cycle").cast("int").alias("cycle"), "zip_path", "source_entry"))
    raw = m.mapInArrow(_extract(mounted(root)), LINES_SCHEMA)
    lines = raw.select("cycle", "zip_path", "source_entry", "line_no", F.col("raw").cast("string").alias("value"))
    want = spread_to or spark.sparkContext.defaultParallelism
    # Hash on the line's identity: balanced and deterministic on task retry.
    return lines.repartition(want, "zip_path", "source_entry", "line_no") if want > n_archives else lines


def zip_members(spark: SparkSession, manifest: DataFrame, root: str = "") -> DataFrame:
    """``manifest(table_name, cycle, zip_path, source_entry)`` -> the lines of ``zip_lines`` and one row per member.

    That row has no ``value`` and a ``line_no`` of -1; it carries the archive's sha256 and
    the milliseconds from its opening until its last line was handed on and its bytes were
    digested.  Lines and digest come from one task and one pass of the job.
    """
    m, _ = _one_per_task(manifest.select("table_name", F.col("cycle").cast("int").alias("cycle"), "zip_path", "source_entry"))
    raw = m.mapInArrow(_extract(mounted(root), members=True), MEMBERS_SCHEMA)
    return raw.withColumn("value", F.col("raw").cast("string")).drop("raw")


def member_stats(members: DataFrame) -> DataFrame:
    """One row per archive member of ``zip_members``: accepted and rejected lines, sha256, milliseconds."""
    width = width_of(F.col("table_name"))
    line = F.col("value").isNotNull() & width.isNotNull()
    rows = members.withColumn("bad", ~usable(F.col("value")) | ~line_shape_ok(F.col("value"), width))
    # The digest is on one row of a member: collected, since the largest of texts would sort all lines first.
    return rows.groupBy("table_name", "cycle", "zip_path", "source_entry").agg(
        (F.count_if(line) - F.count_if(line & F.col("bad"))).alias("row_count"), F.count_if(line & F.col("bad")).alias("rejected_rows"),
        F.array_max(F.collect_list("source_file_hash")).alias("source_file_hash"), F.max("duration_ms").alias("duration_ms"))


def write_bronze(lines: DataFrame, path: str) -> None:
    """Persist extracted lines (cuts lineage: the parse re-reads this, not the archives)."""
    lines.write.mode("overwrite").partitionBy("cycle").parquet(path)


def load_zip(spark: SparkSession, manifest: DataFrame, layout: Layout, root: str = "",
             bronze_path: str | None = None) -> DataFrame:
    """A2 + A1: members of ``manifest`` parsed into ``layout``."""
    lines = zip_lines(spark, manifest, root)
    if bronze_path:
        write_bronze(lines, bronze_path)
        lines = spark.read.parquet(bronze_path)
    return parse_lines(lines, layout, keep=("cycle", "source_entry"))
