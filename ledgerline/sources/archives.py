"""Landing lines written as ZIP archives by the executors, the counterpart of ``sources.zipped``.

Every task writes its own archive for each ``(table_name, cycle)`` among its rows, so no
cycle has to fit one task: ``<root>/data/<cycle>/<table><yy>-<part>.zip`` with the layout's
member inside.  The name depends on the partition alone and the entry carries a fixed
time, so a task that runs again writes the same bytes; an archive is written under the
name of its attempt and then renamed, so a reader sees a whole one or none.  The folder
must be mounted under the same path on every executor.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import zipfile
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.layouts import LAYOUTS

MANIFEST_SCHEMA = ("table_name string, cycle int, zip_path string, source_entry string, n_lines bigint, "
                   "zip_bytes bigint, written_hash string")
_OUT = pa.schema([("table_name", pa.string()), ("cycle", pa.int32()), ("zip_path", pa.string()),
                  ("source_entry", pa.string()), ("n_lines", pa.int64()), ("zip_bytes", pa.int64()),
                  ("written_hash", pa.string())])
_MADE = (1980, 1, 1, 0, 0, 0)  # the earliest time a ZIP entry can hold: archives do not depend on when they are written
BLOCK_BYTES = 1 << 20
LEVEL = 1  # of DEFLATE: landing lines shrink to a third; the default level takes a fifth off that at three times the time


def mounted(folder: str) -> str:
    """Path of a folder that every machine mounts; a ``file:`` URI loses its scheme, other schemes are refused."""
    at = urlsplit(folder)
    if at.scheme not in ("", "file"):
        raise ValueError(f"archives need a mounted folder, not {folder}")
    return at.path


def file_hash(path: str) -> str:
    """sha256 of a file, read in blocks."""
    digest = hashlib.sha256()
    with open(path, "rb") as fh:
        while block := fh.read(BLOCK_BYTES):
            digest.update(block)
    return digest.hexdigest()


def member_name(table: str, cycle: int) -> str:
    return LAYOUTS[table].member.replace("{yy}", f"{cycle % 100:02d}")


class _Archive:
    """One open archive: blocks go to its only member, ``close`` gives the manifest row."""

    def __init__(self, root: str, table: str, cycle: int, part: int, attempt: int):
        self.table, self.cycle, self.entry, self.lines = table, cycle, member_name(table, cycle), 0
        self.zip_path = f"data/{cycle}/{table}{cycle % 100:02d}-{part:05d}.zip"
        self.path = os.path.join(root, self.zip_path)
        self.draft = f"{self.path}.{attempt}"
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        self.zip = zipfile.ZipFile(self.draft, "w", zipfile.ZIP_DEFLATED)
        entry = zipfile.ZipInfo(self.entry, _MADE)
        entry.compress_type, entry.compress_level = zipfile.ZIP_DEFLATED, LEVEL  # an entry of its own does not take the archive's
        self.member = self.zip.open(entry, "w", force_zip64=True)

    def write(self, lines: pa.BinaryArray) -> None:
        """Append lines as their array holds them, one behind the other."""
        ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1]
        if ends[-1] > ends[0]:
            self.member.write(lines.buffers()[2][int(ends[0]):int(ends[-1])])
        self.lines += len(lines)

    def close(self) -> dict:
        self.member.close()
        self.zip.close()
        digest, size = file_hash(self.draft), os.path.getsize(self.draft)
        os.replace(self.draft, self.path)
        return {"table_name": self.table, "cycle": self.cycle, "zip_path": self.zip_path, "source_entry": self.entry,
                "n_lines": self.lines, "zip_bytes": size, "written_hash": digest}


def _write(root: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        made: dict[tuple, _Archive] = {}  # bounded: tables x cycles
        for batch in batches:
            tables, cycles = (batch.column(i).dictionary_encode() for i in (0, 1))
            codes = tables.indices.to_numpy().astype(np.int64) * len(cycles.dictionary) + cycles.indices.to_numpy()
            for code in np.unique(codes):
                key = tuple(d.dictionary[int(k)].as_py() for d, k in zip((tables, cycles), divmod(code, len(cycles.dictionary))))
                if key not in made:
                    made[key] = _Archive(root, *key, part, attempt)
                made[key].write(batch.column(2).filter(pa.array(codes == code)).cast(pa.binary()))
        rows = [made[key].close() for key in sorted(made)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_OUT)

    return fn


def write_archives(lines: DataFrame, root: str) -> DataFrame:
    """Write ``lines(table_name, cycle, raw)`` below ``root``; one row per archive, as stored in ``<root>/manifest``.

    ``raw``: a line in bytes with its own line end.  Rows with a NULL in any of the three
    are refused.  The manifest is a written table, so reading it never writes again.
    """
    spark = lines.sparkSession
    want = lines.select("table_name", F.col("cycle").cast("int").alias("cycle"), "raw")
    for c in want.columns:
        want = want.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} of a line is NULL")))
                               .otherwise(F.col(c)))
    want.mapInArrow(_write(mounted(root)), MANIFEST_SCHEMA).write.parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


def remove_archives(archives: DataFrame, root: str) -> None:
    """Remove the archives that a manifest of ``write_archives`` names; the manifest stays."""
    at = mounted(root)
    for r in archives.select("zip_path").toLocalIterator():  # metadata: a row per archive
        with contextlib.suppress(FileNotFoundError):
            os.remove(os.path.join(at, r.zip_path))
