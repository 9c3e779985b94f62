"""Delimited text whose fields may be quoted: record borders over file splits, one dialect per file.

A field is quoted if it starts with a double quote; inside it the delimiter and line ends are
text and a doubled quote stands for one.  A record may therefore run over several lines and
over the border of two splits, and whether a line starts inside a quoted field depends on all
lines before it.  That is a prefix scan:

1. every split is read as if it began outside and as if it began inside a quoted field, which
   gives a small state function (outside, inside, broken); only lines that hold a quote matter;
2. the functions of a file's splits, one row each, are composed in order: this yields the state
   in which each split begins and the file's dialect;
3. every split is read again from its known state.  Records that lie in one split come out
   whole; those that cross a border come out in pieces (at most two a split), which alone are
   shuffled and put together.  The text itself is never shuffled.

The dialect is decided per file: quotes count if at least one field is quoted and every quoted
field is well formed, that is closed before the end of the file and followed by a delimiter or
a line end.  Otherwise the file is read literally, as ``delimited`` does.

Lines end with ``\\n``; a ``\\r`` before the end of a record is dropped.  Blank records and
records that are not valid UTF-8 are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.clean import clean
from ledgerline.sources.delimited import field_count_ok
from ledgerline.sources.layouts import Layout

OUTSIDE, INSIDE, BROKEN = 0, 1, 2
QUOTED_FIELD = r'\|("[^"]*+(?:""[^"]*+)*+"|[^|]*+)'


def _closed(line: bytes, at: int) -> int:
    """The place behind the quote that closes the field open at ``at``; -1 if the line does not close it."""
    while (quote := line.find(b'"', at)) >= 0:
        if line[quote + 1:quote + 2] != b'"':
            return quote + 1
        at = quote + 2
    return -1


def line_state(line: bytes, state: int) -> tuple[int, bool]:
    """(state behind a line, whether a quoted field starts in it)."""
    if state == BROKEN:
        return BROKEN, False
    at, quoted, end = 0, False, len(line)
    opened = state == INSIDE
    while True:
        if not opened and line[at:at + 1] == b'"':
            opened, quoted, at = True, True, at + 1
        if opened:
            at = _closed(line, at)
            if at < 0:
                return INSIDE, quoted
            if at == end or line[at:] == b"\r":
                return OUTSIDE, quoted
            if line[at:at + 1] != b"|":
                return BROKEN, quoted
            opened, at = False, at + 1
        else:
            at = line.find(b"|", at) + 1
            if at == 0:
                return OUTSIDE, quoted


def _lines(spark: SparkSession, paths: str | list[str], keep: Iterable[str]) -> DataFrame:
    """(keep..., path, block, value, has_quote), in file order within a task."""
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(paths).select(
        *keep, *place, F.col("value").cast("binary").alias("value"), F.col("value").contains('"').alias("has_quote"))


def split_states(lines: DataFrame) -> DataFrame:
    """(path, block, outside, inside, quoted): the state function of each split that holds a quote."""
    def run(batches):
        place, states, quoted = None, [], [False, False]

        def row():
            return pa.record_batch([pa.array([x]) for x in (*place, *states)] + [pa.array([quoted])],
                                   pa.schema([("path", pa.string()), ("block", pa.int64()), ("outside", pa.int32()), ("inside", pa.int32()),
                                              ("quoted", pa.list_(pa.bool_()))]))

        for batch in batches:
            for path, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, block) != place:
                    if place is not None:
                        yield row()
                    place, states, quoted = (path, block), [OUTSIDE, INSIDE], [False, False]
                for k in (0, 1):
                    states[k], opens = line_state(line, states[k])
                    quoted[k] |= opens
        if place is not None:
            yield row()

    return lines.where("has_quote").select("path", "block", "value").mapInArrow(
        run, "path string, block bigint, outside int, inside int, quoted array<boolean>")


def split_starts(lines: DataFrame) -> DataFrame:
    """(path, block, quoted, starts_inside): each split's file's dialect and its own first state.

    A group is the splits of one file, whose number is its size over the session's split size.
    """
    blocks = lines.select("path", "block").distinct()

    def compose(file: pd.DataFrame) -> pd.DataFrame:
        state, quoted, starts = OUTSIDE, False, []
        file = file.sort_values("block")
        for outside, inside, flags in zip(file["outside"], file["inside"], file["quoted"]):
            starts.append(state == INSIDE)
            if flags is not None:  # a split without quotes leaves the state as it is
                quoted |= state != BROKEN and bool(flags[state])
                state = (outside, inside, BROKEN)[state]
        return pd.DataFrame({"path": file["path"], "block": file["block"], "quoted": quoted and state == OUTSIDE, "starts_inside": starts})

    states = blocks.join(split_states(lines), ["path", "block"], "left")
    states = states.na.fill({"outside": OUTSIDE, "inside": INSIDE})
    return states.groupBy("path").applyInPandas(compose, "path string, block bigint, quoted boolean, starts_inside boolean")


def _records(lines: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., path, block, seq, piece, value) of files read with quotes: whole records and pieces of records.

    ``piece`` is 0 for a whole record, 1 for the beginning of one that runs on into the next split,
    2 for lines that go on with a record of an earlier split.
    """
    names = [*keep, "path", "block"]
    kept = lines.select(*names).schema

    def run(batches):
        place, inside, goes_on, held, own = None, False, False, [], None

        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            values = cols["value"]
            n = batch.num_rows
            blocks, quotes = cols["block"].to_numpy(zero_copy_only=False), cols["has_quote"].to_numpy(zero_copy_only=False)
            paths = cols["path"].dictionary_encode().indices.to_numpy()
            fresh = np.ones(n, bool)
            fresh[1:] = (blocks[1:] != blocks[:-1]) | (paths[1:] != paths[:-1])
            if n and place == (cols["path"][0].as_py(), int(blocks[0])):
                fresh[0] = False
            plain = np.zeros(n, bool)
            out: list[tuple] = []
            at = 0
            for e in [*np.flatnonzero(fresh | quotes).tolist(), n]:
                if inside:
                    held.extend(values[at:e].to_pylist())
                else:
                    plain[at:e] = True
                if e == n:
                    break
                at = e
                if fresh[e]:
                    if held:
                        out.append((own, 2 if goes_on else 1, b"\n".join(held)))
                    place = (cols["path"][e].as_py(), int(blocks[e]))
                    own = tuple(cols[c][e].as_py() for c in names)
                    held, inside = [], cols["starts_inside"][e].as_py()
                    goes_on = inside
                if quotes[e]:
                    line = values[e].as_py()
                    held.append(line)
                    state, _ = line_state(line, INSIDE if inside else OUTSIDE)
                    inside = state == INSIDE
                    if not inside:
                        out.append((own, 2 if goes_on else 0, b"\n".join(held)))
                        held, goes_on = [], False
                    at = e + 1
            whole = batch.filter(pa.array(plain))
            yield pa.RecordBatch.from_arrays([*(whole.column(c) for c in names), pa.array([0] * whole.num_rows, pa.int32()), whole.column("value")],
                                             names=[*names, "piece", "value"])
            if out:
                yield _rows(out, names, [batch.schema.field(c).type for c in names])
        if held:
            yield _rows([(own, 2 if goes_on else 1, b"\n".join(held))], names, types=None, schema=kept)

    return lines.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "piece int", "value binary"]))


def _rows(out: list[tuple], names: list[str], types, schema=None) -> pa.RecordBatch:
    if types is None:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in schema]
    own = [pa.array([row[0][k] for row in out], t) for k, t in enumerate(types)]
    return pa.RecordBatch.from_arrays([*own, pa.array([row[1] for row in out], pa.int32()), pa.array([row[2] for row in out], pa.binary())],
                                      names=[*names, "piece", "value"])


def _glued(records: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., value): pieces put together in file order; a record has one beginning and then goes on."""
    pieces = records.where("piece > 0").select(*keep, "path", "block", "piece", "value")
    order = "(partition by path order by block, piece desc)"
    numbered = pieces.withColumn("record", F.expr(f"count_if(piece = 1) over {order}"))
    first = [F.min_by(c, F.struct("block", F.lit(0) - F.col("piece"))).alias(c) for c in keep]
    parts = F.sort_array(F.collect_list(F.struct("block", (F.lit(0) - F.col("piece")).alias("rank"), F.col("value").cast("string").alias("text"))))
    return numbered.groupBy("path", "record").agg(*first, parts.alias("parts")).select(
        *keep, F.array_join(F.col("parts.text"), "\n").cast("binary").alias("value"))


def _unquoted(field: Column) -> Column:
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), inner).otherwise(field)


def read_records(spark: SparkSession, paths: str | list[str], keep: Iterable[str] = ("cycle",)) -> DataFrame:
    """(keep..., quoted, value, parts): the records of delimited files and their fields.

    ``keep`` names partition columns of the paths.  ``quoted`` tells the file's dialect.  An empty
    file has no records.  The states are broadcast, since a join that moves lines would lose their
    order: one row for each split of the scan, about 200 bytes for every
    ``spark.sql.files.maxPartitionBytes`` of text.  A split that was cut otherwise when the states
    were taken stops the job instead of being read from a wrong state.
    """
    keep = list(keep)
    lines = _lines(spark, paths, keep)
    known = F.coalesce("quoted", F.raise_error(F.lit("splits changed while the text was read")).cast("boolean"))
    tagged = lines.join(F.broadcast(split_starts(lines)), ["path", "block"], "left").withColumn("quoted", known)
    literal = tagged.where(~F.col("quoted")).select(*keep, F.lit(False).alias("quoted"), "value")
    records = _records(tagged.where("quoted").drop("quoted"), keep)
    whole = records.where("piece = 0").select(*keep, "value").union(_glued(records, keep))
    every = literal.union(whole.select(*keep, F.lit(True).alias("quoted"), "value"))
    text = every.withColumn("value", F.col("value").cast("string")).where(F.is_valid_utf8("value"))
    text = text.withColumn("value", F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")))
    fields = F.transform(F.regexp_extract_all(F.concat(F.lit("|"), "value"), F.lit(QUOTED_FIELD), F.lit(1)), _unquoted)
    special = F.col("quoted") & F.col("value").contains('"')
    return text.where("value <> ''").withColumn("parts", F.when(special, fields).otherwise(F.split("value", r"\|", -1)))


def parse_records(records: DataFrame, layout: Layout, keep: Iterable[str] = ("cycle",)) -> DataFrame:
    """Typed rows of ``layout`` from records; those with too many fields are skipped, short ones padded."""
    n = len(layout.columns)
    parts = F.col("parts")
    typed = [clean(kind, F.get(parts, i)).alias(name) for i, (name, kind) in enumerate(layout.columns)]
    return records.where(field_count_ok(parts, n)).select(*keep, *typed)
