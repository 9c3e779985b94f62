"""A1: profile of every slot of split lines -- rows, filled rows, characters, extremes and distinct texts.

Lines are split by Arrow in the Python workers, so no field is a row of its own.  A task
counts its lines slot by slot and keeps the different texts; texts of one slot leave it as
blocks, joined by the delimiter (which no field holds) and compressed.  Blocks are dealt by
a bucket of their texts, so equal texts meet in one task whatever the number of texts.

The count of distinct texts is exact: texts are compared, not hashes of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.delimited import usable
from ledgerline.sources.layouts import LAYOUTS

CHUNK_BYTES = 32 << 20  # lines split at once
HELD_BYTES = 64 << 20  # different texts that a task keeps before it hands them on
BLOCK_ROWS = 4096
# A bucket is chosen by a text without its last bytes, so that neighbours (numbers, dates) share a block and compress well.
TAIL = 3
STEM = 512  # bytes of a text that choose its bucket
HASHED = 16384  # texts hashed at once
ODD = 0x9E3779B97F4A7C15

_KEY = [("table_name", pa.string()), ("cycle", pa.int32()), ("slot", pa.int32())]
_SUMS = [("n_rows", pa.int64()), ("n_filled", pa.int64()), ("n_chars", pa.int64()), ("least", pa.string()), ("greatest", pa.string())]
_BLOCKS = pa.schema([*_KEY, *_SUMS, ("bucket", pa.int32()), ("n_bytes", pa.int64()), ("block", pa.binary())])
_COUNTS = pa.schema([*_KEY, *_SUMS, ("n_distinct", pa.int64())])
_KEY_DDL = "table_name string, cycle int, slot int"
_SUMS_DDL = "n_rows bigint, n_filled bigint, n_chars bigint, least string, greatest string"
BLOCKS_SCHEMA = f"{_KEY_DDL}, {_SUMS_DDL}, bucket int, n_bytes bigint, block binary"
COUNTS_SCHEMA = f"{_KEY_DDL}, {_SUMS_DDL}, n_distinct bigint"


class _Slot:
    """What a task knows of one slot: sums over its lines and the different texts that are not blank."""

    def __init__(self):
        self.rows = self.filled = self.chars = 0
        self.texts: list[pa.Array] = []

    def add(self, texts: pa.Array) -> None:
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        filled = int(np.count_nonzero(sizes))
        self.rows += len(texts)
        self.filled += filled
        self.chars += int(sizes.sum(dtype=np.int64))
        if filled:
            own = texts.unique()
            self.texts.append(own if filled == len(texts) else own.filter(pc.not_equal(own, "")))
            if len(self.texts) == 8:
                self.merged()

    def merged(self) -> pa.Array:
        if len(self.texts) > 1:
            self.texts = [pa.chunked_array(self.texts).unique()]
        return self.texts[0] if self.texts else pa.array([], pa.string())


def _fields(lines: pa.Array, width: int) -> Iterator[tuple[int, pa.Array]]:
    """``(position, texts)`` of split lines, lines of one number of fields at a time; as ``delimited.field_count_ok`` has it.

    The shape is seen after the split, so no line is searched for delimiters twice.
    """
    parts = pc.split_pattern(lines, "|")
    starts = parts.offsets.to_numpy()
    sizes = np.diff(starts)
    for n in np.unique(sizes[sizes <= width + 1]):
        at = starts[:-1][sizes == n]
        if n > width:
            at = at[pc.equal(parts.values.take(pa.array(at + width)), "").to_numpy(zero_copy_only=False)]
        for i in range(n):
            yield i, parts.values.take(pa.array(at + i))


def _add(slots: dict[tuple, _Slot], batches: list[pa.RecordBatch], widths: dict[str, int]) -> None:
    """Count buffered lines, by table and cycle."""
    whole = pa.Table.from_batches(batches)
    tables, cycles = (whole.column(i).combine_chunks().dictionary_encode(null_encoding="encode") for i in (0, 1))
    values = whole.column(2).combine_chunks().cast(pa.string())
    codes = tables.indices.to_numpy().astype(np.int64) * len(cycles.dictionary) + cycles.indices.to_numpy()
    for code in np.unique(codes):
        table, cycle = (d.dictionary[int(k)].as_py() for d, k in zip((tables, cycles), divmod(code, len(cycles.dictionary))))
        for i, texts in _fields(values.filter(pa.array(codes == code)), widths[table]):
            slots.setdefault((table, cycle, i + 1), _Slot()).add(texts)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])  # modulo 2^64


def _buckets(texts: pa.Array, n: int) -> np.ndarray:
    """Bucket of each text, a hash of its stem: bytes weighted by powers of an odd number, taken from sums over many texts."""
    stems = pc.binary_slice(pc.binary_slice(texts.cast(pa.binary()), 0, -TAIL), 0, STEM)
    out = []
    for part in (stems.slice(i, HASHED) for i in range(0, len(stems), HASHED)):
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        sums = np.r_[np.uint64(0), np.cumsum((data + np.uint64(1)) * _powers(ODD, len(data))[:-1])]
        h = (sums[ends[1:]] - sums[ends[:-1]]) * _powers(pow(ODD, -1, 1 << 64), len(data))[ends[:-1]]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(ODD)
        out.append(((h >> np.uint64(33)) % np.uint64(n)).astype(np.int32))
    return np.concatenate(out)


def _blocks(texts: pa.Array, n: int) -> Iterator[tuple[int, int, bytes]]:
    """``(bucket, bytes before compression, block)`` of different texts."""
    buckets = _buckets(texts, n)
    order = np.argsort(buckets, kind="stable")
    found, first = np.unique(buckets[order], return_index=True)
    dealt = pa.ListArray.from_arrays(pa.array([*first, len(texts)], pa.int32()), texts.take(pa.array(order)))
    for bucket, block in zip(found.tolist(), pc.binary_join(dealt, "|")):
        raw = block.as_buffer()
        yield bucket, raw.size, pa.compress(raw, "zstd", asbytes=True)


def _flushed(slots: dict[tuple, _Slot], n: int) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for key, slot in slots.items():
        texts = slot.merged()
        ends = pc.min_max(texts).as_py()
        rows.append((*key, slot.rows, slot.filled, slot.chars, ends["min"], ends["max"], -1, None, None))
        for bucket, n_bytes, block in _blocks(texts, n) if len(texts) else ():
            rows.append((*key, None, None, None, None, None, bucket, n_bytes, block))
            size += len(block)
            if len(rows) >= BLOCK_ROWS or size > CHUNK_BYTES:
                yield _batch(rows, _BLOCKS)
                rows, size = [], 0
    if rows:
        yield _batch(rows, _BLOCKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _profile(n: int, widths: dict[str, int]):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[tuple, _Slot] = {}  # bounded: tables x cycles x slots
        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            _add(slots, waiting, widths)
            waiting, size = [], 0
            if sum(t.nbytes for s in slots.values() for t in s.texts) > HELD_BYTES:
                yield from _flushed(slots, n)
                slots = {}
        if waiting:
            _add(slots, waiting, widths)
        yield from _flushed(slots, n)

    return fn


def _distinct(blocks: list[tuple[int, bytes]]) -> int:
    """Different texts of blocks; those of one block differ already."""
    held, size, texts = [], 0, None
    for n_bytes, block in blocks:
        held.append(pa.decompress(block, n_bytes, "zstd", asbytes=True))
        size += n_bytes
        if size > CHUNK_BYTES:
            texts, held, size = _united(texts, held), [], 0
    if texts is None and len(held) == 1:
        return held[0].count(b"|") + 1
    return len(_united(texts, held))


def _united(texts: pa.Array | None, held: list[bytes]) -> pa.Array:
    """Different texts among ``texts`` and blocks."""
    new = [pc.split_pattern(pa.array([b"|".join(held)], pa.binary()), "|").values] if held else []
    return pa.chunked_array(new if texts is None else [texts, *new]).unique()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slot and bucket -> sums handed on, blocks of a bucket as their count of texts."""
    at, blocks = None, []
    done: list[tuple] = []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("table_name", "cycle", "slot", "bucket")))
        for i, (*key, bucket) in enumerate(keys):
            if bucket < 0:
                done.append((*key, *(batch.column(c)[i].as_py() for c, _ in _SUMS), 0))
                continue
            if (*key, bucket) != at:
                if blocks:
                    done.append((*at[:3], 0, 0, 0, None, None, _distinct(blocks)))
                at, blocks = (*key, bucket), []
            blocks.append((batch.column("n_bytes")[i].as_py(), batch.column("block")[i].as_py()))
        if len(done) >= BLOCK_ROWS:
            yield _batch(done, _COUNTS)
            done = []
    if blocks:
        done.append((*at[:3], 0, 0, 0, None, None, _distinct(blocks)))
    if done:
        yield _batch(done, _COUNTS)


def slot_profile(lines: DataFrame) -> DataFrame:
    """One row per table, cycle and slot of the lines that the layout scan takes, from ``lines(table_name, cycle, value)``.

    As many buckets a slot as the session has shuffle partitions, so a task counts a share of each slot's texts.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    widths = {t: len(lay.columns) for t, lay in LAYOUTS.items()}
    want = lines.where(usable(F.col("value"))).select("table_name", F.col("cycle").cast("int").alias("cycle"), "value")
    key = ["table_name", "cycle", "slot"]
    blocks = want.mapInArrow(_profile(n, widths), BLOCKS_SCHEMA)
    dealt = blocks.repartition(*key, "bucket").sortWithinPartitions(*key, "bucket")
    return dealt.mapInArrow(_count, COUNTS_SCHEMA).groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_filled", "n_chars")], F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.sum("n_distinct").alias("n_distinct"))
