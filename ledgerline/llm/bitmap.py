"""Fixed-size bitmaps of 64-bit keys, built by a tree reduction: cheap map-side filters.

A key that was added always tests true; others test true with a probability that
grows with the number of keys.  They only spare shuffles: whoever uses one checks
exactly afterwards, so a full bitmap costs time and never changes a result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.words import mix

BITS = 25


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def build(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """Packed bitmap of the single bigint column of ``keys`` (2**bits / 8 bytes on the driver, whatever the input)."""
    def local(batches):
        seen = np.zeros(1 << bits, bool)
        for batch in batches:
            seen[_slots(np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)), bits)] = True
        yield pa.record_batch([pa.array([zlib.compress(np.packbits(seen).tobytes(), 1)], pa.binary())], names=["bits"])

    def either(a: bytes, b: bytes) -> bytes:
        if not a or not b:
            return a or b
        x, y = (np.frombuffer(zlib.decompress(z), np.uint8) for z in (a, b))
        return zlib.compress((x | y).tobytes(), 1)

    name = keys.columns[0]
    parts = keys.where(keys[name].isNotNull()).mapInArrow(local, "bits binary")
    total = parts.rdd.map(lambda r: bytes(r[0])).treeAggregate(b"", either, either)
    return np.frombuffer(zlib.decompress(total), np.uint8) if total else np.zeros(1 << bits >> 3, np.uint8)


def test(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may have been added."""
    bits = int(len(bitmap) * 8).bit_length() - 1
    at = _slots(np.ascontiguousarray(keys), bits)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def keep_rows(df: DataFrame, column: str, bitmap: np.ndarray, inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose bigint ``column`` may be in the bitmap; with ``inside`` False, all others (nulls among them)."""
    at = df.columns.index(column)

    def run(batches):
        for batch in batches:
            keys = batch.column(at)
            known = np.asarray(keys.is_valid())
            hit = (known & test(bitmap, keys.fill_null(0).to_numpy(zero_copy_only=False))) == inside
            if hit.any():
                yield batch.filter(pa.array(hit))

    return df.mapInArrow(run, df.schema)
