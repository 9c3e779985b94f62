"""Best-fit packing by minimum bin slack.

Documents become token ids plus an end id; only documents longer than a sequence are
cut, so that every piece but the first is full.  How the pieces share sequences depends
on their lengths alone, and there are at most ``size`` of those: the counts by length go
to the driver (a fixed number of rows).  There, bin by bin, the longest length left opens
a bin and a subset-sum over the lengths still available, kept as bitsets, finds the
fullest bin.  A pattern is used as often as its lengths last, so the work depends on the
number of lengths, not of documents.  Each pattern gives, for each of its lengths, a range
of ranks, a first sequence number and an offset; executors find every piece's place by
its rank among the pieces of its length.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.stage import cut, small_batches

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Ids of a byte-level BPE.  The rank file holds the vocabulary of the tokenizer file;
    texts with one of the tokenizer's special strings, and those it cannot cut, go to the tokenizer itself."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        try:
            return np.asarray(self.bpe.encode_to_numpy(text, disallowed_special=()), "<u4")
        except ValueError:  # its pattern gives up on a million blanks in a row
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def cut_points(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all full but perhaps the first."""
    head = n % size or min(n, size)
    return [(0, head)] + [(at, size) for at in range(head, n, size)]


def pieces(docs: DataFrame, size: int, tokenizer_path: str, ranks_path: str, pattern: str, end_id: int) -> DataFrame:
    """One row per piece, with the CRC-32 of its ids as little-endian 32-bit numbers."""
    def run(batches):
        encoder = Encoder(tokenizer_path, ranks_path, pattern)
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (at, length) in enumerate(cut_points(len(ids), size)):
                    for col, x in zip(cols, (doc_id, k, at, length, zlib.crc32(ids[at:at + length].tobytes()))):
                        col.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, PIECES)


def _fullest(room: int, lengths: list[int], left: dict[int, int]) -> list[int]:
    """Lengths with the largest sum up to ``room``; the bitset of reachable sums grows length by length, longest first."""
    if room <= 0:
        return []
    lengths = lengths[:bisect_right(lengths, room)]
    mask = (1 << (room + 1)) - 1
    steps, reach = [], 1
    for length in reversed(lengths):
        copies, share = min(left[length], room // length), 1
        while copies > 0:
            take = min(share, copies)
            grown = reach | (reach << take * length) & mask
            if grown != reach:
                steps.append((reach, length, take))
                reach = grown
            copies, share = copies - take, share * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            out += [length] * take
            at -= take * length
    return out


def patterns(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many sequences) until all pieces are packed."""
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    out = []
    while lengths:
        first = lengths[-1]
        left[first] -= 1
        bin_ = [first, *_fullest(size - first, lengths, left)]
        left[first] += 1
        uses = {length: bin_.count(length) for length in set(bin_)}
        times = min(left[length] // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= times * n
        lengths = [x for x in lengths if left[x]]
        out.append((bin_, times))
    return out


def slots(found: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: where the ranks of each length go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for bin_, times in found:
        offset = 0
        for length in bin_:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def best_fit_packing(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", size: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Every row of ``docs`` is packed by itself: repeated rows and null ids too; a null text is
    empty and gives the end id only.  Sequences have no gaps: their pieces lie end to end from
    offset 0.  An empty table gives no rows.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    rows = cut(pieces(docs, size, tokenizer_path, ranks_path, pattern, end_id)
               .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    by_part = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(patterns(histogram, size))

    before = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = (rows.withColumn("own", F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1)
              .join(before, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank")))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                lo, hi = np.searchsorted(table[:, 0], (x, x + 1))
                mine = length == x
                at[mine] = lo + np.searchsorted(table[lo:hi, 1], rank[mine], "right") - 1
            spot = table[at]
            yield pa.record_batch([*batch.columns[:5], pa.array(spot[:, 2] + rank - spot[:, 1]), pa.array(np.ascontiguousarray(spot[:, 3]))],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id bigint, offset bigint")
