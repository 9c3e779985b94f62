"""Alignment of the tokens of two tokenizers, kept in Arrow from ids to links.

Tokenizer A is a byte-level BPE, B a sentencepiece model; both cut the same bytes, a space and
the text.  For a bounded chunk of texts, the lists of ids are flattened with their parent
indices, token lengths are summed up within each document, and the two tables of token ends
are joined by an Acero hash join on document-end keys.  Ends of both close a group.  Each
stretch between neighbouring ends of either is covered by one token of A and one of B, and each
overlapping pair has exactly one such stretch: the sorted outer join lists all links.

How many documents link an id pair is counted by ``Table.group_by`` within each task and merged
by Spark.  The most frequent pairs (a fixed number) travel to every task as two small arrays, so
that no hot pair is ever a join key; all other pairs of a document meet their counts in a
shuffled join.  Both roads give the same numbers for every pair.
"""

from __future__ import annotations

import os
import re
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import bpe
from ledgerline.llm.stage import cut, ensure_checkpoint_dir, small_batches

CHUNK_BYTES = 1_000_000
HEAD = 1 << 18
FLUSH = 2_000_000
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, a array<int>, b array<int>, times array<int>"


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, bytes_path: str, pieces_path: str):
        import sentencepiece

        self.a = bpe(bytes_path, False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        known = self.a.bytes
        pieces = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        if not all(known.values()) or not all(pieces):
            raise ValueError("a token without bytes has no end of its own")
        self.a_bytes = pa.array([known.get(i) for i in range(max(known) + 1)], pa.binary())
        self.b_bytes = pa.array(pieces, pa.binary())

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids by A of a space and each text, and by B of each text."""
        a = list(self.a.encode_many(" " + t for t in texts))
        b = self.b.encode(texts, num_threads=1) if texts else []
        flat_a = pa.array(np.concatenate([np.empty(0, "<u4"), *a]).astype(np.int32))
        flat_b = pa.array(np.fromiter(chain.from_iterable(b), np.int32))
        return pa.ListArray.from_arrays(_offsets(a), flat_a), pa.ListArray.from_arrays(_offsets(b), flat_b)


@lru_cache(2)
def _pair(bytes_path: str, pieces_path: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pair(bytes_path, pieces_path)


def _offsets(rows) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32))


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), values)


def _joined(ids: pa.ListArray, vocabulary: pa.Array) -> pa.Array:
    """The bytes of each list of ids."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, vocabulary.take(ids.values)), pa.scalar(b"", pa.binary()))


def _ends(ids: pa.ListArray, vocabulary: pa.Array, place: str) -> pa.Table:
    """One row per token: its document-end key (list number and byte end within it) and its place in the flat list."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(vocabulary.take(flat)).cast(pa.int64()))
    sums = np.concatenate(([0], total.to_numpy(zero_copy_only=False)))
    before = pa.array(sums[ids.offsets.to_numpy()[:-1]])
    end = pc.subtract(total, before.take(parent))
    key = pc.add(pc.multiply(parent.cast(pa.int64()), 1 << 32), end)
    return pa.table({"end": key, place: pa.array(np.arange(len(flat), dtype=np.int64))})


def align_chunk(texts: list[str], pair: Pair) -> pa.RecordBatch:
    """Alignment of non-empty texts: the columns of ALIGNED after doc_id."""
    a_ids, b_ids = pair.encode(texts)
    want = pa.array([b" " + t.encode() for t in texts], pa.binary())
    same = pc.and_(pc.equal(_joined(a_ids, pair.a_bytes), want), pc.equal(_joined(b_ids, pair.b_bytes), want))
    # lists of texts that a tokenizer does not give back become empty
    whole = same.to_numpy(zero_copy_only=False)
    a_ids, b_ids = (_lists(np.where(whole, pc.list_value_length(x), 0), pc.list_flatten(x.filter(same))) for x in (a_ids, b_ids))

    ends = _ends(a_ids, pair.a_bytes, "i").join(_ends(b_ids, pair.b_bytes, "j"), "end", join_type="full outer", use_threads=False)
    ends = ends.combine_chunks().sort_by("end")
    both = pc.and_(pc.is_valid(ends["i"]), pc.is_valid(ends["j"]))
    doc = pc.shift_right(ends["end"], 32).to_numpy()
    i, j = (pc.fill_null_backward(ends[c].combine_chunks()) for c in ("i", "j"))
    n_links = np.bincount(doc, minlength=len(texts))

    closed = both.to_numpy()
    n_groups = np.bincount(doc[closed], minlength=len(texts))
    sides = [pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], last.to_numpy()[closed] + 1)).astype(np.int32)),
                                                     ids.values.cast(pa.string())), ",") for last, ids in ((i, a_ids), (j, b_ids))]
    groups = pc.binary_join(_lists(n_groups, pc.binary_join_element_wise(*sides, "|")), ";")

    links = pa.table({"doc": doc, "a": a_ids.values.take(i), "b": b_ids.values.take(j)})
    pairs = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.combine_chunks().sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")])
    n_pairs = np.bincount(pairs["doc"].to_numpy(), minlength=len(texts))
    lists = [_lists(n_pairs, pairs[c].combine_chunks().cast(pa.int32())) for c in ("a", "b", "count_all")]
    counts = [pc.list_value_length(a_ids), pc.list_value_length(b_ids), pa.array(n_groups), pa.array(n_links)]
    return pa.record_batch([*(c.cast(pa.int64()) for c in counts), groups, *lists],
                           names=["n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "times"])


def _chunks(texts: list[str | None]):
    """(first, last + 1) of runs of texts of about CHUNK_BYTES characters."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_BYTES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups, a, b, times.

    ``groups`` lists the ids of each group as ``a1,a2|b1;a3|b2``.  ``a``, ``b`` and ``times`` are the
    distinct linked id pairs with the number of their links.  Texts that are null, empty or not given
    back byte for byte by both tokenizers have no tokens: zeros, no pairs and ''.  Null and repeated
    ids keep their rows, other columns take no part, an empty table gives no rows.  No shuffle.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        pair = _pair(bytes_path, pieces_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in _chunks(texts):
                out = align_chunk([t or "" for t in texts[start:stop]], pair)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *out.columns], names=["doc_id", *out.schema.names])

    return docs.mapInArrow(run, ALIGNED)


def _partial_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n): documents that link each pair, counted within each task."""
    def run(batches):
        held, size = [], 0

        def counted():
            table = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
            return table.combine_chunks()

        for batch in batches:
            a, b = (pc.list_flatten(batch.column(k)) for k in (0, 1))
            held.append(pa.table({"a": a, "b": b, "n": pa.array(np.ones(len(a), np.int64))}))
            size += len(a)
            if size >= FLUSH:
                held = [counted()]
                size = held[0].num_rows
                if size >= FLUSH // 2:
                    yield from held[0].to_batches(100_000)
                    held, size = [], 0
        if held:
            yield from counted().to_batches(100_000)

    return rows.select("a", "b").mapInArrow(run, "a int, b int, n bigint")


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


def link_counts(aligned: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum.

    A pair's count is the number of rows of the whole table that link it.  ``count_sum`` adds up the
    counts of a row's links; ``n_best`` is the number of its links whose count is the highest of
    all pairs with the same id of A, ties included.  Rows without links have zeros.  ``aligned`` is
    written once to the shared folder; ``head`` is the number of pairs that skip the shuffle.
    """
    spark = aligned.sparkSession
    own = [c for c in aligned.columns if c not in ("a", "b", "times")]
    place = f"{ensure_checkpoint_dir(spark)}/aligned-{uuid.uuid4().hex}"
    aligned.withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(place)
    rows = spark.read.parquet(place)

    counts = _partial_counts(rows).groupBy("a", "b").agg(F.sum("n").alias("n"))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = cut(counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")))
    first = counts.orderBy(F.desc("n"), "a", "b").limit(head).toArrow()
    keys = _key(*(first[c].to_numpy() for c in ("a", "b")))
    by = np.argsort(keys)
    keys, n, best = keys[by], first["n"].to_numpy()[by], first["best"].to_numpy()[by]

    def found(batch):
        a, b, times = (pc.list_flatten(batch.column(k)).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        wanted = _key(a, b)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1) if len(keys) else np.zeros(len(wanted), np.int64)
        inside = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
        parent = pc.list_parent_indices(batch.column(1)).to_numpy(zero_copy_only=False)
        return a, b, times.astype(np.int64), parent, at, inside

    def frequent(batches):
        for batch in batches:
            _, _, times, parent, at, inside = found(batch)
            parent, at, times = parent[inside], at[inside], times[inside]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], parent, times * best[at])
            np.add.at(sums[1], parent, times * n[at])
            yield pa.record_batch([batch.column(0), pa.array(sums[0]), pa.array(sums[1])], names=["_row", "_best", "_sum"])

    def others(batches):
        for batch in batches:
            a, b, times, parent, _, inside = found(batch)
            out = [batch.column(0).take(pa.array(parent[~inside])), *(pa.array(x[~inside]) for x in (a, b, times))]
            yield pa.record_batch(out, names=["_row", "a", "b", "times"])

    lists = rows.select("_row", "a", "b", "times")
    some = lists.mapInArrow(frequent, "_row bigint, _best bigint, _sum bigint")
    rest = (lists.mapInArrow(others, "_row bigint, a int, b int, times bigint").join(counts, ["a", "b"])
            .select("_row", F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("_best"), (F.col("times") * F.col("n")).alias("_sum")))
    sums = some.union(rest).groupBy("_row").agg(F.sum("_best").alias("n_best"), F.sum("_sum").alias("count_sum"))
    return rows.select("_row", *own).join(sums, "_row").drop("_row")
