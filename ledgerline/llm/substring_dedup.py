"""Substring deduplication by relative Lempel-Ziv factors.

The reference of a document is every document with a smaller id; all of them are
indexed.  The index holds word windows of ``span`` words, each under its hash
with its first place (smallest id, then position).  A document is factored
greedily from left to right: a factor starts at the first window the reference
holds and goes on while the following windows lie next to each other at the same
place of the reference.  Where a factor ends, the window across the boundary is
looked up by itself and may open the next factor.  Factors are at least ``span``
words long, so their union is exactly the set of words covered by a repeated window.

Looking up every window would move the whole corpus as hashes.  Each window is
therefore named after its least ``SEED``-word hash (a minimizer): equal windows
have equal names, names are some thirty times fewer, and only windows whose name
occurs in two documents are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import bitmap
from ledgerline.llm.stage import cut, small_batches
from ledgerline.llm.words import Words, mix, window_hashes, word_chunks

SEED = 16
PRINT_BITS = 15
POS_BITS = 40


def sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    if len(g) < width:
        return g[:0]
    low, k = g, 1
    while 2 * k <= width:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    rest = width - k
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def prints(w: Words) -> np.ndarray:
    """A small fingerprint of each text: tells apart texts that share an id."""
    acc = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(w.hash), dtype=np.uint64)))
    return ((acc[w.first[1:]] - acc[w.first[:-1]]) >> np.uint64(64 - PRINT_BITS)).astype(np.int64)


def _windows(batch, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(id, packed print and position, window hash, window name) of every window of a batch of (doc_id, text)."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for row, stop, w in word_chunks(batch.column(1)):
        full = window_hashes(w.hash, span)
        if not len(full):
            continue
        seed = min(SEED, span)
        name = sliding_min(window_hashes(w.hash, seed), span - seed + 1)
        doc = np.repeat(np.arange(stop - row), np.diff(w.first))[:len(full)]
        inside = np.arange(len(full)) + span <= w.first[1:][doc]
        doc = doc[inside]
        pos = np.flatnonzero(inside) - w.first[doc]
        yield ids[row + doc], (prints(w)[doc] << POS_BITS) | pos, full[inside], name[inside]


def _names(docs: DataFrame, span: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for ids, _, _, name in _windows(batch, span):
                new = np.ones(len(name), bool)
                new[1:] = (name[1:] != name[:-1]) | (ids[1:] != ids[:-1])
                yield pa.record_batch([pa.array(name[new].view(np.int64)), pa.array(ids[new])], names=["name", "doc_id"])

    return docs.mapInArrow(run, "name bigint, doc_id bigint")


def _candidates(docs: DataFrame, span: int, shared: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            for ids, at, full, name in _windows(batch, span):
                hit = bitmap.test(shared, name.view(np.int64))
                if hit.any():
                    yield pa.record_batch([pa.array(full[hit].view(np.int64)), pa.array(ids[hit]), pa.array(at[hit])],
                                          names=["h", "doc_id", "at"])

    return docs.mapInArrow(run, "h bigint, doc_id bigint, at bigint")


def _first_places(batches):
    """Of windows sorted by (hash, doc, place): those of later documents, once each, with the first place.  State: two rows."""
    held = None  # the first place of the hash at hand, and the row before
    for batch in batches:
        h, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if held is not None:
            h, doc, at = (np.concatenate((x, y)) for x, y in zip(held, (h, doc, at)))
        if not len(h):
            continue
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        hit = doc > doc[lead]
        hit[1:] &= new[1:] | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])  # repeated rows have one place
        hit[:0 if held is None else 2] = False
        held = tuple(x[[lead[-1], len(x) - 1]] for x in (h, doc, at))
        if hit.any():
            src = lead[hit]
            yield pa.record_batch([pa.array(doc[hit]), pa.array(at[hit]), pa.array(doc[src]), pa.array(at[src])],
                                  names=["doc_id", "at", "src_doc", "src_at"])


FACTOR = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "src_doc", "src_start")])
RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("factors", T.ArrayType(FACTOR)), T.StructField("kept_text", T.StringType())])


def _parse(places: list[dict] | None, span: int) -> list[dict]:
    """Greedy factors from the looked-up windows of one document."""
    out: list[dict] = []
    mask = (1 << POS_BITS) - 1
    last = None
    for p in sorted(places or (), key=lambda x: x["at"]):
        pos, src, q = p["at"] & mask, p["src_doc"], p["src_at"] & mask
        if last is not None and pos == last[0] + 1 and src == last[1] and p["src_at"] == last[2] + 1:
            out[-1]["length"] += 1
        else:
            out.append({"start": pos, "length": span, "src_doc": src, "src_start": q})
        last = (pos, src, p["src_at"])
    return out


def _cutter(span: int, unmarked_only: np.ndarray | None):
    """Texts without their factors; with a bitmap: only documents that are surely not in it."""
    def run(batches):
        for batch in batches:
            if unmarked_only is not None:
                ids = batch.column(0)
                clean = ~(np.asarray(ids.is_valid()) & bitmap.test(unmarked_only, ids.fill_null(0).to_numpy(zero_copy_only=False)))
                batch = batch.filter(pa.array(clean))
                places = [None] * batch.num_rows
            else:
                places = batch.column(2).to_pylist()
            if not batch.num_rows:
                continue
            total, gone, factors, kept = [], [], [], []
            for row, stop, w in word_chunks(batch.column(1)):
                data = w.data.tobytes()
                for d in range(stop - row):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    own = _parse(places[row + d], span)
                    drop = np.zeros(b - a, bool)
                    for f in own:
                        drop[f["start"]:f["start"] + f["length"]] = True
                    stay = (np.flatnonzero(~drop) + a).tolist()
                    total.append(b - a), gone.append(b - a - len(stay)), factors.append(own)
                    start, end = w.start, w.end
                    if len(stay) == b - a:
                        kept.append(b" ".join(data[w.bounds[d]:w.bounds[d + 1]].split()))  # split() cuts at the same six bytes
                    else:
                        kept.append(b" ".join(data[start[i]:end[i]] for i in stay))
            yield pa.record_batch([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                   pa.array(factors, pa.list_(pa.struct([(n, pa.int64()) for n in FACTOR.names]))),
                                   pa.array(kept, pa.binary()).cast(pa.string())], names=RESULT.names)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, factors, kept_text) per row of ``docs``.

    ``factors`` lists the greedy factors (start, length, src_doc, src_start; in words) of
    the document against all documents with smaller ids; ``kept_text`` has the words
    outside them, joined by one space.  A null, empty or short text has no factor.  Rows
    that share an id never count as each other's reference; rows with a null id are
    neither cut nor a reference.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    known = docs.where("doc_id is not null")
    names = _names(known, span).groupBy("name").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"))
    shared = bitmap.build(names.where("d0 < d1").select("name"))
    found = (_candidates(known, span, shared).repartition("h").sortWithinPartitions("h", "doc_id", "at")
             .mapInArrow(_first_places, "doc_id bigint, at bigint, src_doc bigint, src_at bigint"))
    places = cut(found.withColumn("print", F.shiftright("at", POS_BITS)).groupBy("doc_id", "print")
                 .agg(F.collect_list(F.struct("at", "src_doc", "src_at")).alias("places")))
    marked = bitmap.build(places.select("doc_id"))
    clean = docs.mapInArrow(_cutter(span, marked), RESULT)
    texts = bitmap.keep_rows(docs, "doc_id", marked).mapInArrow(_with_print, "doc_id bigint, text string, print bigint")
    dirty = texts.join(places, ["doc_id", "print"], "left").select("doc_id", "text", "places").mapInArrow(_cutter(span, None), RESULT)
    return clean.union(dirty)


def _with_print(batches):
    for batch in batches:
        own = [prints(w) for _, _, w in word_chunks(batch.column(1))]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.concatenate(own) if own else [], pa.int64())],
                              names=["doc_id", "text", "print"])
