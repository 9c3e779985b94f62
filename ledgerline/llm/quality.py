"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are the shapes of its words (case, last character, length, whether the
word repeats the one before), pairs of neighbouring shapes and hashed words.  Counts
are damped, weighted by rarity among the labelled texts and reduced to ``dims`` latent
dimensions by a randomised singular value decomposition.  The labelled vectors (at most
``sample`` rows, a documented bound) are broadcast; every text is compared with all of
them in blocked cosine products, and its ``neighbours`` nearest vote with their similarity.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.stage import small_batches
from ledgerline.llm.words import Words, mix, word_chunks

#: Last characters that have a class of their own.
LAST = ".,;:!?*#$%&|-)\"'"
SHAPES, PAIRS, HASHED = 2 * 4 * 24 * 4, 2048, 1024
TERMS = SHAPES + PAIRS + HASHED


def _shapes(w: Words) -> np.ndarray:
    """Shape number of each word."""
    data, start, end = w.data, w.start, w.end
    low = np.concatenate(([0], np.cumsum((data >= 97) & (data <= 122) | (data >= 128))))
    up = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    lows, ups = low[end] - low[start], up[end] - up[start]
    case = np.where(ups == 0, np.where(lows > 0, 0, 3), np.where((ups > 1) & (lows <= 2), 2, 1))
    kind = np.full(256, 1)
    kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
    kind[48:58] = 2
    for i, c in enumerate(LAST):
        kind[ord(c)] = 3 + i
    last = kind[data[end - 1]]
    again = np.zeros(len(start), np.int64)
    again[1:] = w.hash[1:] == w.hash[:-1]
    again[w.first[:-1][w.first[:-1] < len(start)]] = 0
    size = np.minimum((end - start) // 5, 3)
    return ((again * 4 + case) * 24 + last) * 4 + size


def term_counts(texts: pa.Array):
    """(first row, last row + 1, matrix of term counts) for runs of whole texts."""
    for row, stop, w in word_chunks(texts, limit=250_000):
        n = stop - row
        shape = _shapes(w) if len(w.start) else np.empty(0, np.int64)
        doc = np.repeat(np.arange(n), np.diff(w.first))
        pair = mix((shape[:-1] * 1009 + shape[1:]).astype(np.uint64)) % np.uint64(PAIRS)
        same = doc[1:] == doc[:-1]
        terms = np.concatenate((shape, SHAPES + pair[same].astype(np.int64), SHAPES + PAIRS + (w.hash % np.uint64(HASHED)).astype(np.int64)))
        docs = np.concatenate((doc, doc[1:][same], doc))
        yield row, stop, np.bincount(docs * TERMS + terms, minlength=n * TERMS).reshape(n, TERMS)


class Model:
    """Term weights, latent basis and labelled latent vectors of length one."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dims: int, seed: int = 3):
        self.labels = labels.astype(np.float32)
        n = len(counts)
        self.weight = np.log((1 + n) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        x = self.weigh(counts)
        rng = np.random.default_rng(seed)
        q = rng.normal(size=(TERMS, min(dims + 16, max(1, n)))).astype(np.float32)
        for _ in range(4):
            q = np.linalg.qr(x.T @ (x @ q))[0] if n else q
        u, s, vt = np.linalg.svd(x @ q, full_matrices=False) if n else (None, None, np.eye(q.shape[1], dtype=np.float32))
        self.basis = np.ascontiguousarray((q @ vt.T)[:, :dims])
        self.vectors = self.project(x)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        return (np.sqrt(share) * self.weight).astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        v = x @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray, neighbours: int) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; 0.5 without any.

        A text without terms has no neighbours: it gets the share of label 1 among all labelled vectors.
        """
        out = np.full(len(counts), 0.5)
        if not len(self.labels):
            return out
        k = min(neighbours, len(self.labels))
        for at in range(0, len(counts), 256):
            near = self.project(self.weigh(counts[at:at + 256])) @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(near, top, 1), 1e-6).astype(np.float64) ** 8
            out[at:at + 256] = (w * self.labels[top]).sum(1) / w.sum(1)
        out[~counts.any(1)] = self.labels.mean(dtype=np.float64)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fold: int = 5, sample: int = 4000, dims: int = 48) -> Model:
    """Model from at most ``sample`` labelled rows (a stable choice by hash of the id) whose crc32(id as text) mod ``fold`` is not 0.

    Labels other than 0 and 1 and rows without an id are left out; an id labelled twice takes the larger label,
    and one with several texts the smallest.
    """
    small_batches(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("bigint").alias("i"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("i").isNotNull() & F.col("y").isin(0, 1)).groupBy("i").agg(F.max("y").alias("y"))
             .where(F.crc32(F.col("i").cast("string").cast("binary")) % fold != 0))
    chosen = known.orderBy(F.xxhash64("i"), "i").limit(sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(chosen), "i").groupBy("i", "y").agg(F.min("t").alias("t")).select("t", "y")

    def run(batches):
        for batch in batches:
            ys = batch.column(1).to_pylist()
            for row, stop, counts in term_counts(batch.column(0)):
                sparse = [np.flatnonzero(c) for c in counts]
                yield pa.record_batch([pa.array(ys[row:stop], pa.int32()), pa.array([i.astype(np.uint16).tobytes() for i in sparse], pa.binary()),
                                       pa.array([c[i].astype(np.float32).tobytes() for c, i in zip(counts, sparse)], pa.binary())], names=["y", "terms", "counts"])

    rows = sorted(texts.mapInArrow(run, "y int, terms binary, counts binary").toLocalIterator(), key=lambda r: (r.y, bytes(r.terms), bytes(r.counts)))
    x = np.zeros((len(rows), TERMS), np.float32)
    for at, r in enumerate(rows):
        x[at, np.frombuffer(r.terms, np.uint16)] = np.frombuffer(r.counts, np.float32)
    return Model(x, np.array([r.y for r in rows]), dims)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score",
          held_col: str = "held_out", neighbours: int = 25, fold: int = 5) -> DataFrame:
    """``docs`` with ``held_col`` and ``score_col`` (0 to 1; higher: label 1 is likelier) for every whole text.

    Null, empty and word-less texts get the share of label 1 among the labelled texts.  A null id is not held out.
    Repeated rows come back as they are; the new names must differ from the old ones.
    """
    small_batches(docs.sparkSession)
    at, ids = docs.columns.index(text_col), docs.columns.index(id_col)

    def run(batches):
        for batch in batches:
            found = [model.scores(counts, neighbours) for _, _, counts in term_counts(batch.column(at).cast(pa.string()))]
            held = [i is not None and zlib.crc32(str(i).encode()) % fold == 0 for i in batch.column(ids).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(held, pa.bool_()), pa.array(np.concatenate(found) if found else [], pa.float64())],
                                  names=[*batch.schema.names, held_col, score_col])

    schema = docs.schema
    return docs.mapInArrow(run, type(schema)([*schema.fields]).add(held_col, "boolean").add(score_col, "double"))
