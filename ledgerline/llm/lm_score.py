"""Language-model scores: a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are the lower-cased words of a text and one end token.  Every token has a
class: the most frequent words are classes of their own, all other words fall
into classes by their last three bytes, and the end is a class.  The model is

    log10 P(token | previous) = log10 P(class | previous class) + log10 P(token | class)

with a log-bilinear P(class | previous class): a context vector is mapped by a
matrix and multiplied with the target vectors, plus a target bias.  It is trained
in numpy with noise-contrastive estimation (noise: the class unigrams) on the
class-bigram counts of *all* training tokens, which are a sufficient statistic
for one word of context, and normalised by batched matrix products.

The number of classes has no cap: it grows with the sixth root of the training
tokens, ``growth`` words with a class of their own per unit of the root and a third as
many classes by ending, so the table of class bigrams grows with the cube root:
about 1,000 classes for 10^7 tokens, 10,000 for 10^13.  Inside a
class of many words, P(token | class) is ``(1 - u) * c / class count`` for known
words and ``u`` for the unknown one, where ``u`` is the share of words seen once.

Word counts that every text needs are exact.  The counts of the ``listed`` most
frequent words are broadcast (a fixed number); all other words meet their counts in
a shuffle by word.  The words with classes of their own are the most frequent of the
listed by exact counts, ties to the smaller hash.  A word of at least 1.5 / ``listed`` of
all training tokens is always listed; where such words are fewer than the classes (texts
without frequent words), the partitioning may decide on the last of them.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.stage import cut, small_batches
from ledgerline.llm.words import Words, mix, word_chunks

#: Words with a broadcast count; words with a class of their own for each unit of the sixth root of the training tokens.
LISTED, GROWTH = 131_072, 48.0


def held_out(doc_id: int | None, fold: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % fold == 0


def endings(w: Words, lex: Lexicon) -> np.ndarray:
    """Class of each word by its last three bytes."""
    key = np.zeros(len(w.start), np.uint64)
    for back in (1, 2, 3):
        at = w.end - back
        key = key * np.uint64(257) + np.where(at >= w.start, w.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return lex.own_classes + (mix(key) >> np.uint64(33)).astype(np.int64) % lex.endings


def text_prints(w: Words) -> np.ndarray:
    """40-bit fingerprint of each text; with the id it names a row."""
    acc = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(w.hash + np.arange(len(w.hash), dtype=np.uint64)
                                                                - np.repeat(w.first[:-1], np.diff(w.first)).astype(np.uint64)), dtype=np.uint64)))
    return ((acc[w.first[1:]] - acc[w.first[:-1]]) >> np.uint64(24)).astype(np.int64)


class Lexicon:
    """Listed words (sorted hashes) with their classes, of which there are as many as the training tokens ask for."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tokens: int, growth: float = GROWTH):
        self.own_classes = max(1, int(growth * max(tokens, 1) ** (1 / 6)))
        self.endings = max(1, self.own_classes // 3)
        self.end = self.own_classes + self.endings
        self.classes = self.end + 1
        by = np.argsort(hashes)
        self.hash, self.counts = hashes[by], counts[by]
        rank = np.empty(len(by), np.int64)
        rank[np.lexsort((self.hash, -self.counts))] = np.arange(len(by))
        self.own = np.where((rank < self.own_classes) & (self.counts > 0), rank, -1)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place in the list or -1, class) of each word."""
        cls = endings(w, self)
        if not len(self.hash):
            return np.full(len(cls), -1), cls
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        at = np.where(self.hash[at] == w.hash, at, -1)
        own = np.where(at >= 0, self.own[at], -1)
        return at, np.where(own >= 0, own, cls)


def _folds(batch, fold: int) -> np.ndarray:
    return np.array([held_out(i, fold) for i in batch.column(0).to_pylist()], bool)


def _listed(docs: DataFrame, fold: int) -> tuple[np.ndarray, int]:
    """Sorted hashes of the most frequent training words, and the number of training tokens, ends included."""
    def run(batches):
        total, ends, hashes, counts = 0, 0, [], []

        def packed():
            h, back = np.unique(np.concatenate(hashes), return_inverse=True)
            return h, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        for batch in batches:
            out = _folds(batch, fold)
            for row, stop, w in word_chunks(batch.column(1), lower=True):
                keep = np.repeat(~out[row:stop], np.diff(w.first))
                h, c = np.unique(w.hash[keep], return_counts=True)
                total, ends = total + int(keep.sum()), ends + int((~out[row:stop]).sum())
                hashes.append(h), counts.append(c)
                if sum(map(len, hashes)) > 2_000_000:
                    h, c = packed()
                    hashes, counts = [h], [c]
        if hashes:
            h, c = packed()
            often = c * LISTED >= total // 2  # any word that may be among the listed of this share of the texts
            yield pa.record_batch([pa.array(h[often].view(np.int64)), pa.array(c[often])], names=["h", "c"])
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([total + ends], pa.int64())], names=["h", "c"])

    rows = (docs.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
            .orderBy(F.col("h").isNotNull(), F.desc("c"), "h").limit(LISTED + 1).collect())
    found = np.array([r.h for r in rows if r.h is not None], np.int64).view(np.uint64)
    return np.sort(found), sum(r.c for r in rows if r.h is None)


def _exact(docs: DataFrame, hashes: np.ndarray, fold: int) -> np.ndarray:
    """Exact counts of the listed words in all training texts (a fixed number, tree-reduced)."""
    n = len(hashes)

    def run(batches):
        counts = np.zeros(n + 1, np.int64)
        for batch in batches:
            out = _folds(batch, fold)
            for row, stop, w in word_chunks(batch.column(1), lower=True):
                h = w.hash[np.repeat(~out[row:stop], np.diff(w.first))]
                at = np.searchsorted(hashes, h)
                at = np.where(hashes[np.minimum(at, n - 1)] == h, at, n) if n else np.full(len(h), n)
                counts += np.bincount(at, minlength=n + 1)
        yield pa.record_batch([pa.array([_pack(counts[:n])], pa.binary())], names=["counts"])

    def add(a: bytes, b: bytes) -> bytes:
        return _pack(_unpack(a) + _unpack(b)) if a and b else a or b

    total = docs.mapInArrow(run, "counts binary").rdd.map(lambda r: bytes(r[0])).treeAggregate(b"", add, add)
    return _unpack(total) if total else np.zeros(n, np.int64)


def _statistics(docs: DataFrame, lex: Lexicon, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Ending classes of the listed words, and exact counts of class bigrams over all training tokens.

    Tasks send the pairs they saw; these are summed by a shuffle, and only the sums (as many as the
    table has cells, at most) come to the driver.
    """
    size, n = lex.classes, len(lex.hash)

    def run(batches):
        cells, counts, ending = [], [], np.full(n + 1, -1, np.int64)

        def packed():
            if not cells:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            cell, back = np.unique(np.concatenate(cells), return_inverse=True)
            return cell, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        for batch in batches:
            out = _folds(batch, fold)
            for row, stop, w in word_chunks(batch.column(1), lower=True):
                train = ~out[row:stop]
                at, cls = lex.find(w)
                keep = np.repeat(train, np.diff(w.first))
                ending[at] = endings(w, lex)
                seen = np.concatenate((_before(cls, w, lex.end)[keep] * size + cls[keep], _last(cls, w, lex.end)[train] * size + lex.end))
                cell, count = np.unique(seen, return_counts=True)
                cells.append(cell), counts.append(count)
                if sum(map(len, cells)) > 2_000_000:
                    cell, count = packed()
                    cells, counts = [cell], [count]
        cell, count = packed()
        known = np.flatnonzero(ending[:n] >= 0)
        # a listed word has one ending class: it is told by a negative cell
        yield pa.record_batch([pa.array(np.concatenate((cell, -1 - known))), pa.array(np.concatenate((count, ending[known]))),
                               pa.array(np.arange(len(cell) + len(known)) >= len(cell))], names=["cell", "n", "listed"])

    rows = docs.mapInArrow(run, "cell bigint, n bigint, listed boolean").groupBy("cell").agg(
        F.when(F.first("listed"), F.max("n")).otherwise(F.sum("n")).alias("n")).toArrow()
    cell, count = (rows.column(c).to_numpy() for c in ("cell", "n"))
    pairs, ending = np.zeros(size * size, np.int64), np.full(n, lex.own_classes, np.int64)
    pairs[cell[cell >= 0]] = count[cell >= 0]
    ending[-1 - cell[cell < 0]] = count[cell < 0]
    return ending, pairs.reshape(size, size)


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype(np.int64).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), np.int64)


def _before(cls: np.ndarray, w: Words, end: int) -> np.ndarray:
    """Class of the token before each word; the start of a text counts as an end."""
    out = np.empty(len(cls), np.int64)
    out[1:] = cls[:-1]
    out[w.first[:-1][w.first[:-1] < w.first[1:]]] = end
    return out


def _last(cls: np.ndarray, w: Words, end: int) -> np.ndarray:
    """Class of the last word of each text (the end's: none)."""
    full = w.first[1:] > w.first[:-1]
    return np.where(full, cls[np.maximum(w.first[1:] - 1, 0)] if len(cls) else end, end)


def train(pairs: np.ndarray, dims: int = 32, noise: int = 20, steps: int = 250, rate: float = 0.05, prior: float = 100.0,
          seed: int = 7) -> np.ndarray:
    """log10 P(class | previous class), normalised: rows are contexts.

    Each step takes the noise-contrastive gradient of all class bigrams at once: observed
    pairs against ``noise`` draws from the unigrams per observation, in expectation.  Every context
    has ``prior`` observations from the unigrams besides its own, so rare contexts stay near them.
    """
    size = len(pairs)
    rng = np.random.default_rng(seed)
    seen = pairs.astype(np.float32)
    unigram = (seen.sum(0) + 0.5) / (seen.sum() + 0.5 * size)
    seen = seen + np.float32(prior) * unigram[None, :]
    total = float(seen.sum())
    fake = (noise * seen.sum(1)[:, None] * unigram[None, :] / total).astype(np.float32)
    real = seen / total
    offset = np.log(noise * unigram).astype(np.float32)
    params = [rng.normal(0, 0.1, (size, dims)).astype(np.float32), np.eye(dims, dtype=np.float32),
              rng.normal(0, 0.1, (size, dims)).astype(np.float32), np.log(unigram).astype(np.float32)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        context, bridge, target, bias = params
        hidden = context @ bridge
        margin = np.clip(hidden @ target.T + bias - offset, -30, 30)
        sigma = 1 / (1 + np.exp(-margin))
        grad = real - (real + fake) * sigma
        back = grad @ target
        grads = [back @ bridge.T, context.T @ back, grad.T @ hidden, grad.sum(0)]
        pace = rate * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    context, bridge, target, bias = params
    out = np.empty((size, size), np.float32)
    for at in range(0, size, 256):
        s = ((context[at:at + 256] @ bridge) @ target.T + bias).astype(np.float64)
        s -= s.max(1, keepdims=True)
        out[at:at + 256] = (s - np.log(np.exp(s).sum(1, keepdims=True))) / math.log(10)
    return out


def _documents(docs: DataFrame, lex: Lexicon, ending: np.ndarray, table: np.ndarray,
               class_counts: np.ndarray, end_count: int, fold: int) -> DataFrame:
    """Per row: what its listed words and its end add to the sums."""
    own, counts = lex.own >= 0, lex.counts
    base_of = np.append(np.log10(counts + 0.1), 0.0)
    inner = np.append(np.where(own, 0.0, np.log10(np.maximum(counts, 1) / np.maximum(class_counts[ending], 1))), 0.0)
    shared = np.append((~own).astype(np.float64), 0.0)
    end_base = math.log10(end_count + 0.1)
    names = ["doc_id", "print", "held_out", "n_tokens", "known", "base", "lm", "inside"]

    def run(batches):
        for batch in batches:
            out = _folds(batch, fold)
            cols: list[list] = [[] for _ in range(6)]
            for _, _, w in word_chunks(batch.column(1), lower=True):
                at, cls = lex.find(w)
                size = np.diff(w.first)
                doc = np.repeat(np.arange(len(size)), size)
                per = lambda x: np.bincount(doc, x, minlength=len(size))
                lm = per(table[_before(cls, w, lex.end), cls].astype(np.float64) + inner[at]) + table[_last(cls, w, lex.end), lex.end]
                for c, x in zip(cols, (text_prints(w), size + 1, per((at >= 0).astype(float)) + (end_count > 0), per(base_of[at]) + end_base, lm, per(shared[at]))):
                    c.append(x)
            arrays = [np.concatenate(c) if c else np.empty(0) for c in cols]
            kinds = (np.int64, np.int64, np.int64, np.float64, np.float64, np.float64)
            arrays = [pa.array(a.astype(k)) for a, k in zip(arrays, kinds)]
            yield pa.record_batch([batch.column(0), arrays[0], pa.array(out), *arrays[1:]], names=names)

    return docs.mapInArrow(run, "doc_id bigint, print bigint, held_out boolean, n_tokens bigint, known bigint, base double, lm double, inside double")


def _rare(docs: DataFrame, lex: Lexicon, fold: int) -> DataFrame:
    """(h, doc_id, print, tf, cls, train): the words of each row that are not listed."""
    names = ["h", "doc_id", "print", "tf", "cls", "train"]

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), _folds(batch, fold)
            for row, stop, w in word_chunks(batch.column(1), lower=True):
                at, cls = lex.find(w)
                rare = np.flatnonzero(at < 0)
                doc = np.repeat(np.arange(stop - row), np.diff(w.first))[rare]
                h = w.hash[rare]
                by = np.lexsort((h, doc))
                doc, h, cls = doc[by], h[by], cls[rare][by]
                if not len(h):
                    continue
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                tf = np.diff(np.append(first, len(h)))
                d = doc[first]
                yield pa.record_batch([pa.array(h[first].view(np.int64)), ids.take(pa.array(row + d)), pa.array(text_prints(w)[d]),
                                       pa.array(tf.astype(np.int32)), pa.array(cls[first].astype(np.int32)), pa.array(~out[row + d])], names=names)

    return docs.mapInArrow(run, "h bigint, doc_id bigint, print bigint, tf int, cls int, train boolean")


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 10, growth: float = GROWTH) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) mod ``fold`` is 0 are held out; all others, also those
    with a null id, are learned from.  ``base_score`` is the add-0.1 unigram score, ``score``
    the model's log10 probability.  Null, empty and word-less texts have the end token only.
    Repeated rows each count in training and each come back.  With no training row at all
    the base score is that of the bare formula.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    hashes, tokens = _listed(docs, fold)
    lex = Lexicon(hashes, _exact(docs, hashes, fold), tokens, growth)
    ending, pairs = _statistics(docs, lex, fold)
    class_counts, end_count = pairs.sum(0), int(pairs[:, lex.end].sum())
    table = train(pairs)
    by_ending = class_counts[lex.own_classes:lex.end]

    shares = F.array(*[F.lit(float(math.log10(max(1, x)))) for x in by_ending])
    word = Window.partitionBy("h")
    rare = (_rare(docs, lex, fold)
            .withColumn("c", F.sum(F.when(F.col("train"), F.col("tf"))).over(word))
            .withColumn("c", F.coalesce("c", F.lit(0)))
            .withColumn("first", F.row_number().over(word.orderBy("doc_id", "print")) == 1))
    known = F.col("c") > 0
    sums = cut(rare.groupBy("doc_id", "print").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 0.1)).alias("r_base"),
        F.sum(F.col("tf").cast("bigint")).alias("r_all"),
        F.sum(F.when(known, F.col("tf")).otherwise(0)).alias("r_known"),
        F.sum(F.when(known, F.col("tf") * (F.log10("c") - F.element_at(shares, F.col("cls") - lex.own_classes + 1))).otherwise(0.0)).alias("r_lm"),
        F.count_if(F.col("first") & known).alias("v"),
        F.count_if(F.col("first") & (F.col("c") == 1)).alias("once")))
    v, once = sums.agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("once"), F.lit(0))).first()
    types = int((lex.counts > 0).sum()) + int(v) + (end_count > 0)
    once = int(once) + int(((lex.counts == 1) & (lex.own < 0)).sum())
    unseen = (once + 1) / (int(by_ending.sum()) + 2)
    log_total = math.log10(tokens + 0.1 * (types + 1))

    rows = _documents(docs, lex, ending, table, class_counts, end_count, fold)
    both = rows.alias("d").join(sums.alias("r"), F.expr("d.doc_id <=> r.doc_id and d.print = r.print"), "left").select(
        "d.*", *[F.coalesce(F.col(f"r.{c}"), F.lit(0)).alias(c) for c in ("r_base", "r_all", "r_known", "r_lm")])
    same = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "print"))  # repeated rows share their sums
    both = both.withColumn("same", same)
    part = lambda c: F.col(c) / F.col("same")
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + part("r_known").cast("bigint")).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + part("r_base") - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("lm") + part("r_lm") + (F.col("inside") + part("r_known")) * math.log10(1 - unseen)
         + part("r_all") * math.log10(unseen) - part("r_known") * math.log10(unseen)).alias("score"))
