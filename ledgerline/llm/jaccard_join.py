"""N-gram Jaccard join with token-combination prefixes.

Each text is a set of word-shingle hashes.  All sets are sorted by one global
order (rare shingles first, then frequent ones by rising frequency).  With
``e = n - ceil(t * n)`` shingles that a partner may lack, two sets of similarity
``t`` share a signature if the prefix of each holds signatures that ``e`` misses
cannot all destroy:

* a rare shingle is a signature by itself and costs one miss;
* frequent shingles are dealt into classes by hash, and the *pairs* of a class
  are signatures; ``c`` shingles of a class cost ``c - 1`` misses, so the prefix is
  extended by one shingle for each class it uses.  The number of classes follows
  the size band of the set, so signatures stay about linear in the set's size; a
  set is indexed under its own band and the next, which covers every partner.

Frequency comes from a count sketch of all distinct shingles of all documents
(fixed 16 MB, tree-reduced).  It only shapes the order: any order gives the same
links, and every candidate is verified exactly.

Links are never expanded within a group.  Equal sets collapse first.  Each
signature pairs its members with a few hubs (those that share most signatures with
others, so the middle of a group of copies); after
components are known, only pairs of members that still lie in *different*
components are counted, so no link that could join two components is lost.  These meet in
cells: a signature's members are dealt into blocks of bounded size by hash, a cell is a pair of
blocks, and pairs are tested inside the task before a row of theirs is written.  Signatures
with the same first member share their cells, so a task meets most signatures of a pair and
writes one row with their number.

Before the sets of a pair are fetched, three bounds that every link meets are
applied: on the sizes, on the number of shared signatures and on the difference of
two small parity bitmaps, which never exceeds that of the sets.  Up to the lesser of
the two prefix ends, every shared rare shingle is a shared signature, and ``s`` shared
shingles of a class make at least ``s - 1`` shared pairs; the shingle lost per class is
the one by which the prefix was extended.  So the intersection is at most the number of
shared signatures plus what lies behind an unextended prefix.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import bitmap
from ledgerline.llm.graph import components
from ledgerline.llm.stage import cut, free_name, small_batches
from ledgerline.llm.words import mix, window_hashes, word_chunks

SKETCH_BITS = 22
BAND = math.log(1.25)
PARITY = [f"p{i}" for i in range(8)]
FOLDED = [f"f{i}" for i in range(4)]
SIGS = ["sig", "key", "size", "band"]
#: Members of a signature that one cell pairs with as many others at most (about: blocks are dealt by hash).
BLOCK = 256
#: Pairs that a task holds while it counts their signatures.
PAIRS = 400_000
SIG_ROWS = "sig bigint, key bigint, size int, band int"


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text; fewer than ``n`` words: the whole sequence as one."""
    for row, stop, w in word_chunks(texts, lower=True):
        grams = window_hashes(w.hash, n)
        first = w.first
        for d in range(stop - row):
            a, b = first[d], first[d + 1]
            if b - a >= n:
                yield row + d, np.unique(grams[a:b - n + 1])
            elif b > a:
                yield row + d, window_hashes(w.hash[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield row + d, np.empty(0, np.uint64)


def set_keys(h: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set, equal for equal sets."""
    a = int(mix(h).sum(dtype=np.uint64))
    b = int(mix(h ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64))
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def parity(h: np.ndarray) -> np.ndarray:
    """512 bits: whether an odd number of shingles falls into each slot."""
    odd = (np.bincount((mix(h) >> np.uint64(55)).astype(np.int64), minlength=512) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def needed(n: int, num: int, den: int) -> int:
    """Misses plus one: how much capacity a prefix of a set of ``n`` must have."""
    return n + (-num * n // den) + 1


def signatures(h: np.ndarray, level: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature hashes of one set (sorted ``h``) with their bands (0: rare shingles); ``level`` is 0 for rare counters."""
    n = len(h)
    if n < 2:  # a partner of a single shingle has the same set
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    need = needed(n, num, den)
    lev = level[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    rare = h[lev == 0]
    if len(rare) >= need:
        return rare[:need], np.zeros(need, np.int32)
    often = h[lev > 0]
    often = often[np.lexsort((often, lev[lev > 0]))]
    out, bands = [rare], [np.zeros(len(rare), np.int32)]
    own = 1 + int(math.log(n) / BAND)
    for band in (own, own + 1):
        m = max(1, int(1.25 ** (band - 1)) // 16)
        cls = ((often >> np.uint64(9)) % np.uint64(m)).astype(np.int64)
        new = np.zeros(len(often), np.int64)
        new[np.unique(cls, return_index=True)[1]] = 1
        size = int(np.searchsorted(np.cumsum(1 - new), need - len(rare))) + 1
        cls, tok = cls[:size], often[:size]
        by = np.lexsort((tok, cls))
        cls, tok = cls[by], tok[by]
        gap = 1
        while gap < len(tok):
            same = np.flatnonzero(cls[gap:] == cls[:-gap])
            if not len(same):
                break
            out.append(mix(tok[same] * np.uint64(0x9E6C63D0676A9A99) + tok[same + gap] + np.uint64(band)))
            bands.append(np.full(len(same), band, np.int32))
            gap += 1
    return np.concatenate(out), np.concatenate(bands)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _scan(docs: DataFrame, n: int) -> DataFrame:
    """One row (doc_id, n, k1, k2, parity bits) per document and, per task, a row with its compressed counters."""
    names = ["doc_id", "n", "k1", "k2", *PARITY, "counts"]
    schema = ", ".join(f"{x} bigint" for x in names[:-1]) + ", counts binary"

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            own = np.zeros((batch.num_rows, 3 + len(PARITY)), np.int64)
            for row, h in shingle_sets(batch.column(1), n):
                own[row] = (len(h), *set_keys(h), *parity(h))
                np.add.at(counts, (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            yield pa.record_batch([batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in own.T], pa.nulls(len(own), pa.binary())], names=names)
        yield pa.record_batch([pa.nulls(1, pa.int64())] * (len(names) - 1) + [pa.array([zlib.compress(counts, 1)], pa.binary())], names=names)

    return docs.mapInArrow(run, schema)


def _levels(sketches: DataFrame) -> np.ndarray:
    """Frequency level of each counter, from the tree-reduced sum of all tasks' counters (fixed size)."""
    def add(a: bytes, b: bytes) -> bytes:
        if not a or not b:
            return a or b
        x, y = (np.frombuffer(zlib.decompress(z), np.uint32) for z in (a, b))
        both = x + y
        both[both < x] = 0xFFFFFFFF  # counters stay full
        return zlib.compress(both, 1)

    total = sketches.rdd.map(lambda r: bytes(r[0])).treeAggregate(b"", add, add)
    if not total:
        return np.zeros(1 << SKETCH_BITS, np.uint8)
    counts = np.frombuffer(zlib.decompress(total), np.uint32).astype(np.float64)
    mean = counts.mean()
    bar = mean + 6 * math.sqrt(mean) + 8
    return np.where(counts > bar, 1 + np.floor(np.log2(np.maximum(counts / bar, 1))), 0).astype(np.uint8)


def _signature_rows(docs: DataFrame, n: int, num: int, den: int, level: np.ndarray) -> DataFrame:
    """(sig, key, size, band): the signatures of every document under the key and size of its set."""
    def packed(cols):
        return pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=SIGS)

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in SIGS]
            for _, h in shingle_sets(batch.column(1), n):
                s, bands = signatures(h, level, num, den)
                for col, x in zip(cols, (_signed(s), np.full(len(s), set_keys(h)[0], np.int64), np.full(len(s), len(h), np.int32), bands)):
                    col.append(x)
                if len(cols[0]) >= 512:
                    yield packed(cols)
                    cols = [[] for _ in SIGS]
            if cols[0]:
                yield packed(cols)

    return docs.where("doc_id is not null").mapInArrow(run, SIG_ROWS)


def _live(batches):
    """Of rows sorted by (sig, key), the distinct ones whose signature has at least two keys; one row of state."""
    held = None  # last distinct row so far, and whether it has been given out
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)] + [np.zeros(batch.num_rows, bool)]
        if held is not None:
            cols = [np.concatenate((np.array([x], y.dtype), y)) for x, y in zip(held, cols)]
        sig, key = cols[:2]
        if not len(sig):
            continue
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        cols = [c[fresh] for c in cols]
        sig, out = cols[0], cols[4]
        twin = np.zeros(len(sig), bool)
        twin[1:] = sig[1:] == sig[:-1]
        twin[:-1] |= twin[1:]
        give = twin & ~out
        held = [c[-1] for c in cols[:4]] + [bool(out[-1] or give[-1])]
        if give.any():
            yield pa.record_batch([pa.array(c[give]) for c in cols[:4]], names=SIGS)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows, k1, k2, sets, held = [], [], [], [], 0
            for row, h in shingle_sets(batch.column(1), n):
                a, b = set_keys(h)
                rows.append(row), k1.append(a), k2.append(b), sets.append(_signed(h))
                held += len(h)
                if held > 2_000_000:
                    yield _set_batch(batch, rows, k1, k2, sets)
                    rows, k1, k2, sets, held = [], [], [], [], 0
            if rows:
                yield _set_batch(batch, rows, k1, k2, sets)

    return docs.mapInArrow(run, "rep bigint, key bigint, k2 bigint, shingles array<bigint>")


def _set_batch(batch, rows, k1, k2, sets):
    ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
    return pa.record_batch([batch.column(0).take(pa.array(rows)), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), flat],
                           names=["rep", "key", "k2", "shingles"])


def _sizes_fit(num: int, den: int):
    return F.least("na", "nb") * den >= F.greatest("na", "nb") * num


def _own_band():
    """Pairs of frequent shingles count in the band of the larger set only."""
    return (F.col("band") == 0) | (F.col("band") == 1 + F.floor(F.log(F.greatest("na", "nb")) / F.lit(BAND)))


def _enough_shared(num: int, den: int):
    """Whether ``shared`` signatures leave room for a link."""
    behind = F.ceil(F.greatest("na", "nb") * num / F.lit(den)) - 1
    overlap = F.ceil((F.col("na") + F.col("nb")) * num / F.lit(num + den))
    return F.col("shared") + behind >= overlap


def _bits_fit(names: list[str], num: int, den: int):
    """Sets differ in at least as many shingles as their parity bitmaps in bits."""
    differ = sum((F.bit_count(F.col(f"x{p}").bitwiseXOR(F.col(f"y{p}"))) for p in names), F.lit(0))
    both = F.col("na") + F.col("nb")
    return differ <= both - 2 * F.ceil(both * num / F.lit(num + den))


def _alike(pairs: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b, na, nb, ...) whose parity bitmaps leave room for a link."""
    x = bits.select(F.col("key").alias("a"), *[F.col(p).alias(f"x{p}") for p in PARITY])
    y = bits.select(F.col("key").alias("b"), *[F.col(p).alias(f"y{p}") for p in PARITY])
    return pairs.join(x, "a").join(y, "b").where(_bits_fit(PARITY, num, den)).select(pairs.columns).distinct()


def _in_cells(rest: DataFrame) -> DataFrame:
    """``rest`` (with ``anchor`` and ``blocks``) once for each cell of its block, in the order of the cells."""
    own = rest.withColumn("own", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("anchor", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "sig", "own",
                         *[c for c in rest.columns if c not in ("anchor", "blocks", "sig")])
    return cells.repartition("anchor", "lo", "hi").sortWithinPartitions("anchor", "lo", "hi", "sig")


def _cell_pairs(cell: dict[str, np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of a cell that may link: other components, sizes, bands and folded parity bits fit."""
    own, size, comp = cell["own"], cell["size"].astype(np.int64), cell["comp"]
    lo, hi = cell["lo"][0], cell["hi"][0]
    x, y = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    big, small = np.maximum(size[x][:, None], size[y]), np.minimum(size[x][:, None], size[y])
    fits = (comp[x][:, None] != comp[y]) & (small * den >= big * num)
    if lo == hi:
        fits &= x[:, None] < y
    i, j = np.nonzero(fits)
    band = cell["band"][0]  # all rows of a signature have one band
    if band:
        larger = big[i, j]
        bands = {int(n): 1 + int(math.log(n) / BAND) for n in np.unique(larger)}
        mine = np.array([bands[n] for n in larger.tolist()], np.int64) == band
        i, j = i[mine], j[mine]
    i, j = x[i], y[j]
    both = size[i] + size[j]
    room = both - 2 * -(-both * num // (num + den))
    differ = np.zeros(len(i), np.int64)
    for f in FOLDED:
        differ += np.bitwise_count(cell[f][i].view(np.uint64) ^ cell[f][j].view(np.uint64))
    near = differ <= room
    return i[near], j[near]


def _cells_of(batches, names: list[str]):
    """The rows of each signature within a cell, whole; state: those of one."""
    held: list[dict] = []

    def joined():
        return {n: np.concatenate([h[n] for h in held]) for n in names}

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        new = np.zeros(batch.num_rows, bool)
        for c in ("anchor", "lo", "hi", "sig"):
            new[1:] |= cols[c][1:] != cols[c][:-1]
            if held:
                new[0] |= held[-1][c][-1] != cols[c][0]
        at = 0
        for end in [*np.flatnonzero(new).tolist(), batch.num_rows]:
            if end > at:
                held.append({n: c[at:end] for n, c in cols.items()})
            if held and end < batch.num_rows:
                yield joined()
                held = []
            at = end
    if held:
        yield joined()


def _merged(rows: np.ndarray) -> np.ndarray:
    """Rows (a, b, na, nb, shared) with equal pairs added up."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    at = np.flatnonzero(first)
    out = rows[at]
    out[:, 4] = np.add.reduceat(rows[:, 4], at)
    return out


def _near_pairs(rest: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, na, nb, shared): pairs of other components that may link, with the signatures a task saw them share."""
    cells = _in_cells(rest)
    names = cells.columns
    out_names = ["a", "b", "na", "nb", "shared"]

    def run(batches):
        held, size = [], 0
        for cell in _cells_of(batches, names):
            i, j = _cell_pairs(cell, num, den)
            if not len(i):
                continue
            n, key = cell["size"].astype(np.int64), cell["key"]
            up = key[i] > key[j]
            a, b = np.where(up, i, j), np.where(up, j, i)
            held.append(np.stack((key[a], key[b], n[a], n[b], np.ones(len(a), np.int64)), axis=1))
            size += len(a)
            if size > PAIRS:
                held = [_merged(np.concatenate(held))]
                size = len(held[0])
                if size > PAIRS // 2:
                    yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in held[0].T], names=out_names)
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in _merged(np.concatenate(held)).T], names=out_names)

    return cells.mapInArrow(run, ", ".join(f"{c} bigint" for c in out_names))


def _verify(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (u, v) between representatives among candidate key pairs (a, b), by their whole sets."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = cut(keys.join(reps, "key").select("key", "k2", "rep"))
    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    texts = bitmap.keep_rows(docs, "doc_id", bitmap.build(ids)).join(ids, "doc_id")
    sets = cut(_sets(texts, n).join(wanted, ["rep", "key", "k2"]).dropDuplicates(["rep", "key", "k2"]).select("rep", "key", "shingles"))
    left = sets.select(F.col("key").alias("a"), F.col("rep").alias("u"), F.col("shingles").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("rep").alias("v"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .where(both * den >= (F.size("x") + F.size("y") - both) * num).select("u", "v"))


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                  num: int = 80, den: int = 100, hubs: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, representative.

    Texts are lower-cased (A-Z); a text with fewer than ``n`` words is one shingle; null, empty
    and word-less texts have none, link with nothing and are their own component.  Sets link
    when ``den * intersection >= num * union``.  ``component_id`` is the smallest id reachable,
    ``representative`` the smallest id with the same set.  Repeated rows each come back; rows
    that share an id but not a text are one node with the links of all its texts.  A null id takes
    no part: its component and representative are null.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scan = cut(_scan(docs, n))
    level = _levels(scan.where("counts is not null").select("counts"))
    rows = scan.where("counts is null").select("doc_id", "n", F.col("k1").alias("key"), "k2")
    bits = scan.where("doc_id is not null and n > 1").select(F.col("k1").alias("key"), "k2", *PARITY).dropDuplicates(["key", "k2"]).drop("k2")
    members = rows.where("doc_id is not null and n > 0")
    reps = members.groupBy("n", "key", "k2").agg(F.min("doc_id").alias("rep"))

    sigs = _signature_rows(docs, n, num, den, level)
    live = cut(sigs.repartition("sig").sortWithinPartitions("sig", "key").mapInArrow(_live, SIG_ROWS))
    crowd = live.groupBy("sig").agg(F.count(F.lit(1)).alias("crowd"))
    central = live.join(crowd, "sig").groupBy("key", "size").agg(F.sum("crowd").alias("weight"))
    order = Window.partitionBy("sig").orderBy(F.desc("weight"), "b")
    middle = (live.join(central, ["key", "size"]).select("sig", F.col("key").alias("b"), F.col("size").alias("nb"), "weight")
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= hubs).drop("weight", "place"))
    star = (live.select("sig", F.col("key").alias("a"), F.col("size").alias("na")).join(middle, "sig")
            .where(F.col("a") != F.col("b")).where(_sizes_fit(num, den))
            .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"),
                    F.when(F.col("a") > F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                    F.when(F.col("a") > F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))
            .withColumnsRenamed({"x": "a", "y": "b"}).distinct())
    mine, theirs = live.select("sig", "band", F.col("key").alias("a")), live.select("sig", F.col("key").alias("b"))
    star = cut(_alike(star, bits, num, den).join(mine, "a").join(theirs, ["sig", "b"]).where(_own_band()).groupBy("a", "b", "na", "nb")
               .agg(F.count(F.lit(1)).alias("shared")).where(_enough_shared(num, den)).select("a", "b"))
    links = cut(_verify(docs, reps, star, n, num, den).distinct())

    label = components(links)
    folded = [F.col(PARITY[i]).bitwiseXOR(F.col(PARITY[i + 4])).alias(f) for i, f in enumerate(FOLDED)]
    known = (reps.join(label, F.col("rep") == F.col("node"), "left").join(bits.select("key", *folded), "key")
             .select("key", F.coalesce("component", "rep").alias("comp"), *FOLDED))
    placed = live.join(known, "key")
    # signatures with the same first member mostly have the same members: they share cells, and tasks count their pairs
    open_sigs = (placed.groupBy("sig").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("key").alias("anchor"), F.count(F.lit(1)).alias("crowd"))
                 .where("c0 < c1").select("sig", "anchor", "crowd"))
    blocks = open_sigs.groupBy("anchor").agg(F.ceil(F.max("crowd") / F.lit(BLOCK)).cast("int").alias("blocks"))
    rest = placed.join(open_sigs.join(blocks, "anchor").select("sig", "anchor", "blocks"), "sig")
    left_over = (_near_pairs(rest, num, den).groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
                 .where(_enough_shared(num, den)))
    left_over = cut(_alike(left_over, bits, num, den).select("a", "b").join(star, ["a", "b"], "left_anti"))
    more = _verify(docs, reps, left_over, n, num, den)

    # texts that share an id are one node
    same_id = members.join(reps, ["n", "key", "k2"]).groupBy("doc_id").agg(F.min("rep").alias("v"), F.collect_set("rep").alias("us"))
    same_id = same_id.where(F.size("us") > 1).select(F.explode("us").alias("u"), "v")
    final = components(label.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more).union(same_id))
    named = reps.join(final, F.col("rep") == F.col("node"), "left").select(
        "n", "key", "k2", "rep", F.coalesce("component", "rep").alias("component"))
    return (rows.join(named, ["n", "key", "k2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("representative")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that with the smallest id.

    Rows with a null id stay; of several rows with one id that with the smallest text does (nulls last, then by
    the row as JSON).  Only rows that may have to go are shuffled; a bitmap of their ids tells them from the
    rest, and the join decides.
    """
    found = cut(ngram_jaccard(docs, id_col, text_col, **options).select("doc_id", "component_id").where("doc_id is not null"))
    own = free_name(docs, "own_id")
    tagged = docs.withColumn(own, F.col(id_col).cast("bigint"))
    place = free_name(tagged, "place")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    marks = bitmap.build(gone.union(again))
    safe = bitmap.keep_rows(tagged, own, marks, inside=False)
    order = Window.partitionBy(own).orderBy(F.col(text_col).asc_nulls_last(), F.to_json(F.struct(*docs.columns)))
    rest = (bitmap.keep_rows(tagged, own, marks).join(gone, own, "left_anti").select(*tagged.columns)
            .withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place))
    return safe.union(rest).drop(own)
