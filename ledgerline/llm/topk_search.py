"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are quantised to integers and dealt into shards of a bounded number of rows.  A top tree
of median splits, learned from a bounded sample, names the cell of every row, and each cell is
one shard or several; so shards lie apart and their tight boxes are small.  Each shard is one
packed row, over which a KD-tree is built in the task: the widest dimension is split at the
median, and every node keeps its tight bounding box.  A query walks the tree best-first: the
score bound of a box is the sum of ``max(q * low, q * high)``, and the walk ends when the best
bound left is below the kth score.

Queries are packed into blocks by the same cells.  Every block first searches one home shard, that
with the greatest bounds.  The kth scores found there go on with the block, and a query is
sent only to those other shards whose box can still reach its kth score.  Blocks meet packs of
boxes in an equi-join, and queries meet shards by the shard number: a shard's rows come first in
its task and the queries stream past them.  Nothing that grows with the input is broadcast or collected.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.stage import cut
from ledgerline.llm.words import mix

PACK = "pack bigint, ids binary, vectors binary, low binary, high binary"
PART_BITS = 24
BIG = 1 << 62


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where a component is too large for it."""
    if not x.size or np.abs(x).max() < 2.0 ** 52 / scale:
        return np.floor(scale * x).astype(np.int64)
    whole = lambda v: int(v) * scale if abs(v) >= 2.0 ** 52 / scale else int(np.floor(scale * v))
    return np.array([[whole(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def suited(q: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type in which their inner products are exact."""
    if not q.size or not m.size:
        return q.astype(np.float64), m.astype(np.float64)
    most = int(np.abs(q).max()) * int(np.abs(m).max()) * q.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
    return q.astype(kind), m.astype(kind)


class Tree:
    """KD-tree over the rows of ``m``: ``kids[i]`` or a slice of ``order`` per node, and boxes ``low``, ``high``."""

    def __init__(self, m: np.ndarray, leaf: int):
        self.order, self.kids, self.span, low, high = np.arange(len(m)), [], [], [], []
        todo = [(0, len(m), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            at = len(self.kids)
            if parent >= 0:
                self.kids[parent][side] = at
            rows = m[self.order[a:b]]
            lo, hi = rows.min(0), rows.max(0)
            low.append(lo), high.append(hi), self.span.append((a, b))
            wide = int(np.argmax((hi - lo).astype(np.float64))) if m.shape[1] else 0
            if b - a > leaf and m.shape[1] and hi[wide] > lo[wide]:
                self.kids.append([0, 0])
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(rows[:, wide].astype(np.float64), mid)]
                todo += [(a, a + mid, at, 0), (a + mid, b, at, 1)]
            else:
                self.kids.append(None)
        self.low, self.high = np.array(low), np.array(high)
        self.rows = m[self.order]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Score bound of every node for every query."""
        zero = q.dtype.type(0) if q.dtype != object else 0
        return np.maximum(q, zero) @ self.high.T + np.minimum(q, zero) @ self.low.T


def search(tree: Tree, ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, own: int, k: int, kth) -> tuple[np.ndarray, np.ndarray]:
    """Best ``k`` (ids, scores) of one query among scores of at least ``kth`` (None: no bound yet), ties to smaller ids."""
    best_ids, best = np.empty(0, np.int64), np.empty(0, tree.rows.dtype)
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if kth is not None and -bound < kth:
            break
        if tree.kids[node] is not None:
            for kid in tree.kids[node]:
                if kth is None or bounds[kid] >= kth:
                    heapq.heappush(heap, (-bounds[kid], kid))
            continue
        a, b = tree.span[node]
        score, near = tree.rows[a:b] @ q, ids[tree.order[a:b]]
        keep = near != own
        if kth is not None:
            keep &= (score >= kth).astype(bool)
        if keep.any():
            best, best_ids = np.concatenate((best, score[keep])), np.concatenate((best_ids, near[keep]))
            if len(best) >= k:
                top = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[top], best_ids[top]
                kth = best[-1]
    return best_ids, best


class Cells:
    """Top tree of median splits in heap order, learned from a sample of the rows; its leaves are cells."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.dim, self.cut = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        rows = {0: sample}
        for node in range(len(self.dim)):
            x = rows.pop(node)
            left = right = x[:0]
            if len(x) > 1 and x.shape[1]:
                wide = int(np.argmax(x.max(0) - x.min(0)))
                self.dim[node], self.cut[node] = wide, np.median(x[:, wide])
                up = x[:, wide] >= self.cut[node]
                left, right = x[~up], x[up]
            rows[2 * node + 1], rows[2 * node + 2] = left, right

    def of(self, x: np.ndarray) -> np.ndarray:
        node, at = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[at, self.dim[node]] >= self.cut[node])
        return node - len(self.dim)


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    x = np.zeros((len(lists), dims))
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    x[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    return x


def _dealt(rows: DataFrame, cells: Cells, dims: int, limit: int) -> DataFrame:
    """One row per pack of (vec_id, embedding) rows of one cell, at most ``2 * limit`` of them.  A pack has its tight box."""
    def sizes(batches):
        total = np.zeros(1 << cells.depth, np.int64)
        for batch in batches:
            total += np.bincount(cells.of(matrix(batch.column(1), dims)), minlength=len(total))
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "n"])

    counted = rows.mapInArrow(sizes, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # a row per cell: bounded
    packs = np.ones(1 << cells.depth, np.int64)
    for r in counted:
        packs[r.cell] = max(1, -(-r.n // limit))
    before = np.cumsum(packs) - packs

    def place(batches):
        for batch in batches:
            cell = cells.of(matrix(batch.column(1), dims))
            spot = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) % packs[cell].astype(np.uint64)
            yield pa.record_batch([pa.array(before[cell] + spot.astype(np.int64)), batch.column(0), batch.column(1)], names=["pack", "vec_id", "embedding"])

    def pack(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now, part, size = None, 0, 0

        def give():
            ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            one = [ids.tobytes(), x.tobytes(), x.min(0).tobytes(), x.max(0).tobytes()]
            return pa.record_batch([pa.array([now << PART_BITS | part]), *[pa.array([v], pa.binary()) for v in one]], names=["pack", "ids", "vectors", "low", "high"])

        for batch in batches:
            own, ids, x = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), matrix(batch.column(2), dims)
            at = 0
            while at < len(own):
                if held and (own[at] != now or size == 2 * limit):
                    yield give()
                    held, size, part = [], 0, part + 1 if own[at] == now else 0
                now = int(own[at])
                end = min(int(np.searchsorted(own, now, "right")), at + 2 * limit - size)
                held.append((ids[at:end], x[at:end]))
                size, at = size + end - at, end
        if held:
            yield give()

    placed = rows.mapInArrow(place, "pack bigint, vec_id bigint, embedding array<double>")
    return placed.repartition("pack").sortWithinPartitions("pack", "vec_id").mapInArrow(pack, PACK)


def _unpack(ids: bytes, vectors: bytes, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, quantise(np.frombuffer(vectors, np.float64).reshape(len(i), dims), scale)


def _routes(blocks: DataFrame, boxes: DataFrame, n_packs: int, dims: int, scale: int, schema: str, rows_of) -> DataFrame:
    """``rows_of(block row, shards, bounds)`` for every block of queries and every pack of boxes."""
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                _, q = _unpack(r["ids"], r["vectors"], dims, scale)
                low, high = (quantise(np.frombuffer(b"".join(b[side] for b in r["boxes"])).reshape(len(r["boxes"]), dims), scale) for side in ("low", "high"))
                both = suited(q, np.concatenate((low, high)))
                if both[0].dtype == object:  # beyond exact floats: every shard may hold a hit
                    bounds = np.full((len(q), len(low)), np.inf)
                else:
                    zero = both[0].dtype.type(0)
                    bounds = np.maximum(both[0], zero) @ both[1][len(low):].T + np.minimum(both[0], zero) @ both[1][:len(low)].T
                yield from rows_of(r, np.array([b["shard"] for b in r["boxes"]], np.int64), bounds)

    spread = blocks.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(n_packs - 1))))
    return spread.join(boxes, "pack").mapInArrow(run, schema)


def _home(r: dict, shards: np.ndarray, bounds: np.ndarray):
    total = bounds.sum(0, dtype=np.float64)
    best = int(np.argmax(total))
    yield pa.record_batch([pa.array([r["block"]]), pa.array([shards[best]]), pa.array([float(total[best])])], names=["block", "shard", "total"])


ASKED = "shard bigint, block bigint, ids binary, vectors binary, kths array<bigint>"


def _reached(dims: int, some: int = 32):
    """Rows ASKED: the queries of a block whose kth score a shard can reach, for each shard but the block's home."""
    def rows_of(r: dict, shards: np.ndarray, bounds: np.ndarray):
        ids, x = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"]).reshape(-1, dims) if dims else np.empty((len(r["ids"]) // 8, 0))
        of = dict(r["kth_of"] or ())
        kths = [of.get(i) for i in ids.tolist()]
        floor = np.array([-np.inf if v is None else v for v in kths], np.float64)
        open_ = (bounds >= floor[:, None]) & (shards != r["home"])
        out: list[tuple] = []
        for at in np.flatnonzero(open_.any(0)).tolist():
            who = np.flatnonzero(open_[:, at])
            out.append((int(shards[at]), r["block"], ids[who].tobytes(), x[who].tobytes(), [kths[i] for i in who.tolist()]))
            if len(out) == some:
                yield _asked(out)
                out = []
        if out:
            yield _asked(out)

    return rows_of


def _asked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["shard", "block", "ids", "vectors", "kths"])


def _meet(shards: DataFrame, asked: DataFrame, dims: int, scale: int, k: int, leaf: int) -> DataFrame:
    """One row (block, query_id, vec_id, score) per hit of the rows ASKED in their shards; a shard is sent once."""
    def run(batches):
        tree, ids, m = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                own, raw = _unpack(r["ids"], r["vectors"], dims, scale)
                if r["block"] is None:
                    ids, m, tree = own, raw, None
                    continue
                q, mine = suited(raw, m)
                if tree is None or tree.rows.dtype != mine.dtype:
                    tree = Tree(mine, leaf)
                bounds = tree.bounds(q)
                kths = r["kths"] or [None] * len(own)
                cols: list[list] = [[], [], []]
                for i, asker in enumerate(own):
                    kth = None if kths[i] is None else q.dtype.type(kths[i]) if q.dtype != object else int(kths[i])
                    near, score = search(tree, ids, q[i], bounds[i], int(asker), k, kth)
                    cols[0].append(np.full(len(near), asker)), cols[1].append(near)
                    cols[2].append(np.array([max(-BIG * 2, min(BIG * 2 - 1, int(s))) for s in score], np.int64))
                found = [np.concatenate(c).astype(np.int64) for c in cols]
                yield pa.record_batch([pa.array(c) for c in (np.full(len(found[0]), r["block"], np.int64), *found)], names=["block", "query_id", "vec_id", "score"])

    both = (shards.selectExpr("shard", "cast(null as bigint) as block", "ids", "vectors", "cast(null as array<bigint>) as kths")
            .union(asked.select("shard", "block", "ids", "vectors", "kths")))
    return (both.repartition("shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
            .mapInArrow(run, "block bigint, query_id bigint, vec_id bigint, score bigint"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
                scale: int = 64, shard_rows: int = 4096, block_rows: int = 512, leaf: int = 128, sample: int = 20_000, box_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the largest inner products for each query.

    Both tables have an id and an array; components become floor(scale * x).  Rows with a null id,
    a null vector or a null or non-finite component take no part; shorter vectors count as padded
    with zeros.  A query never finds rows of its own id.  Repeated rows of ``vectors`` are candidates
    each; a query id in several rows is asked once, with its smallest vector.  Ties go to the
    smaller id; scores beyond 64 bits saturate.  Empty tables give no rows.  Other columns are ignored.
    At most ``sample`` rows choose the splits between shards; every row is indexed, and the splits
    decide only the time.
    """
    spark = vectors.sparkSession
    finite = f"forall({vector_col}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    some = lambda t: (t.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
                      .where(f"vec_id is not null and embedding is not null and {finite.replace(vector_col, 'embedding')}"))
    base = some(vectors)
    asked = some(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n, dims = base.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    n_asked, q_dims = asked.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n or not n_asked:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dims = max(dims, q_dims)
    share = -(-n // sample)
    drawn = base.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(share)) == 0).limit(sample).select("embedding").toArrow()["embedding"]
    drawn = matrix(drawn.combine_chunks(), dims)
    depth = max(0, min(n // shard_rows, len(drawn) // 16).bit_length() - 1) if dims else 0
    cells = Cells(drawn, depth)
    shard = cut(_dealt(base, cells, dims, shard_rows).withColumnRenamed("pack", "shard"))
    block = cut(_dealt(asked, cells, dims, block_rows).select(F.col("pack").alias("block"), "ids", "vectors"))

    n_packs = max(1, -(-shard.count() // box_rows))
    boxes = (shard.select(F.pmod(F.xxhash64("shard"), F.lit(n_packs)).cast("int").alias("pack"), F.struct("shard", "low", "high").alias("box"))
             .groupBy("pack").agg(F.collect_list("box").alias("boxes")))
    homes = (_routes(block, boxes, n_packs, dims, scale, "block bigint, shard bigint, total double", _home)
             .groupBy("block").agg(F.max(F.struct("total", "shard")).alias("best")).select("block", F.col("best.shard").alias("home")))
    block = cut(block.join(homes, "block"))
    first = block.select(F.col("home").alias("shard"), "block", "ids", "vectors", F.lit(None).cast("array<bigint>").alias("kths"))
    near = cut(_meet(shard, first, dims, scale, k, leaf))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("r", F.row_number().over(best)).where(F.col("r") == k)
    known = kth.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("kth_of"))  # a block is bounded
    onward = _routes(block.join(known, "block", "left"), boxes, n_packs, dims, scale, ASKED, _reached(dims))
    far = _meet(shard, onward, dims, scale, k, leaf)
    return (near.union(far).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
