"""Merkle dataset manifest in van Emde Boas layout.

Rows are leaves of one hash tree per source; the trees' roots are leaves of one more tree.
A tree of any size is stored as aligned blocks of ``fan ** height`` leaves.  A block holds all
digests of its subtree in one byte string in van Emde Boas order: the levels are split at half
height, the top tree lies first and the bottom trees follow one after another, each laid out
the same way.  ``address`` computes a node's place by arithmetic alone, for whole arrays of
nodes, and serves both construction and sibling retrieval; near nodes of a path share cache
lines whatever the line's size.  The block roots are the leaves of the next level of blocks,
until one block is left, so a task never holds more than a block and a hot source is as many
tasks as it has blocks.

Every run of ``fan`` consecutive nodes (the last may be shorter, even one) has one parent: the
digest of the concatenated hexadecimal digests.  Leaves are numbered by a range shuffle on
(source, order) and a prefix sum over the per-task counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.stage import cut, small_batches

FAN = 16
HEIGHT = 2
STEPS = "array<struct<position:int,others:string>>"
STEPS_ARROW = pa.list_(pa.struct([("position", pa.int32()), ("others", pa.string())]))


def digest_of(values: list[Column]) -> Column:
    """Digest of a row: each value as byte count, colon and text, or ``-`` where it is null."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def levels_of(leaves: int, fan: int = FAN) -> int:
    """Levels of a tree, leaves and root included."""
    levels = 1
    while leaves > 1:
        leaves, levels = -(-leaves // fan), levels + 1
    return levels


def address(depth: int, index: np.ndarray, leaves: int, levels: int, fan: int = FAN) -> np.ndarray:
    """Places in van Emde Boas order of the nodes ``index`` of a depth (0: root) of a tree; only its last runs may be short."""
    index = np.asarray(index, np.int64)
    under = np.full(index.shape, leaves, np.int64)
    at = np.zeros(index.shape, np.int64)
    while levels > 1:
        top = levels // 2
        low = levels - top
        if depth < top:
            under, levels = -(-under // fan ** low), top
            continue
        for d in range(top):
            at += -(-under // fan ** (levels - 1 - d))
        each = fan ** (depth - top)
        tree = index // each
        at += tree * ((fan ** low - 1) // (fan - 1))
        under = np.minimum(under - tree * fan ** (low - 1), fan ** (low - 1))
        index, depth, levels = index % each, depth - top, low
    return at


@lru_cache(64)
def _places(leaves: int, levels: int, fan: int) -> tuple[np.ndarray, ...]:
    """Addresses of all nodes, one array per depth from the root down."""
    return tuple(address(d, np.arange(-(-leaves // fan ** (levels - 1 - d))), leaves, levels, fan) for d in range(levels))


def lay_out(leaves: list[bytes], levels: int, fan: int = FAN) -> bytes:
    """All digests of a tree of ``levels`` levels over raw leaf digests, in van Emde Boas order."""
    places = _places(len(leaves), levels, fan)
    nodes = np.empty((sum(map(len, places)), 32), np.uint8)
    row = [x.hex() for x in leaves]
    for depth in range(levels - 1, -1, -1):
        nodes[places[depth]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        row = [sha256("".join(row[i:i + fan]).encode()).hexdigest() for i in range(0, len(row), fan)]
    return nodes.tobytes()


class Block:
    """A stored block: ``rows[depth]`` lists the hexadecimal digests of a depth."""

    def __init__(self, nodes: bytes, leaves: int, levels: int, fan: int = FAN):
        flat = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        self.fan, self.levels, self.rows = fan, levels, []
        for places in _places(leaves, levels, fan):
            text = flat[places].tobytes().hex()
            self.rows.append([text[i:i + 64] for i in range(0, len(text), 64)])

    def steps(self, leaf: int) -> list[tuple[int, str]]:
        """(position in its run, the run's other digests) from a leaf up to the block's root."""
        out = []
        for depth in range(self.levels - 1, 0, -1):
            run = self.rows[depth][leaf - leaf % self.fan:][:self.fan]
            at = leaf % self.fan
            out.append((at, "".join(run[:at] + run[at + 1:])))
            leaf //= self.fan
        return out


def fold(leaf: str, steps: list[tuple[int, str]]) -> str:
    """The root that a leaf and the others of its runs give."""
    for at, others in steps:
        leaf = sha256((others[:64 * at] + leaf + others[64 * at:]).encode()).hexdigest()
    return leaf


@dataclass
class Forest:
    """Trees as levels of blocks: ``levels[0]`` over the entries, each next one over the roots of the blocks below."""

    entries: DataFrame  # tree, leaf_no, total, digest and the entries' own columns
    levels: list[DataFrame]  # tree, block, total, n, depth, nodes, root
    fan: int
    height: int

    @property
    def span(self) -> int:
        return self.fan ** self.height

    def roots(self) -> DataFrame:
        """(tree, digest): the root of every tree."""
        tops = [x.where(F.col("total") <= self.span).select("tree", F.col("root").alias("digest")) for x in self.levels]
        out = tops[0]
        for x in tops[1:]:
            out = out.union(x)
        return out


@dataclass
class Manifest:
    """Trees of all sources and the tree over their roots."""

    trees: Forest
    top: Forest


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``tree`` among the columns) with ``leaf_no`` and ``total``: places in order within each tree, and how many.

    Equal rows may swap places, which no digest tells; a running number lets even those spread over tasks.
    """
    keys = ["tree", *order, "_tie"]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    spread = cut(spread).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    at = spread.columns.index("tree")

    def count(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            runs = pc.run_end_encode(batch.column(at))
            pos, start = np.empty(batch.num_rows, np.int64), 0
            for tree, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                seen = seen if tree == last else 0
                pos[start:end] = np.arange(seen, seen + end - start)
                seen, last, start = seen + end - start, tree, end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(pos)],
                                             names=[*batch.schema.names, "_part", "_pos"])

    schema = T.StructType([*spread.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_pos", T.LongType())])
    placed = cut(spread.mapInArrow(count, schema))
    counts = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = counts.select("tree", "_part", (F.sum("n").over(whole.orderBy("_part")) - F.col("n")).alias("_before"),
                           F.sum("n").over(whole).alias("total"))
    return (placed.join(before, ["tree", "_part"]).withColumn("leaf_no", F.col("_pos") + F.col("_before"))
            .drop("_part", "_pos", "_before"))


def _blocks(entries: DataFrame, fan: int, height: int) -> DataFrame:
    """One row per block over (tree, leaf_no, total, digest)."""
    span = fan ** height
    grouped = (entries.groupBy("tree", "total", F.expr(f"leaf_no div {span}").alias("block"))
               .agg(F.sort_array(F.collect_list(F.struct("leaf_no", "digest"))).alias("leaves"))
               .select("tree", "block", "total", F.col("leaves.digest").alias("leaves")))

    def run(batches):
        for batch in batches:
            cols = batch.to_pydict()
            n = [len(x) for x in cols["leaves"]]
            # a tree's only block ends at the tree's root; a block of many has its full height
            depth = [levels_of(k, fan) if total <= span else height + 1 for k, total in zip(n, cols["total"])]
            nodes = [lay_out(x, d, fan) for x, d in zip(cols["leaves"], depth)]
            yield pa.record_batch([*batch.columns[:3], pa.array(n, pa.int32()), pa.array(depth, pa.int32()), pa.array(nodes, pa.binary()),
                                   pa.array([x[:32] for x in nodes], pa.binary())],
                                  names=["tree", "block", "total", "n", "depth", "nodes", "root"])

    return grouped.mapInArrow(run, "tree string, block bigint, total bigint, n int, depth int, nodes binary, root binary")


def grow(entries: DataFrame, fan: int = FAN, height: int = HEIGHT) -> Forest:
    """Blocks over numbered entries, then over the blocks' roots, until every tree is one block."""
    span, levels, rows = fan ** height, [], entries
    while True:
        levels.append(cut(_blocks(rows.select("tree", "leaf_no", "total", "digest"), fan, height)))
        widest = levels[-1].agg(F.max("total")).first()[0]
        if widest is None or widest <= span:
            return Forest(entries, levels, fan, height)
        rows = levels[-1].where(F.col("total") > span).select(
            "tree", F.col("block").alias("leaf_no"), F.expr(f"(total + {span - 1}) div {span}").alias("total"), F.col("root").alias("digest"))


def build(rows: DataFrame, order: list[str], fan: int = FAN, height: int = HEIGHT) -> Manifest:
    """Manifest of ``rows`` (tree, digest and the ``order`` columns; any others are kept with the entries).

    ``tree`` must not be null (give null sources a name that sorts first), ``digest`` is binary.
    Leaves ascend by ``order``, nulls first, equal ones by digest; repeated rows are leaves each.
    The trees' roots ascend by ``tree`` byte by byte.  An empty table has no blocks and no root.
    """
    small_batches(rows.sparkSession)
    trees = grow(numbered(rows, [*order, "digest"]), fan, height)
    roots = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(trees, grow(numbered(roots, ["name"]), fan, height))


def _paths(forest: Forest, above: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Per level from the top: (blocks, (tree, block, steps) above each block), given (tree, steps) above each tree."""
    handed = None
    for level in reversed(forest.levels):
        ends = level.where(F.col("total") <= forest.span).select("tree", "block").join(above, "tree").select("tree", "block", "steps")
        upper = ends if handed is None else handed.union(ends)
        yield level, upper
        handed = cut(_entry_paths(level, upper, forest)) if level is not forest.levels[0] else None


def _entry_paths(level: DataFrame, upper: DataFrame, forest: Forest) -> DataFrame:
    """(tree, block, steps) of the entries of a level's blocks: an entry's number is that of the block below."""
    fan, span = forest.fan, forest.span

    def run(batches):
        for batch in batches:
            cols = batch.to_pydict()
            for tree, block, n, depth, nodes, steps in zip(*(cols[c] for c in ("tree", "block", "n", "depth", "nodes", "steps"))):
                here = Block(nodes, n, depth, fan)
                tail = [(s["position"], s["others"]) for s in steps]
                out = [[{"position": p, "others": o} for p, o in here.steps(i) + tail] for i in range(n)]
                yield pa.record_batch([pa.array([tree] * n, pa.string()), pa.array(range(block * span, block * span + n), pa.int64()),
                                       pa.array(out, STEPS_ARROW)], names=["tree", "block", "steps"])

    joined = level.join(upper, ["tree", "block"]).select("tree", "block", "n", "depth", "nodes", "steps")
    return joined.mapInArrow(run, f"tree string, block bigint, steps {STEPS}")


def audit(manifest: Manifest, claimed: str) -> DataFrame:
    """One row per leaf: the entries' columns, leaf, subroot, root, proof, folded_root, verified.

    ``claimed`` names the binary column of the entries with the digest found now; null stands for
    the leaf as it was built.  ``proof`` lists the other digests of each run from the leaf to the
    root, as one text; ``folded_root`` is what the claimed digest gives with them.
    """
    trees, top = manifest.trees, manifest.top
    spark = trees.entries.sparkSession
    whole = top.roots().select("tree", F.col("digest").alias("root"))
    nothing = F.array().cast(STEPS)
    above_top = spark.range(1).select(F.lit("").alias("tree"), nothing.alias("steps"))
    for level, upper in _paths(top, above_top):
        entry_steps = _entry_paths(level, upper, top)
    named = top.entries.select(F.col("leaf_no").alias("block"), F.col("name"), F.col("digest").alias("subroot"))
    above = cut(entry_steps.join(named, "block").join(whole, "tree").select(F.col("name").alias("tree"), "steps", "subroot", "root"))
    for level, upper in _paths(trees, above.select("tree", "steps")):
        pass

    fan, span = trees.fan, trees.span
    own = [c for c in trees.entries.columns if c not in ("tree", "leaf_no", "total", "digest", claimed)]
    leaves = (trees.entries.groupBy("tree", F.expr(f"leaf_no div {span}").alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("leaf_no", claimed, *own))).alias("leaves")))
    joined = (leaves.join(level.select("tree", "block", "n", "depth", "nodes"), ["tree", "block"])
              .join(upper, ["tree", "block"]).join(above.select("tree", "subroot", "root"), "tree")
              .select("leaves", "n", "depth", "nodes", "steps", "subroot", "root"))
    kept = trees.entries.select(*own).schema
    text = ["leaf", "subroot", "root", "proof", "folded_root"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                n, depth, nodes, steps, subroot, root = (row.column(c)[0].as_py() for c in ("n", "depth", "nodes", "steps", "subroot", "root"))
                here = Block(nodes, n, depth, fan)
                tail = [(s["position"], s["others"]) for s in steps]
                upward = "".join(o for _, o in tail)
                fields = row.column("leaves").flatten().flatten()
                now = [x.hex() if x is not None else None for x in fields[1].to_pylist()]
                out: list[list] = [[], [], []]
                for k, leaf in enumerate(here.rows[depth - 1]):
                    path = here.steps(k)
                    folded = fold(now[k] or leaf, path + tail)
                    for col, x in zip(out, ("".join(o for _, o in path) + upward, folded, folded == root.hex())):
                        col.append(x)
                yield pa.record_batch(
                    [*fields[2:], pa.array(here.rows[depth - 1]), pa.array([subroot.hex()] * n), pa.array([root.hex()] * n),
                     pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.bool_())],
                    names=[*own, *text, "verified"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{c} string" for c in text), "verified boolean"])
    return joined.mapInArrow(run, schema)


def document_manifest(docs: DataFrame, suspect: Column, now: dict[str, Column], fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                      fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """Manifest of ``docs`` by source in the order of doc_id, audited against changed rows.

    Where ``suspect`` holds, the columns in ``now`` replace those of the row when it is read again.
    Returns doc_id and the columns of ``audit``.  Null sources form a tree of their own, before all
    others; null ids come first and are leaves like any other; repeated rows are leaves each; other
    columns take no part.  An empty table gives no rows.
    """
    old = digest_of([F.col(c) for c in fields])
    new = digest_of([now.get(c, F.col(c)) for c in fields])
    rows = docs.select(
        F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("")).alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(old).alias("digest"), F.when(suspect, F.unhex(new)).alias("claimed"))
    return audit(build(rows, ["doc_id"], fan, height), "claimed")
