"""Relationship edges of a child table, checked on key counts instead of rows.

Every edge ``child.column -> parent.column`` needs the child rows whose non-NULL
value is missing among the parent keys of the same cycle.  The child is read
once and turned into ``(cycle, edge, key)`` counts; partial aggregation makes a
hot key one row per task before anything is shuffled, so a committee with a
third of all rows is one row at the join, and so are the rows without a key.
The counts meet the parent keys, tagged with the same edges, in one join: both
sides are hash-partitioned on ``(cycle, edge, key)`` by their own aggregation,
so whatever the number of edges the child has one exchange of key counts and
one of a row per cycle.  Nothing rests on the parents being small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Parents = dict[tuple[str, str], DataFrame]


def edges_of(child: str, tests: Iterable) -> list:
    """The relationship tests leaving ``child``, by parent: children with the same parents share one key set."""
    own = [t for t in tests if t.test_name == "relationships" and t.table == child]
    return sorted(own, key=lambda t: (t.parent_table, t.parent_column, t.column))


def parent_keys(parent: DataFrame, column: str) -> DataFrame:
    """Non-NULL ``(cycle, _key)`` of a parent column, with repeats: ``tagged_keys`` removes them in its one exchange."""
    return parent.where(F.col(column).isNotNull()).select("cycle", F.col(column).cast("string").alias("_key"))


def parents_of(edges: list, table: Callable[[str], DataFrame], memo: Parents | None = None) -> Parents:
    """``memo`` with the key frame of every parent column that ``edges`` name."""
    memo = memo if memo is not None else {}
    for t in edges:
        at = (t.parent_table, t.parent_column)
        if at not in memo:
            memo[at] = parent_keys(table(t.parent_table), t.parent_column)
    return memo


def tagged_keys(edges: list, parents: Parents) -> DataFrame:
    """Distinct parent keys with ``_hit``: ``(cycle, _key)`` of one edge, or ``(cycle, _edge, _key)`` of several."""
    frames = [parents[(t.parent_table, t.parent_column)] for t in edges]
    if len(edges) > 1:
        frames = [f.select("cycle", F.lit(i).alias("_edge"), "_key") for i, f in enumerate(frames)]
    return reduce(DataFrame.unionByName, frames).distinct().withColumn("_hit", F.lit(True))


def edge_counts(child: DataFrame, edges: list, parents: Parents,
                beside: dict[str, Column | None] | None = None) -> DataFrame:
    """One row per cycle of ``child``: ``orphans_<i>`` and ``present_<i>`` of each edge, and the counts of ``beside``.

    ``orphans_<i>``: rows whose value of edge ``i`` is not NULL and not among the parent's
    keys of the cycle; ``present_<i>``: rows whose value is not NULL.  ``beside`` names
    row counts of the same scan: a condition, or None for all rows.  Repeated rows count
    each; an empty child gives no rows; an empty parent makes every present value an orphan.
    Columns of the child named ``_edge``, ``_key``, ``_hit`` or ``_n`` are not allowed.
    """
    beside = beside or {}
    conds = {name: F.lit(True) if cond is None else cond for name, cond in beside.items()}
    if not edges:
        return child.groupBy("cycle").agg(*[F.count_if(c).alias(name) for name, c in conds.items()])
    values = [F.col(t.column).cast("string") for t in edges]
    if len(edges) == 1:  # a constant edge among the grouping keys would cost a second exchange before the join
        by, tagged, first = ["cycle", "_key"], child.select("*", values[0].alias("_key")), F.lit(True)
    else:
        by, tagged = ["cycle", "_edge", "_key"], child.select("*", F.posexplode(F.array(*values)).alias("_edge", "_key"))
        first = F.col("_edge") == 0  # every child row has one line of its first edge, with or without a key
    counts = tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(first & cond).alias(name) for name, cond in conds.items()])
    met = counts.join(tagged_keys(edges, parents), by, "left")
    out = [F.sum(name).alias(name) for name in conds]
    for i in range(len(edges)):
        present = F.col("_key").isNotNull()
        if len(edges) > 1:
            present &= F.col("_edge") == i
        for name, cond in ((f"orphans_{i}", present & F.col("_hit").isNull()), (f"present_{i}", present)):
            out.append(F.sum(F.when(cond, F.col("_n")).otherwise(0)).alias(name))
    return met.groupBy("cycle").agg(*out)
