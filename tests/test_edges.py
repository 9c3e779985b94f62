"""Relationship edges on key counts: brute force, hot and NULL keys, empty frames, one exchange whatever the edges."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.checks import DATA_TESTS, DataTest
from ledgerline.operators.edges import edge_counts, edges_of, parent_keys, parents_of

EDGES = [DataTest("E1", "relationships", "c", "x", "warn", "p", "k"),
         DataTest("E2", "relationships", "c", "y", "warn", "q", "k"),
         DataTest("E3", "relationships", "c", "z", "warn", "q", "k")]
CHILD = "cycle int, x string, y string, z string, v int"
KEYS = "cycle int, k string"


def frames(spark, child, p, q):
    return (spark.createDataFrame(child, CHILD),
            {("p", "k"): parent_keys(spark.createDataFrame(p, KEYS), "k"),
             ("q", "k"): parent_keys(spark.createDataFrame(q, KEYS), "k")})


def brute(child, p, q, edges):
    known = {"p": {r for r in p if r[1] is not None}, "q": {r for r in q if r[1] is not None}}
    out = {}
    for cycle, x, y, z, v in child:
        c = out.setdefault(cycle, Counter())
        c["rows"] += 1
        c["odd"] += v is not None and v % 2 == 1
        for i, t in enumerate(edges):
            value = {"x": x, "y": y, "z": z}[t.column]
            c[f"present_{i}"] += value is not None
            c[f"orphans_{i}"] += value is not None and (cycle, value) not in known[t.parent_table]
    return out


def rows(n, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, "", "hot", "hot", "hot", *(f"k{i}" for i in range(12))])
    child = [(rng.choice([1996, 1998]), key(), key(), key(), rng.choice([None, 1, 2])) for _ in range(n)]
    parent = lambda: [(rng.choice([1996, 1998, 2000]), key()) for _ in range(25)]
    return child, parent(), parent()


@pytest.mark.parametrize("picked", [(0,), (0, 1), (0, 1, 2)])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_counts_equal_brute_force(spark, picked, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        edges = [EDGES[i] for i in picked]
        child, p, q = rows(400, len(picked))
        df, parents = frames(spark, child, p, q)
        got = edge_counts(df, edges, parents, {"rows": None, "odd": F.col("v") % 2 == 1}).collect()
        want = brute(child, p, q, edges)
        assert {r.cycle: {k: v for k, v in r.asDict().items() if k != "cycle"} for r in got} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_frames(spark):
    child, p, q = rows(50, 9)
    df, parents = frames(spark, child, [], [])
    for r in edge_counts(df, EDGES, parents).collect():
        assert all(r[f"orphans_{i}"] == r[f"present_{i}"] for i in range(3))
    df, parents = frames(spark, [], p, q)
    assert edge_counts(df, EDGES, parents, {"rows": None}).collect() == []
    nothing = [(1996, None, None, None, None)] * 3
    df, parents = frames(spark, nothing, p, q)
    (r,) = edge_counts(df, EDGES, parents, {"rows": None}).collect()
    assert r.rows == 3 and not any(r[f"{n}_{i}"] for n in ("orphans", "present") for i in range(3))


def test_one_exchange_of_key_counts_whatever_the_edges(spark, sf):
    """Without broadcasts the child side has an exchange of its key counts and one of the row per cycle."""
    from ledgerline.plans.tables import Tables

    t = Tables(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for child in ("indiv", "pas2"):
            edges = edges_of(child, DATA_TESTS)
            df = t.get(child).select("cycle", *[e.column for e in edges])
            wide = edge_counts(df, edges, parents_of(edges, t.get))
            plan = wide._jdf.queryExecution().executedPlan().toString()
            # One for the key counts, one for the parents' distinct keys, one for the row per cycle.
            assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3, plan
            assert "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_key_is_few_rows_at_the_join(spark):
    """A key with a third of all rows, and as many rows without one, reach the join as one row a group."""
    child = spark.range(30_000, numPartitions=4).selectExpr(
        "1996 as cycle", "case id % 3 when 0 then 'C99999999' when 1 then concat('C', id % 50) end as x")
    edge = [EDGES[0]]
    keys = spark.range(50).selectExpr("1996 as cycle", "concat('C', id) as k")
    (r,) = edge_counts(child, edge, {("p", "k"): parent_keys(keys, "k")}, {"rows": None}).collect()
    assert (r.rows, r.present_0, r.orphans_0) == (30_000, 20_000, 10_000)
