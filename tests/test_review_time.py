"""As-of lookups and explained row sets against plain loops."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators.asof import as_of
from ledgerline.operators.explain import explained, numbered, row_sets

T0 = dt.datetime(2024, 1, 1)


def test_as_of_equals_a_loop(spark):
    rng = random.Random(4)
    times = [T0 + dt.timedelta(hours=6 * rng.randrange(60)) for _ in range(40)]
    keys = ["hot"] * 6 + ["b", None]
    log = [(rng.choice(keys), i, rng.choice(times + [None]), rng.choice(["x", "y"]), rng.choice(["v1", "v2", None])) for i in range(400)]
    points = [(rng.choice([*keys, "absent"]), rng.choice([*times, T0 - dt.timedelta(days=9), T0 + dt.timedelta(days=99), None]), i // 2, "n") for i in range(120)]
    lf = spark.createDataFrame(log, "k string, id int, at timestamp_ntz, kind string, value string")
    pf = spark.createDataFrame(points, "k string, t timestamp_ntz, p int, kind string")
    got = as_of(pf, lf, ["k"], "t", "at", "id", {"xs": F.col("kind") == "x", "every": F.lit(True)}, {"last": F.col("value")})
    want = []
    for k, t, p, kind in points:
        seen = [r for r in log if r[0] == k and r[2] is not None and t is not None and r[2] <= t]
        last = max(((r[2], r[1], r[4]) for r in seen if r[4] is not None), default=(0, 0, None))
        want.append((k, t, p, kind, sum(r[3] == "x" for r in seen), len(seen), last[2]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert as_of(pf.limit(0), lf, ["k"], "t", "at", "id", {"n": F.lit(True)}, {}).count() == 0
    assert as_of(pf, lf.limit(0), ["k"], "t", "at", "id", {"n": F.lit(True)}, {}).where("n <> 0").count() == 0


def test_explained_rows_of_overlapping_and_circular_issues(spark):
    rng = random.Random(9)
    universe = 100_000  # several bitmaps
    sets = {"a": set(range(1, universe)), "b": set(range(500, 70_000)), "c": set(range(32_760, 40_000)), "d": {1, 600, 32_768, 32_769, 99_998},
            "e": set(rng.sample(range(1, universe), 3000)), "f": {5}}
    edges = [("b", "a"), ("c", "b"), ("d", "b"), ("d", "c"), ("e", "b"), ("b", "e"), ("e", "a"), ("d", "a"), ("f", "c"), ("d", "b")]
    members = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s], "issue_key string, row_id bigint")
    ef = spark.createDataFrame([(*e, "explains_part_of") for e in edges] + [("f", "a", "duplicate_of")],
                               "from_issue_key string, to_issue_key string, relationship_type string")
    up = {k: {t for f, t in edges if f == k} for k in sets}
    depth = {}
    for k in sets:
        level, seen, n = {k}, set(), 0
        while level:
            n += 1
            level = {t for x in level for t in up[x]} - seen
            seen |= level
            depth |= {(t, k): n for t in level if t != k}
    want = {}
    for (a, d), n in depth.items():
        union = set().union(*(sets[x] for y, x in depth if y == a)) & sets[a]
        want[a, d] = (n, len(sets[a]), len(sets[a] & sets[d]), len(union), len(sets[a] & sets[d]) / len(sets[a]), len(union) / len(sets[a]))
    got = {(r[0], r[1]): tuple(r[2:]) for r in explained(row_sets(members), ef).select(
        "ancestor_key", "descendant_key", "depth", "ancestor_rows", "explained_rows", "union_rows", "explained_share", "union_share").collect()}
    assert got == want and max(n for n, *_ in want.values()) >= 3 and all(w[-1] <= 1 for w in want.values())
    assert want["a", "b"][2] + want["a", "e"][2] > want["a", "b"][3]  # parts overlap


def test_row_numbers_are_dense(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("cycle"), F.lit("same").alias("k"))
    got = [r.row_id for r in numbered(rows, ["cycle", "k"]).orderBy("row_id").select("row_id").collect()]
    assert got == list(range(1, 5001))
    assert numbered(rows.limit(0), ["cycle"]).count() == 0
