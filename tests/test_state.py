"""State fold, run sessions and fetch validators against plain loops."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from ledgerline.operators import manifest as I
from ledgerline.operators import state as S
from ledgerline.operators import timing as L

T0 = dt.datetime(2024, 1, 1)
OPS = "cycle int, table_name string, op_time timestamp_ntz, op_id bigint, " + ", ".join(f"{c} {t}" for c, t in S.FOLDED.items())


def operations(rng, n):
    out = []
    for i in range(n):
        values = [rng.choice([None, "a", "b", "c"]) if t == "string" else rng.choice([None, 1, 2, 3]) for t in S.FOLDED.values()]
        out.append((rng.choice([2020, 2022, 2024]), rng.choice(["cm", "cn"]), T0 + dt.timedelta(minutes=rng.randrange(50)), i, *values))
    return out


def folded(rows):
    want = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        state = want.setdefault((r[0], r[1]), dict.fromkeys(S.FOLDED))
        state.update({c: v for c, v in zip(S.FOLDED, r[4:]) if v is not None})
    return want


def stored(spark, root):
    return {(r.cycle, r.table_name): {c: r[c] and r[c].value for c in S.FOLDED} for r in S.read_state(spark, root).collect()}


def test_batches_in_any_order_and_twice(spark, tmp_path):
    rng = random.Random(2)
    rows = operations(rng, 120)
    rng.shuffle(rows)
    batches = [rows[:50], rows[50:90], rows[90:], rows[30:60]]
    root = str(tmp_path / "state")
    assert S.read_state(spark, root) is None
    for b in batches:
        S.apply_batch(spark, root, spark.createDataFrame(b, OPS))
    assert stored(spark, root) == folded(rows)


def test_only_touched_cycles_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "state")
    rows = operations(random.Random(3), 60)
    S.apply_batch(spark, root, spark.createDataFrame(rows, OPS))
    files = {c: sorted(os.listdir(f"{root}/cycle={c}")) for c in (2020, 2022, 2024)}
    late = [r for r in operations(random.Random(4), 60) if r[0] == 2022]
    S.apply_batch(spark, root, spark.createDataFrame(late, OPS))
    now = {c: sorted(os.listdir(f"{root}/cycle={c}")) for c in files}
    assert now[2020] == files[2020] and now[2024] == files[2024] and now[2022] != files[2022]
    S.apply_batch(spark, root, spark.createDataFrame([], OPS))
    assert stored(spark, root) == folded(rows + late)


def test_runs_are_spans_of_overlapping_results(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    events = [(1, at(0), 60_000, False), (1, at(20), 50 * 60_000, False), (1, at(65), 1_000, False),  # one run: 0 to 70 minutes
              (1, at(101), 5_000, True), (1, at(102), 1_000, False),  # latest run: failed, 61 s
              (2, at(5), 10_000, False), (3, None, 5, False)]
    df = spark.createDataFrame(events, "cycle int, started_at timestamp_ntz, duration_ms bigint, failed boolean")
    got = {r.cycle: (r.duration_ms, r.n_results, r.return_code) for r in L.latest_runs(df).collect()}
    assert got == {1: (61_000, 2, 1), 2: (10_000, 1, 0)}
    got = {r.cycle: r.duration_ms for r in L.latest_runs(df.where("not failed and started_at < '2024-01-01 01:30:00'")).collect()}
    assert got == {1: 70 * 60_000, 2: 10_000}


def test_summary_of_a_run(spark):
    metrics = spark.createDataFrame([(1, "cm", "dimension", 5, 10, "success"), (2, "cm", "dimension", None, None, "missing"), (3, "cm", "dimension", 1, 1, "success")],
                                    "cycle int, table_name string, scope string, duration_ms bigint, row_count bigint, status string")
    runs = spark.createDataFrame([(1, 99, 0), (2, 7, 1)], "cycle int, duration_ms bigint, return_code int")
    got = {r.cycle: (r.duration_ms, r.status) for r in L.load_report(metrics, "l", "a", "t", runs).where("scope = 'summary'").collect()}
    assert got == {1: (99, "success"), 2: (7, "failed(1)"), 3: (None, "missing")}


def test_validators(spark):
    d1, d2 = "Mon, 01 Jan 2024 10:00:00 GMT", "Tue, 02 Jan 2024 10:00:00 GMT"
    cases = {  # (tag, modified) of the earlier and the later fetch
        "weak": (('W/"a"', d1), ('"a"', d2), "unchanged"), "tags": (("a", d1), ("b", d1), "changed"),
        "date": ((None, d1), ("b", d1), "unchanged"), "older": ((None, d2), ("b", d1), "unchanged"), "later": (("", d1), ("b", d2), "changed"),
        "bad": ((None, "02.01.2024"), (None, "02.01.2024"), "changed"), "none": ((None, None), (None, None), "changed")}
    rows = [(2024, k, i, f"t{i}", "downloaded", *v[i]) for k, v in cases.items() for i in (0, 1)]
    f = spark.createDataFrame(rows, "cycle int, table_name string, fetch_id int, fetched_at string, fetch_status string, etag string, last_modified string")
    assert {r.table_name: r.change_status for r in I.fetch_change_status(f).collect()} == {k: v[2] for k, v in cases.items()}
    dates = spark.createDataFrame([(d1,), ("Mon, 32 Jan 2024 10:00:00 GMT",), (d1.lower(),), (None,)], "d string").select(I.http_date(F.col("d"))).collect()
    assert [r[0] for r in dates] == [dt.datetime(2024, 1, 1, 10), None, None, None]
