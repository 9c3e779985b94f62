"""ZIP ingest round trip, table and log sinks, catalog listing, streaming ingest."""

import os
import zipfile

from pyspark.sql import functions as F

from ledgerline.operators import audits as A
from ledgerline.sources import sinks
from ledgerline.sources.layouts import Layout, LAYOUTS
from ledgerline.sources.zipped import load_zip, zip_lines
from ledgerline.streaming.landing import start_ingest

THREE = Layout("t3", "t3.txt", "dimension", (("A", "s"), ("B", "s"), ("C", "m")))


def _zip(root, rel, members: dict[str, bytes]):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, data in members.items():
            zf.writestr(name, data)


def test_zip_round_trip(spark, tmp_path):
    root = str(tmp_path)
    _zip(root, "data/2026/t326.zip", {"t3.txt": b"A|x|1.005\r\n\nB|y|\nlatin|\xe9t\xe9|3\nC|z|2,5\n",
                                      "other.txt": b"ignored|a|1\n"})
    _zip(root, "data/2024/t324.zip", {"t3.txt": b"D|w|7\n"})
    manifest = spark.createDataFrame(
        [(2026, "data/2026/t326.zip", "t3.txt"), (2024, "data/2024/t324.zip", "t3.txt")],
        "cycle int, zip_path string, source_entry string")
    lines = zip_lines(spark, manifest, root)
    assert lines.count() == 6  # 5 lines (one blank) + 1
    rows = load_zip(spark, manifest, THREE, root).select("cycle", "A", "B", "C").collect()
    got = sorted((r.cycle, r.A, r.B, None if r.C is None else str(r.C)) for r in rows)
    assert got == [(2024, "D", "w", "7.00"), (2026, "A", "x", "1.01"), (2026, "B", "y", None),
                   (2026, "C", "z", None)]
    bronze = os.path.join(root, "bronze")
    again = load_zip(spark, manifest, THREE, root, bronze_path=bronze)
    assert again.count() == 4


def test_replace_cycle_clears_with_empty_frame(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1996, "a"), (1998, "b")], "cycle int, v string")
    sinks.write_table(df, root, "t")
    sinks.replace_cycle(spark.createDataFrame([(1998, "c")], "cycle int, v string"), root, "t", 1998)
    assert sorted(tuple(r) for r in sinks.read_table(spark, root, "t").select("cycle", "v").collect()) == [
        (1996, "a"), (1998, "c")]
    sinks.replace_cycle(spark.createDataFrame([], "cycle int, v string"), root, "t", 1998)
    assert [tuple(r) for r in sinks.read_table(spark, root, "t").select("cycle", "v").collect()] == [(1996, "a")]
    assert sinks.register_tables(spark, root, "raw_test", ["t"]) == ["t"]


def _issue(run, cycle, table, itype, key, n):
    return (run, cycle, table, itype, "warn", key, n, f"rows={n}", None)


def test_log_slice_replace_is_idempotent(spark, tmp_path):
    root = os.path.join(str(tmp_path), "qa_issue_log")
    schema = ("run_id bigint, cycle bigint, table_name string, issue_type string, severity string, "
              "issue_key string, issue_count bigint, issue_details string, detected_at timestamp_ntz")
    old = spark.createDataFrame([_issue(1, 1996, "pas2", "null_rate", "CAND_ID", 5),
                                 _issue(1, 1996, "pas2", "duplicate_key", "10", 2),
                                 _issue(1, 1998, "pas2", "null_rate", "CAND_ID", 7)], schema)
    old.write.partitionBy(*sinks.LOG_KEYS).parquet(root)
    new = spark.createDataFrame([_issue(1, 1996, "pas2", "null_rate", "SUB_ID", 3)], schema)
    covered = spark.createDataFrame([(1, 1996, "pas2", "null_rate"), (1, 1998, "pas2", "null_rate")],
                                    "run_id bigint, cycle bigint, table_name string, issue_type string")
    expected = sorted(tuple(r) for r in A.replace_slices(old, new, covered).select("cycle", "issue_type",
                                                                                   "issue_key").collect())
    for _ in range(2):  # re-run replaces, counts stable
        sinks.replace_log_slices(new, covered, root)
        got = sorted(tuple(r) for r in spark.read.parquet(root).select("cycle", "issue_type", "issue_key").collect())
        assert got == expected == [(1996, "duplicate_key", "10"), (1996, "null_rate", "SUB_ID")]


def test_streaming_ingest_is_incremental(spark, tmp_path):
    landing = os.path.join(str(tmp_path), "landing")
    os.makedirs(landing)
    table, ckpt = os.path.join(str(tmp_path), "cm"), os.path.join(str(tmp_path), "ckpt")
    line = "|".join(["C00000001", "NAME", "", "", "", "", "", "123456789", "P", "H", "DEM", "Q", "", "", "H00000001"])
    with open(os.path.join(landing, "a.txt"), "w") as fh:
        fh.write(line + "\n" + line.replace("C00000001", "C00000002") + "\n")
    start_ingest(spark, landing, LAYOUTS["cm"], 2026, table, ckpt).awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    with open(os.path.join(landing, "b.txt"), "w") as fh:
        fh.write(line.replace("C00000001", "C00000003") + "\n")
    start_ingest(spark, landing, LAYOUTS["cm"], 2026, table, ckpt).awaitTermination(120)
    df = spark.read.parquet(table)
    assert df.count() == 3
    assert df.where(F.col("CMTE_ZIP") == "12345").count() == 3


def test_render_scan_is_pruned_and_shared(spark, sf):
    """Renders read only the used source columns and shuffle nothing; where the session asks for a spread,
    tables of one source share one exchange."""
    from ledgerline.plans.joins import SPREAD
    from ledgerline.plans.tables import lines

    plan = lines(spark, sf, "indiv")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan and "l_comment" not in plan and "l_shipinstruct" not in plan
    assert "Exchange" not in plan
    spark.conf.set(SPREAD, "4")
    try:
        both = lines(spark, sf, "indiv").unionByName(lines(spark, sf, "oppexp"))
    finally:
        spark.conf.unset(SPREAD)
    both.write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        static = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in static


def test_tables_and_key_sets_shared_per_session(spark, sf):
    from ledgerline.operators.checks import run_tests
    from ledgerline.plans.tables import Tables

    t = Tables(spark, sf)
    assert Tables(spark, sf) is t and t.get("cm") is Tables(spark, sf).cm
    run_tests(t.get, ("relationships",), parents=t.parents)
    assert set(t.parents) == {("cn", "CAND_ID"), ("cm", "CMTE_ID")}
