"""End-to-end runs on ZIP archives written from the fixture lines into a temp directory."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import manifest as I
from ledgerline.plans import runs
from ledgerline.plans.tables import lines
from ledgerline.sources.layouts import LAYOUTS


def test_load_audit_report(spark, sf, tmp_path):
    root = str(tmp_path)
    archives = os.path.join(root, "archives")
    rows = []
    for t in ("cm", "cn", "pas2"):
        by_cycle = {}
        for r in lines(spark, sf, t).where(F.col("cycle").isin(1998, 2000)).collect():
            by_cycle.setdefault(r.cycle, []).append(r.value)
        for cycle, vals in by_cycle.items():
            yy = str(cycle)[-2:]
            rel = f"data/{cycle}/{t}{yy}.zip"
            os.makedirs(os.path.join(archives, f"data/{cycle}"), exist_ok=True)
            with zipfile.ZipFile(os.path.join(archives, rel), "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(LAYOUTS[t].member_for(cycle), ("\r\n".join(vals) + "\r\n").encode())
            rows.append((cycle, t, rel, LAYOUTS[t].member_for(cycle), f"{t}_{cycle}", 0))
    # Two over-long lines are rejected; one member has none but a blank line.
    rel = "data/1998/pas298.zip"
    with zipfile.ZipFile(os.path.join(archives, rel), "a", zipfile.ZIP_DEFLATED) as zf:
        kept = zf.read(LAYOUTS["pas2"].member_for(1998))
    with zipfile.ZipFile(os.path.join(archives, rel), "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(LAYOUTS["pas2"].member_for(1998), kept + b"\n".join([b"|".join([b"x"] * 40)] * 2) + b"\n")
    manifest = spark.createDataFrame(
        rows, "cycle int, table_name string, zip_path string, source_entry string, target_table string, position int")
    wh = os.path.join(root, "warehouse")
    loaded = runs.load_cycle(spark, manifest, archives, wh).collect()
    hist = {(r.table_name, r.cycle): r.row_count for r in loaded}
    assert {(r.table_name, r.cycle): r.rejected_rows for r in loaded if r.rejected_rows} == {("pas2", 1998): 2}
    expected = {(t, cy) for cy, t, *_ in rows}
    assert set(hist) == set(expected)
    typed_pas2 = spark.read.parquet(os.path.join(wh, "pas2"))
    assert typed_pas2.count() == sum(v for (t, _), v in hist.items() if t == "pas2") > 0

    log, summ = os.path.join(root, "qa_issue_log"), os.path.join(root, "qa_run_summary")
    for _ in range(2):  # idempotent re-run
        runs.audit_run(spark, wh, log, summ, ["cm", "cn", "pas2"])
        n_log = spark.read.parquet(log).count()
        n_sum = spark.read.parquet(summ).count()
    assert n_log > 0 and n_sum > 0
    assert spark.read.parquet(log).where("issue_type = 'duplicate_key' and table_name = 'pas2'").count() > 0

    rr = os.path.join(root, "runs", "2000")
    os.makedirs(rr)
    with open(os.path.join(rr, "run_results.json"), "w") as fh:
        json.dump({"results": [{"unique_id": "model.x.pas2", "execution_time": 1.5},
                               {"unique_id": "model.x.cm", "execution_time": "n/a"},
                               {"unique_id": "test.x.not_null", "execution_time": 2.0}]}, fh)
    rep = runs.timing_report(spark, os.path.join(rr, "run_results.json"), manifest.where("cycle = 2000"), wh,
                             "t", "spark", "2026-01-01T00:00:00")
    got = {(r.scope, r.table_name): (r.duration_ms, r.status) for r in rep.collect()}
    assert got[("fact", "pas2")] == (1500, "success")
    assert got[("dimension", "cm")] == (None, "success")
    assert got[("summary", "")] == (1500, "success")

    # A reload of an empty member clears its cycle, and the next audit its issues.
    empty = manifest.where("table_name = 'pas2' and cycle = 1998")
    with zipfile.ZipFile(os.path.join(archives, "data/1998/pas298.zip"), "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(LAYOUTS["pas2"].member_for(1998), b"\n")
    again = runs.load_cycle(spark, empty, archives, wh).collect()
    assert [(r.cycle, r.row_count) for r in again] == [(1998, 0)]
    assert {r.cycle for r in spark.read.parquet(os.path.join(wh, "pas2")).select("cycle").distinct().collect()} == {2000}
    runs.audit_run(spark, wh, log, summ, ["cm", "cn", "pas2"])
    assert spark.read.parquet(log).where("run_id = 1 and table_name = 'pas2' and cycle = 1998").count() == 0
    passed = spark.read.parquet(summ).where("run_id = 1 and table_name = 'pas2' and cycle = 1998")
    assert {r.status for r in passed.collect()} == {"pass"} and passed.count() > 4
