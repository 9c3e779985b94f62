"""Planted-dirt counts and structural invariants at sf0.001 (no check passes vacuously)."""

from pyspark.sql import functions as F

from ledgerline.operators import audits as A
from ledgerline.operators import review as R
from ledgerline.plans.tables import Tables


def test_planted_counts(spark, sf):
    t = Tables(spark, sf)
    pas2 = t.get("pas2", keep_raw=("TRANSACTION_AMT",))
    row = pas2.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("CAND_ID").isNull()).alias("null_cand"),
        F.count_if(F.col("SUB_ID").isNull()).alias("null_sub"),
        F.count_if(F.col("CMTE_ID") == "C99999999").alias("orphan_cmte"),
        F.count_if(F.col("TRANSACTION_AMT_raw") == "").alias("amt_blank"),
        F.count_if((F.col("TRANSACTION_AMT_raw") != "") & F.col("TRANSACTION_AMT").isNull()).alias("amt_bad"),
    ).first()
    assert (row.rows, row.null_cand, row.null_sub, row.orphan_cmte, row.amt_blank, row.amt_bad) == (
        6000, 207, 218, 281, 900, 458 + 88)  # '1,000' and '0x1F'; '1_000.5' is a number
    per_cycle = t.ccl.groupBy("cycle").agg(F.count(F.lit(1)).alias("n"),
                                           F.count_if(F.col("CAND_ID").startswith("X")).alias("orphans"))
    assert {(r.n, r.orphans) for r in per_cycle.collect()} == {(10, 1)}


def test_inference_classes_partition_null_rows(spark, sf):
    t = Tables(spark, sf)
    summary = {r.inference: r.rows for r in
               R.infer_candidate_summary(t.pas2, t.ccl).groupBy("inference").agg(F.sum("rows").alias("rows")).collect()}
    assert summary == {"unique": 156, "ambiguous": 24, "none": 27}
    assert sum(summary.values()) == R.null_key_profile(t.pas2).agg(F.sum("null_rows")).first()[0]


def test_duplicate_summary_equals_issue_sum(spark, sf):
    t = Tables(spark, sf)
    df = t.get("pas2").select("cycle", "SUB_ID")
    issues = A.duplicate_key_issues(df, "pas2").groupBy("cycle").agg(F.sum("issue_count").alias("s"))
    summ = A.duplicate_key_summary(df, "pas2").select("cycle", "metric_value")
    j = summ.join(issues, "cycle", "left").collect()
    assert j and all(float(r.s or 0) == r.metric_value for r in j)
    assert any(r.metric_value > 0 for r in j)


def test_orphan_matched_null_add_up(spark, sf):
    t = Tables(spark, sf)
    m = A.referential_orphans(t.get, "pas2").where(F.col("issue_key") == "pas2.CMTE_ID->cm.CMTE_ID")
    orphans = m.agg(F.sum("issue_count")).first()[0]
    pas2 = t.pas2
    cm_keys = t.cm.select("cycle", F.col("CMTE_ID").alias("k")).distinct()
    matched = pas2.join(cm_keys, (pas2.cycle == cm_keys.cycle) & (pas2.CMTE_ID == cm_keys.k)).count()
    nulls = pas2.where(F.col("CMTE_ID").isNull()).count()
    assert orphans > 0 and orphans + matched + nulls == pas2.count()


def test_unique_issue_ids_are_consecutive(spark, sf):
    t = Tables(spark, sf)
    issues = A.duplicate_key_issues(t.get("pas2").select("cycle", "SUB_ID"), "pas2").withColumn(
        "detected_at", F.lit(None).cast("timestamp_ntz"))
    ids = [r.issue_id for r in A.assign_issue_ids(issues, mode="unique", existing_max=10).collect()]
    assert sorted(ids) == list(range(11, 11 + len(ids))) and len(ids) > 0
    batch = {r.issue_id for r in A.assign_issue_ids(issues, mode="batch", existing_max=10).collect()}
    assert batch == {11}
    # Several range partitions: ids follow (cycle, issue_key nulls first) across partition borders.
    rows = A.assign_issue_ids(issues, mode="unique", existing_max=0, partitions=5).collect()
    by_id = [(r.cycle, r.issue_key) for r in sorted(rows, key=lambda r: r.issue_id)]
    assert by_id == sorted(by_id, key=lambda k: (k[0], k[1] is not None, k[1] or ""))
    assert sorted(r.issue_id for r in rows) == list(range(1, len(rows) + 1))
