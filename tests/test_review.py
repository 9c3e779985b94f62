"""Issue-graph closure on a hand-made chain with a cycle (least depth per pair, any length)."""

from ledgerline.operators import model as M
from ledgerline.operators import review as R
from ledgerline.operators.review import explains_closure


def test_closure_chain_and_cycle(spark):
    issue = spark.createDataFrame([("a", 10), ("b", 40), ("c", 80), ("d", 5)],
                                  "issue_key string, detected_row_count bigint")
    edges = spark.createDataFrame(
        [("a", "b", "explains_part_of"), ("b", "c", "explains_part_of"), ("c", "b", "explains_part_of"),
         ("d", "a", "explains_part_of"), ("x", "y", "duplicate_of")],
        "from_issue_key string, to_issue_key string, relationship_type string")
    got = {(r.descendant_key, r.ancestor_key): (r.depth, r.explained_share)
           for r in explains_closure(issue, edges).collect()}
    assert got == {
        ("a", "b"): (1, 0.25), ("a", "c"): (2, 0.125), ("b", "c"): (1, 0.5), ("c", "b"): (1, 2.0),
        ("d", "a"): (1, 0.5), ("d", "b"): (2, 0.125), ("d", "c"): (3, 0.0625),
    }


def test_closure_follows_long_chains(spark):
    keys = [f"k{i}" for i in range(8)]
    issue = spark.createDataFrame([(k, 1) for k in keys], "issue_key string, detected_row_count bigint")
    edges = spark.createDataFrame([(a, b, "explains_part_of") for a, b in zip(keys, keys[1:])],
                                  "from_issue_key string, to_issue_key string, relationship_type string")
    got = {(r.descendant_key, r.ancestor_key): r.depth for r in explains_closure(issue, edges).collect()}
    assert got == {(keys[i], keys[j]): j - i for i in range(8) for j in range(i + 1, 8)} and len(got) == 28


def test_not_modified_fetch_is_unchanged(spark):
    from ledgerline.operators.manifest import fetch_change_status
    rows = [(2024, "cm", 1, "2024-01-01", "ok", "a"), (2024, "cm", 2, "2024-01-02", "not_modified", "b"),
            (2024, "cn", 3, "2024-01-01", "ok", None), (2024, "cn", 4, "2024-01-02", "ok", None),
            (2024, "ccl", 5, "2024-01-01", "ok", "a"), (2026, "ccl", 6, "2024-01-01", "error", "a")]
    f = spark.createDataFrame(rows, "cycle int, table_name string, fetch_id int, fetched_at string, fetch_status string, etag string")
    got = {(r.cycle, r.table_name): (r.change_status, r.n_fetches) for r in fetch_change_status(f).collect()}
    assert got == {(2024, "cm"): ("unchanged", 2), (2024, "cn"): ("changed", 2), (2024, "ccl"): ("new", 1), (2026, "ccl"): ("error", 1)}


def test_seed_tables_roll_up(spark, tmp_path):
    """A6 seeds (header CSV, fixed schema) feed the same roll-up and closure operators."""
    import os

    from ledgerline.operators.review import explains_closure, issue_rollup
    from ledgerline.sources.seeds import REVIEW_SCHEMAS, review_tables

    ts = "2026-01-01 10:00:00"
    rows = {
        "issue": [f"1,k1,t,data_quality_test,s,low,open,high,2026,raw,pas2,CAND_ID,test,nn,100,250.50,,,,me,{ts},{ts},,,",
                  f"2,k2,t,duplicate_id,s,low,accepted,medium,2026,raw,ccl,CAND_ID,query,q,4,75.00,,,,me,{ts},{ts},,,"],
        "issue_relationship": [f"1,2,1,explains_part_of,note,{ts}"],
        "issue_entity": ["1,1,table,pas2,x,affected_table,pas2,CAND_ID,", "2,2,committee,C1,x,r,pas2,OTHER_ID,",
                         "3,2,transaction,4040820261435319057,x,r,pas2,SUB_ID,"],
        "issue_evidence": [f"1,1,query_result,l,,txt,q,v,{ts},me"],
        "issue_decision": [f"1,2,investigate,r,me,{ts}", "2,2,accept,r,me,2026-01-02 10:00:00"],
        "issue_metric": [f"1,1,null_row_count,100,rows,{ts},q", f"2,2,affected_amount,75,dollars,{ts},q"],
    }
    root = str(tmp_path)
    for name, lines in rows.items():
        header = ",".join(c.split()[0] for c in REVIEW_SCHEMAS[name].split(", "))
        with open(os.path.join(root, f"{name}.csv"), "w") as fh:
            fh.write(header + "\n" + "\n".join(lines) + "\n")
    t = review_tables(spark, root)
    assert t["issue_entity"].where("entity_type = 'transaction'").first().entity_id == "4040820261435319057"
    got = {r.issue_key: (r.n_entities, r.n_evidence, r.n_metrics, r.latest_decision)
           for r in issue_rollup(t).collect()}
    assert got == {"1": (1, 1, 1, None), "2": (2, 0, 1, "accept")}
    share = explains_closure(t["issue"], t["issue_relationship"]).first()
    assert (share.descendant_key, share.ancestor_key, share.explained_share) == ("2", "1", 0.04)


def test_report_sinks(spark, tmp_path):
    import os

    from ledgerline.operators.timing import REPORT_COLUMNS
    from ledgerline.sources import sinks

    df = spark.createDataFrame([(2026, "l", "spark", "fact", "pas2", 12, 5, "success", "a", "b", "", "t")],
                               ", ".join(f"{c} string" if c != "cycle" else "cycle int" for c in REPORT_COLUMNS))
    sinks.write_report_csv(df, os.path.join(str(tmp_path), "csv"), REPORT_COLUMNS)
    back = spark.read.option("header", True).csv(os.path.join(str(tmp_path), "csv"))
    assert back.columns == REPORT_COLUMNS and back.count() == 1
    sinks.write_report_json(df, os.path.join(str(tmp_path), "json"))
    assert spark.read.json(os.path.join(str(tmp_path), "json")).first().table_name == "pas2"


def test_repeated_and_null_committees_do_not_multiply_rows(spark):
    from ledgerline.operators import model as M
    from ledgerline.operators import review as R
    cm = spark.createDataFrame([(2000, "C1", "A", "DEM"), (2000, "C1", "B", None), (2000, None, "N", "REP")],
                               "cycle int, CMTE_ID string, CMTE_NM string, CMTE_PTY_AFFILIATION string")
    oth = spark.createDataFrame([(2000, 1, "C1", "C1", None, None), (2000, 2, None, "C9", None, None)],
                                "cycle int, SUB_ID bigint, CMTE_ID string, OTHER_ID string, TRANSACTION_DT date, "
                                "TRANSACTION_AMT decimal(14,2)")
    got = {r.SUB_ID: (r.source_committee_name, r.destination_committee_name)
           for r in M.fact_transfers(oth, cm).collect()}
    assert got == {1: ("B", "B"), 2: (None, None)}
    flows = M.money_by_party(oth, oth.limit(0), cm).collect()
    assert {(r.party, r.n_transactions, r.n_committees) for r in flows} == {("DEM", 1, 1), (None, 1, 0)}

    cn = spark.createDataFrame([(2000, "H1", n, "H", "CA", "01", 2000, "I") for n in ("X", "Y")],
                               "cycle int, CAND_ID string, CAND_NAME string, CAND_OFFICE string, CAND_OFFICE_ST "
                               "string, CAND_OFFICE_DISTRICT string, CAND_ELECTION_YR int, CAND_ICI string")
    ccl = spark.createDataFrame([(2000, "C1", "H1"), (2000, "C2", None)], "cycle int, CMTE_ID string, CAND_ID string")
    weball = spark.createDataFrame([(2000, "H1", 1), (2000, "H1", 2)], "cycle int, CAND_ID string, TTL_RECEIPTS int")
    rows = R.committee_candidates(ccl, cn, weball).collect()
    assert [(r.CMTE_ID, r.CAND_NAME, r.TTL_RECEIPTS) for r in rows] == [("C1", "Y", 2)]

    twice = spark.createDataFrame([(1998, "H1", "X"), (2000, "H1", "X"), (2000, "H1", "Y")],
                                  "cycle int, CAND_ID string, CAND_NAME string")
    last = M.latest_per_key(twice, "CAND_ID").collect()
    assert [(r.latest_cycle, r.CAND_NAME, r.n_cycles) for r in last] == [(2000, "Y", 2)]


def test_ambiguous_linkage_rows(spark):
    rows = [(2000, "C1", "X"), (2000, "C1", "X"), (2000, "C1", "Y"), (2000, "C2", "X"), (2002, "C1", "X"), (2000, "C3", None), (2000, None, "X"), (2000, None, "Y")]
    ccl = spark.createDataFrame(rows, "cycle int, CMTE_ID string, CAND_ID string")
    got = sorted(tuple(r) for r in R.ambiguous_linkage(ccl).collect())
    assert got == [(2000, "C1", "X", 2, 2), (2000, "C1", "Y", 2, 1)]
    assert R.ambiguous_linkage(ccl.where("false")).count() == 0


def test_canonical_union_keeps_every_row_and_column(spark):
    a = spark.createDataFrame([(2000, "C1", 1)], "cycle int, CMTE_ID string, SUB_ID bigint")
    b = spark.createDataFrame([(2002, "C2", "H1"), (2002, "C2", "H1")], "cycle int, CMTE_ID string, CAND_ID string")
    got = M.canonical_union({"a": a, "b": b})
    assert got.columns == ["source_table", "election_cycle", "committee_id", "transaction_id", "candidate_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", 2000, "C1", 1, None), ("b", 2002, "C2", None, "H1"), ("b", 2002, "C2", None, "H1")]
