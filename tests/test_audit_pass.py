"""Several audits from one scan per table give what each audit gives by itself."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import audits as A
from ledgerline.plans import q_audits as Q
from ledgerline.plans import q_refresh as R
from ledgerline.sources.delimited import parse_lines
from ledgerline.sources.layouts import ALL_TABLES, FACTS, LAYOUTS

RAW = ("TRANSACTION_AMT", "TRANSACTION_DT")


def _lines(name: str) -> list[tuple]:
    """Lines with blanks, repeated, absent and odd keys; a row without a cycle."""
    out = []
    for i in range(24):
        row = {c: "" if (i + j) % 5 == 0 else f"{c[:2]}{i % 4}" for j, c in enumerate(LAYOUTS[name].names)}
        row |= {"SUB_ID": ["", "7", "0x7", "7.4", str(i)][i % 5], "LINKAGE_ID": ["", "9", str(i)][i % 3], "CMTE_ID": ["", "C1", "C2", "C9"][i % 4],
                "CAND_ID": ["H1", "", "H8"][i % 3], "TRANSACTION_AMT": ["5", "x", "20000", "60000", "-1", ""][i % 6],
                "TRANSACTION_DT": ["01021996", "13011996", "", "01022001"][i % 4]}
        cycle = None if i == 23 else 1996 + i % 2 * 2
        out.append((cycle, "|".join(row[c] for c in LAYOUTS[name].names)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    typed = {}
    for n in ALL_TABLES:
        frame = spark.createDataFrame(_lines(n), "cycle int, value string")
        typed[n] = parse_lines(frame, LAYOUTS[n], keep_raw=RAW if n in FACTS else ())
    return typed


@pytest.fixture(scope="module")
def cycles(spark):
    return spark.createDataFrame([(1994,), (1996,), (1998,)], "cycle int")


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_one_scan_equals_each_audit(tables, cycles):
    names = ("cn", "pas2", "ccl")
    groups, wide = A.audit_pass(tables.get, names, {"d": (0.0, 50000.0), "old": (0.0, 10000.0)})
    keyed = A.pass_duplicate_issues(groups)
    for n in names:
        assert _rows(A.pass_metrics(wide, n, ("null_rate",), cycles=cycles)) == _rows(A.null_rate(tables[n], n, cycles=cycles))
        assert _rows(A.pass_metrics(wide, n, ("referential_orphan",), cycles=cycles)) == _rows(A.referential_orphans(tables.get, n, cycles=cycles))
        own = A.pass_metrics(wide, n, ("amount_date_domain",), domain="old", cycles=cycles)
        assert (own is None) == (n not in FACTS)
        if n in FACTS:
            assert _rows(own) == _rows(A.amount_date_domain(tables[n], n, hi=10000.0, cycles=cycles))
            own = A.pass_metrics(wide, n, ("amount_date_domain",), cycles=cycles)
            assert _rows(own) == _rows(A.amount_date_domain(tables[n], n, cycles=cycles))
        found = A.duplicate_key_issues(tables[n], n)
        assert found.count() and _rows(keyed.where(F.col("table_name") == n)) == _rows(found)
        assert _rows(A.pass_duplicate_summary(wide, n, cycles=cycles)) == _rows(A.duplicate_key_summary(tables[n], n, cycles=cycles))


def test_empty_tables(tables, cycles):
    empty = {n: df.limit(0) for n, df in tables.items()}
    groups, wide = A.audit_pass(empty.get, ("cm", "pas2"), {"d": (0.0, 50000.0)})
    assert groups.isEmpty() and wide.isEmpty()
    assert _rows(A.pass_metrics(wide, "cm", ("null_rate",), cycles=cycles)) == _rows(A.null_rate(empty["cm"], "cm", cycles=cycles))


@pytest.fixture
def source(spark, tmp_path):
    day = datetime.datetime
    items = [(i, i % 40, i % 7, i % 7 + 1, 1.0, 10.5 * i, 0.0, 0.0, "R", "O", day(1995 + i % 2 * 2, 3, 1 + i % 20)) for i in range(90)]
    spark.createDataFrame(items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, f"s{i}", i % 5) for i in range(12)], "s_suppkey bigint, s_name string, s_nationkey int"
                          ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(i, f"c{i}", i % 5, 1.5 * i) for i in range(12)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
                          ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("query", [Q.qa_issue_log, Q.qa_rerun_replace])
def test_results_read_no_lines_again(spark, source, query):
    plan = query(spark, source)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws(|" not in plan


def test_a_refresh_reads_each_table_once(spark, source, monkeypatch):
    passes = []
    monkeypatch.setattr(Q, "_null_rate", lambda t: passes.append("null_rate"))
    monkeypatch.setattr(Q, "_domain", lambda t, **kw: passes.append("domain"))
    once = Q.rerun_metrics
    monkeypatch.setattr(Q, "rerun_metrics", lambda t: passes.append("all") or once(t))
    assert R.refresh_issue_log(spark, source).count() > 0
    assert passes == ["all"]
