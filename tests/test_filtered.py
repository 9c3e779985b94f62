"""Filters on typed columns read the fields of a line that was split once."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.catalog import QUERIES, load_all
from ledgerline.sources.delimited import line_shape_ok, parse_lines
from ledgerline.sources.layouts import LAYOUTS

load_all()


@pytest.fixture
def tables(spark, tmp_path):
    """200 lines of 40 orders and a few suppliers."""
    rows = [(i // 5, i % 40, i % 7, i % 7 + 1, 1.0, 10.5 * i, 0.0, 0.0, "R", "O", datetime.datetime(1995 + i % 2 * 2, 3, 1 + i % 20))
            for i in range(200)]
    schema = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def splits(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("split(")


@pytest.mark.parametrize("name, tables_read", [("fact_filings", 4), ("dim_election_type", 4), ("affected_by_committee", 1)])
def test_a_line_is_split_once(spark, tables, name, tables_read):
    assert splits(QUERIES[name](spark, tables)) == tables_read


def test_filtered_parse_has_the_same_rows(spark):
    n = len(LAYOUTS["oth"].columns)
    good = [f"C{i}" + "|x" * 16 + f"|{number}" + "|x" * (n - 18) for i, number in enumerate(["7", "", "x", "2.5", " 9 "])]
    bad = ["", "|" * n, good[0] + "|", good[0] + "|x", "C9|x", good[1] + "||"]
    lines = spark.createDataFrame([(2000, v) for v in [*good, *bad, None]], "cycle int, value string")
    plain, filtered = (parse_lines(lines, LAYOUTS["oth"], filtered=f) for f in (False, True))
    assert plain.count() == 8
    for condition in ("true", "FILE_NUM is not null", "FILE_NUM is null", "CMTE_ID = 'C9'"):
        assert sorted(map(str, filtered.where(condition).collect())) == sorted(map(str, plain.where(condition).collect()))


def test_shape_from_the_line_is_that_of_its_fields(spark):
    texts = ["x" * a + "|" * b + end for a in (0, 2) for b in range(6) for end in ("", "y", "é|", "|z")]
    lines = spark.createDataFrame([(t, 3 >= t.count("|") + 1 or (t.count("|") == 3 and t.endswith("|"))) for t in texts], "v string, fits boolean")
    assert lines.where(line_shape_ok(F.col("v"), 3) != F.col("fits")).count() == 0
