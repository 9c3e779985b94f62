"""Generated code within what the JVM compiles, and files dealt by size."""

from __future__ import annotations

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.clean import to_money
from ledgerline.plans.session import JIT_BYTES
from ledgerline.sources.delimited import field_count_ok, line_shape_ok, shaped_fields, split_fields
from ledgerline.sources.render import render_lines, write_quoted_files

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def lineitem(spark, tmp_path):
    """600 lines in four files, ship dates in two cycles."""
    rows = [(i, i % 40, i % 7, i % 7 + 1, 1.0, 10.5 * i, 0.0, 0.0, "R", "O", datetime.datetime(1995 + i % 2 * 2, 3, 1 + i % 20))
            for i in range(600)]
    schema = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_rendering_lowers_the_method_limit(spark, lineitem):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        lines = render_lines(spark, lineitem, "pas2")
        assert int(spark.conf.get(LIMIT)) <= JIT_BYTES
        assert lines.count() == 600
    finally:
        spark.conf.set(LIMIT, before)


def test_generators_hold_no_line_expression(spark, lineitem):
    plan = render_lines(spark, lineitem, "indiv")._jdf.queryExecution().optimizedPlan().toString()
    generators = [line for line in plan.splitlines() if "Generate" in line]
    assert generators and not any("concat_ws" in line for line in generators)


def test_delimiters_are_counted_in_bytes(spark):
    texts = ["a|b|c", "a|b|c|", "a|b|c|d", "a|b|c|d|", "ä|ß|€", "€|€|€|", "", "|||", "||"]
    got = [r.ok for r in spark.createDataFrame([(t,) for t in texts], "v string").select(line_shape_ok(F.col("v"), 3).alias("ok")).collect()]
    assert got == [True, True, False, False, True, True, True, True, True]


def test_money_with_commas_is_no_number(spark):
    texts = ["1,000", "1_000.5", " 12.345 ", "", None, ",", "-3"]
    got = [r.m for r in spark.createDataFrame([(t,) for t in texts], "v string").select(to_money(F.col("v")).cast("string").alias("m")).collect()]
    assert got == [None, "1000.50", "12.35", None, None, None, "-3.00"]


def test_a_cycle_with_quotes_is_written_by_several_tasks(spark, lineitem, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "4096")
        write_quoted_files(spark, lineitem, f"{tmp_path}/out")
    finally:
        spark.conf.set(size, before)
    for cycle in (1996, 1998):
        assert len(glob.glob(f"{tmp_path}/out/cycle={cycle}/part-*")) > 1


def test_shaped_lines_are_split_once(spark):
    texts = ["a|b|c", "a|b|c|", "a|b|c|d", "", "a", "|||"]
    df = shaped_fields(spark.createDataFrame([(t,) for t in texts], "value string"), 3)
    old = split_fields(spark.createDataFrame([(t,) for t in texts], "value string")).where(field_count_ok(F.col("_parts"), 3))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, old.collect()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
