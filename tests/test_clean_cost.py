"""Cleaning expressions that the JVM compiles: a text is not named once for each way to read it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.clean import clean
from ledgerline.sources.delimited import parse_lines
from ledgerline.sources.layouts import LAYOUTS


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["b", "h", "m"])
def test_rare_texts_are_named_once(spark, kind):
    plan = _plan(spark.createDataFrame([("7",)], "x string").select(clean(kind, F.col("x")).alias("y")))
    assert plan.count("regexp_replace") <= 2


def test_dates_pad_the_year_only(spark):
    plan = _plan(spark.createDataFrame([("01052026",)], "x string").select(clean("d", F.col("x")).alias("y")))
    assert plan.count("lpad") == 1


def test_dirt_beside_plain_texts(spark):
    line = ["C1"] + [""] * 20 + ["SUB"]
    at = LAYOUTS["pas2"].names.index
    want = []
    for sub, amount, date, out in [
        ("10", "12.345", "01052026", (10, Decimal("12.35"), dt.date(2026, 1, 5))),
        (" 1_0 ", "1_000.5", "  010526 ", (10, Decimal("1000.50"), dt.date(26, 1, 5))),
        ("0X1f", "0x1F", "13052026", (31, None, None)),
        ("2.5", "1,000", "01322026", (3, None, None)),
        ("0b11", "_1", "01002026", (3, None, None)),
        ("", "", "", (None, None, None)),
        ("1e3", "1e3", "02302026", (1000, Decimal("1000.00"), None)),
    ]:
        fields = list(line)
        fields[at("SUB_ID")], fields[at("TRANSACTION_AMT")], fields[at("TRANSACTION_DT")] = sub, amount, date
        want.append(("|".join(fields), out))
    lines = spark.createDataFrame([(2026, v) for v, _ in want], "cycle int, value string").coalesce(1)
    got = parse_lines(lines, LAYOUTS["pas2"]).select("SUB_ID", "TRANSACTION_AMT", "TRANSACTION_DT").collect()
    assert [tuple(r) for r in got] == [out for _, out in want]
