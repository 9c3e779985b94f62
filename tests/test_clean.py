"""Edge strings with the values the source engine produces."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.clean import clean

CASES = {
    "b": [("12", 12), (" 7 ", 7), ("\t8", 8), ("+5", 5), ("123.6", 124), ("123.4", 123), ("2.5", 3),
          ("-2.5", -3), (".5", 1), ("5.", 5), ("1e3", 1000), ("4040820261435319057", 4040820261435319057),
          ("9223372036854775808", None), ("1,000", None), ("$5", None), ("(5)", None), ("5d", None),
          ("true", None), ("NaN", None), ("", None), (None, None),
          ("2.49999999999", 2), ("0.49999999999", 0), ("0.4999999999999999999999", 0), ("249999999999e-11", 2),
          ("0x1F", 31), ("0X1f", 31), ("-0x1F", None), ("0x", None), ("0x1_F", 31), ("0b11", 3),
          ("0xFFFFFFFFFFFFFFFFFF", None), ("1_000", 1000), ("_1", None), ("1_", None), ("1__0", None),
          ("1_0.5", 11), ("1_0e1", 100)],
    "h": [("12", 12), ("123.6", 124), ("99999", None), ("-2.5", -3)],
    "y": [("2026", 2026), (" 2026 ", 2026), ("26", None), ("20.6", 21), ("12.5", 13), ("-123", -123),
          ("abcd", None), ("1e10", None)],
    "m": [("12.345", Decimal("12.35")), ("12.355", Decimal("12.36")), ("-12.345", Decimal("-12.35")),
          ("1e3", Decimal("1000.00")), ("999999999999.99", Decimal("999999999999.99")),
          ("9999999999999.99", None), ("1_000", Decimal("1000.00")), ("1__0", None), ("0x1F", None),
          ("1,000", None), ("$5", None), ("(5)", None), ("  ", None)],
    "p": [("55.12345", Decimal("55.1235")), ("100", Decimal("100.0000")), ("1000", None), ("999.99995", None)],
    "d": [("01052026", dt.date(2026, 1, 5)), ("02292024", dt.date(2024, 2, 29)), ("010526", dt.date(26, 1, 5)),
          ("0105202", dt.date(202, 1, 5)), ("1052026", None), ("13012026", None), ("02302026", None),
          ("00000000", None), ("01052026x", None), ("010520266", None), ("  01052026 ", dt.date(2026, 1, 5))],
    "D": [("01/05/2026", dt.date(2026, 1, 5)), ("1/5/2026", dt.date(2026, 1, 5)), ("01/05/26", dt.date(26, 1, 5)),
          ("13/01/2026", None), ("02/30/2026", None), ("01/05/20260", None), ("01052026", dt.date(2026, 1, 5))],
    "z": [("123456789", "12345"), (" 12345-6789", "12345"), ("1234", "1234"), ("   ", None),
          ("\t12345", "\t1234")],
    "s": [("", None), (" sp ", " sp "), ("NULL", "NULL"), ("N/A", "N/A")],
}


@pytest.mark.parametrize("kind", sorted(CASES))
def test_clean_kind(spark, kind):
    rows = CASES[kind]
    df = spark.createDataFrame([(x,) for x, _ in rows], "x string")
    got = [r[0] for r in df.select(clean(kind, F.col("x"))).collect()]
    assert got == [e for _, e in rows]
