"""Headerless pipe-delimited text -> typed DataFrame (declared layout).

Semantics of the landing scan (``delim='|'``, no header, all text, short rows
NULL-padded, bad rows skipped):

* blank lines are dropped, lines that are not valid UTF-8 are dropped;
* fields are taken literally -- quoting is *off*, so ``"open`` stays as is;
* a row with fewer fields is padded with NULL (``get`` beyond the end);
* a row with more fields is rejected, except a single empty trailing field
  (a trailing ``|`` on every row is accepted);
* empty fields become NULL, then each column gets its layout cleaning rule.

Why not ``spark.read.csv``: its quote handling swallows delimiters after an
open quote and PERMISSIVE mode silently truncates over-long rows.  Splitting
a ``text`` scan keeps one narrow, codegen'd stage and no shuffle: the parse is
embarrassingly parallel over file splits.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.clean import clean
from ledgerline.sources.layouts import LAYOUTS, Layout

_PARTS = "_parts"


def field_count_ok(parts: Column, n: int) -> Column:
    """Row shape rule on a split array: at most ``n`` fields, or ``n + 1`` with an empty last one."""
    return (F.size(parts) <= n) | ((F.size(parts) == n + 1) & (F.get(parts, n) == F.lit("")))


def line_shape_ok(value: Column, n: int | Column) -> Column:
    """The same rule from the raw line, without splitting: what comes before the ``n``-th delimiter is the line, or all but its end.

    In bytes; a line of fewer delimiters is returned as it is, not copied.
    """
    head = F.call_function("substring_index", value, F.lit("|"), n if isinstance(n, Column) else F.lit(n))
    return F.octet_length(value) - F.octet_length(head) <= 1


def width_of(table_name: Column) -> Column:
    """Number of columns of the layout that ``table_name`` names; NULL if there is none."""
    n = F.lit(None).cast("int")
    for lay in LAYOUTS.values():
        n = F.when(table_name == lay.name, len(lay.columns)).otherwise(n)
    return n


def usable(value: Column) -> Column:
    return (value != F.lit("")) & F.is_valid_utf8(value)


def split_fields(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return lines.where(usable(F.col(value_col))).withColumn(_PARTS, F.split(F.col(value_col), r"\|", -1))


def shaped_fields(lines: DataFrame, n: int, value_col: str = "value") -> DataFrame:
    """``split_fields`` of the lines with the shape of ``n`` fields: a rule on the array would split again in the pushed filter."""
    return split_fields(lines.where(line_shape_ok(F.col(value_col), n)), value_col)


def parse_lines(
    lines: DataFrame,
    layout: Layout,
    *,
    value_col: str = "value",
    keep: Iterable[str] = ("cycle",),
    keep_raw: Iterable[str] = (),
    filtered: bool = False,
) -> DataFrame:
    """Typed rows of ``layout`` from a frame of raw lines.

    ``keep`` columns of ``lines`` (e.g. ``cycle``) pass through in front.
    ``keep_raw`` adds ``<col>_raw`` = the untrimmed text field for audits that
    must tell "blank" from "unparseable".  ``filtered`` is for queries that
    filter on typed columns: the same rows, at the price of one more operator.
    """
    n = len(layout.columns)
    keep = [c for c in keep if c in lines.columns]
    parts = F.col(_PARTS)
    v = F.col(value_col)
    if filtered:
        # One generated row a line, none if its shape is wrong.  Filters stay above a generator and read the parts; inlined
        # below a projection they would split the line again for each time that they name a field.  Its lambda ends the
        # compiled stage, so that what counts the rows is compiled by itself.  A split ends behind field n + 1, which is
        # empty or makes the row too long.
        shaped = F.filter(F.array(F.split(v, r"\|", n + 1)), lambda p: field_count_ok(p, n))
        split = lines.where(usable(v)).select(*keep, F.explode(shaped).alias(_PARTS))
    else:
        split = lines.where(usable(v) & line_shape_ok(v, n)).select(*keep, F.split(v, r"\|", -1).alias(_PARTS))
    typed = [clean(kind, F.get(parts, i)).alias(name) for i, (name, kind) in enumerate(layout.columns)]
    pos = {name: i for i, (name, _) in enumerate(layout.columns)}
    raws = [F.get(parts, pos[c]).alias(f"{c}_raw") for c in keep_raw]
    return split.select(*keep, *typed, *raws)


def rejected(value: Column, layout: Layout) -> Column:
    """Whether the scan skips a line: blank, invalid UTF-8 or too many fields."""
    return ~usable(value) | ~line_shape_ok(value, len(layout.columns))


def rejected_lines(lines: DataFrame, layout: Layout, value_col: str = "value") -> DataFrame:
    """Lines the scan skips: blank, invalid UTF-8 or too many fields."""
    return lines.where(rejected(F.col(value_col), layout))


def read_text_lines(spark: SparkSession, paths: str | list[str], cycle: int | None = None) -> DataFrame:
    """Plain (already extracted) landing files -> ``(cycle, source_file, value)``."""
    df = spark.read.text(paths).withColumn("source_file", F.input_file_name())
    if cycle is not None:
        df = df.withColumn("cycle", F.lit(int(cycle)))
    return df


def load_text(spark: SparkSession, paths: str | list[str], layout: Layout, cycle: int) -> DataFrame:
    """A1: scan plain landing text of one cycle into the typed layout."""
    return parse_lines(read_text_lines(spark, paths, cycle), layout)
