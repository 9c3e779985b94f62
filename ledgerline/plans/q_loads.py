"""Registered queries: scans, the eight typed loads, cleaning functions (A1, B, C)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.functions import clean as C
from ledgerline.operators.slots import slot_profile
from ledgerline.plans.catalog import register
from ledgerline.plans.joins import shared_folder
from ledgerline.plans.oracle_sql import duck_clean, lines_sql, typed_sql
from ledgerline.plans.tables import lines, typed
from ledgerline.sources.delimited import shaped_fields
from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.quoted import parse_records, read_records
from ledgerline.sources.render import QUOTED_CYCLE, quotable_sql, render_tables, write_quoted_files

# --- B1..B8: one typed load per layout -------------------------------------------------


def _load(table: str):
    def build(spark, sf_dir):
        return typed(spark, sf_dir, table)

    build.__name__ = f"load_{table}"
    return build


for _t in LAYOUTS:
    register(f"load_{_t}", f"select * from {typed_sql(_t)} t")(_load(_t))


# --- A1: the raw field split itself (before any cleaning) --------------------------------


@register(
    "scan_delimited",
    "select cycle, len(f) as n_fields, nullif(f[1], '') as field_1, nullif(f[16], '') as field_16, "
    "nullif(f[22], '') as field_22, nullif(f[23], '') as field_23 from ("
    f"select cycle, string_split(value, '|') as f from {lines_sql('pas2')} l where value <> '') s "
    "where len(f) <= 22 or (len(f) = 23 and f[23] = '')",
)
def scan_delimited(spark, sf_dir):
    """pas2 lines split on ``|``: field count, first/16th/last field, and the padded slot 23."""
    parts = F.col("_parts")
    df = shaped_fields(lines(spark, sf_dir, "pas2"), 22)
    return df.select(
        "cycle",
        F.size(parts).cast("bigint").alias("n_fields"),
        *[C.blank_to_null(F.get(parts, i - 1)).alias(f"field_{i}") for i in (1, 16, 22, 23)],
    )


# --- A1: files with quoted fields, one dialect per file ----------------------------------------


def _quoted_sql() -> str:
    """Fields straight from the rows where files are quoted, split at each delimiter where they are literal."""
    cycle, fields = quotable_sql()
    lay = LAYOUTS["indiv"]
    n = len(lay.columns)
    typed_cols = ", ".join(f"{duck_clean(k, f'f[{i + 1}]')} as {c}" for i, (c, k) in enumerate(lay.columns))
    return (f"with r as (select {cycle} as cycle, [{', '.join(fields)}] as f from lineitem), "
            f"s as (select cycle, case when {QUOTED_CYCLE} then f else string_split(array_to_string(f, '|'), '|') end as f from r) "
            f"select cycle, {typed_cols} from s where len(f) <= {n} or (len(f) = {n + 1} and f[{n + 1}] = '')")


@register("load_quoted", _quoted_sql())
def load_quoted(spark, sf_dir):
    """indiv rows read back from text files with delimiters, quotes and line ends inside quoted fields."""
    place = f"{shared_folder(spark)}/quoted-{uuid.uuid4().hex}"
    write_quoted_files(spark, sf_dir, place)
    return parse_records(read_records(spark, place), LAYOUTS["indiv"])


# --- A1: every slot of every layout ------------------------------------------------------------


def _fields_sql() -> str:
    parts = " union all ".join(
        f"select '{t}' as table_name, cycle, string_split(value, '|') as f, {len(lay.columns)} as n from {lines_sql(t)} l{i} "
        f"where value <> ''" for i, (t, lay) in enumerate(LAYOUTS.items()))
    return (f"with s as (select * from ({parts}) u where len(f) <= n or (len(f) = n + 1 and f[n + 1] = '')), "
            "v as (select table_name, cycle, unnest(range(1, len(f) + 1)) as slot, unnest(f) as v from s) "
            "select table_name, cycle, cast(slot as integer) as slot, count(*) as n_rows, count(nullif(v, '')) as n_filled, "
            "cast(sum(length(v)) as bigint) as n_chars, min(nullif(v, '')) as least, max(nullif(v, '')) as greatest, "
            "count(distinct nullif(v, '')) as n_distinct from v group by all")


@register("scan_fields", _fields_sql())
def scan_fields(spark, sf_dir):
    """Every slot of all eight layouts per cycle: rows, filled rows, characters, extremes, distinct texts."""
    return slot_profile(render_tables(spark, sf_dir, LAYOUTS))


# --- C: cleaning functions over every raw value of every landing column of their kind ----------

_CLEAN_KINDS = {
    "clean_postal5": "z",
    "clean_year4": "y",
    "clean_smallint": "h",
    "clean_bigint": "b",
    "clean_money": "m",
    "clean_percent": "p",
    "clean_date_mdy": "d",
    "clean_date_two_format": "D",
}


def _places(kind: str) -> dict[str, list[int]]:
    """Positions of the columns of a kind, by table."""
    found = {t: [i for i, (_, k) in enumerate(lay.columns) if k == kind] for t, lay in LAYOUTS.items()}
    return {t: at for t, at in found.items() if at}


def _clean_query(kind: str):
    def build(spark, sf_dir):
        raw = None
        for table, at in _places(kind).items():
            parts = F.col("_parts")
            rows = shaped_fields(lines(spark, sf_dir, table), len(LAYOUTS[table].columns))
            part = rows.select(F.explode(F.array(*[F.get(parts, i) for i in at])).alias("raw_value"))
            raw = part if raw is None else raw.unionByName(part)
        # Clean each distinct raw text once: partial aggregation keeps the shuffle
        # at (#distinct values), and the cleaning runs after it on fewer rows.
        counted = raw.groupBy("raw_value").agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.select("raw_value", C.clean(kind, F.col("raw_value")).alias("clean_value"), "n_rows")

    return build


def _clean_oracle(kind: str) -> str:
    unions = []
    for table, at in _places(kind).items():
        n = len(LAYOUTS[table].columns)
        values = ", ".join(f"f[{i + 1}]" for i in at)
        unions.append(
            f"select unnest([{values}]) as raw_value from (select string_split(value, '|') as f from {lines_sql(table)} l "
            f"where value <> '') s where len(f) <= {n} or (len(f) = {n + 1} and f[{n + 1}] = '')"
        )
    return (
        f"select raw_value, {duck_clean(kind, 'raw_value')} as clean_value, count(*) as n_rows "
        f"from ({' union all '.join(unions)}) r group by raw_value"
    )


for _name, _kind in _CLEAN_KINDS.items():
    register(_name, _clean_oracle(_kind))(_clean_query(_kind))
