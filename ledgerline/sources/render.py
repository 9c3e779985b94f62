"""Landing-line fixtures rendered from the driver tables.

No real bulk files exist in the test environment, so every load, check and
audit runs on pipe-delimited lines *rendered* from the TPC-H-like tables.
The rendering is written as SQL expression text that both Spark SQL and the
DuckDB oracle evaluate identically (only date formatting differs per dialect),
so the two engines start from byte-identical landing lines.  The dirt rules
(blank amounts, ``1,000``, month 13, padded dates, orphan keys, blank ids)
are planted deterministically so no check passes vacuously.

Fact lines come from ``lineitem`` and land in the cycle of their ship date
(``year + year % 2``).  Dimension lines come from ``supplier`` / ``customer``
and are published once per cycle in ``DIM_CYCLES``.

Output of every renderer: ``(cycle int, value string)`` -- exactly what a
text scan of ``data/<cycle>/<table><yy>.zip`` yields (plus its cycle).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.joins import dealt, spread
from ledgerline.plans.session import compiled_methods
from ledgerline.sources.layouts import LAYOUTS

# Cycles for which dimension files are rendered (fixture parameter).
DIM_CYCLES = (1996, 2002)  # inclusive range, step 2


def _k(x: str) -> str:
    return f"lpad(cast({x} as string), 8, '0')"


def _money(x: str) -> str:
    return f"cast(cast({x} as decimal(14,2)) as string)"


def _mdy(d: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({d}, 'MMddyyyy')"
    return f"strftime({d}, '%m%d%Y')"


FACT_CYCLE = "cast(year(l_shipdate) + year(l_shipdate) % 2 as int)"


def _fact_common(dialect: str) -> dict[str, str]:
    mdy = _mdy("l_shipdate", dialect)
    return {
        "CMTE_ID": f"case when l_partkey % 23 = 0 then 'C99999999' else 'C' || {_k('l_suppkey')} end",
        "AMNDT_IND": "case when l_linestatus = 'O' then 'N' else 'A' end",
        "RPT_TP": "'Q' || cast(quarter(l_shipdate) as string)",
        "TRANSACTION_PGI": f"case when l_linestatus = 'O' then 'P' else 'G' end || cast({FACT_CYCLE} as string)",
        "IMAGE_NUM": "cast(year(l_shipdate) as string) || lpad(cast(l_orderkey as string), 10, '0')",
        "TRANSACTION_TP": "case l_linenumber % 4 when 0 then '15' when 1 then '15E' when 2 then '24K' else '10' end",
        "ENTITY_TP": "case when l_partkey % 3 = 0 then 'ORG' else 'IND' end",
        "NAME": "'DONOR ' || cast(l_partkey as string)",
        "CITY": "'CITY ' || cast(l_partkey % 50 as string)",
        "STATE": "substr('CANYTXFLILPAOHGAMINC', cast((l_partkey % 10) * 2 + 1 as int), 2)",
        "ZIP_CODE": ("case when l_linenumber = 3 then '  ' || lpad(cast((l_partkey * 7919) % 100000 as string), 5, '0')"
                     " || '-1234' else lpad(cast((l_partkey * 7919) % 1000000000 as string), 9, '0') end"),
        "EMPLOYER": "case when l_partkey % 5 = 0 then '' else 'EMPLOYER ' || cast(l_partkey % 40 as string) end",
        "OCCUPATION": "case l_returnflag when 'R' then 'RETIRED' when 'A' then 'ATTORNEY' else 'ENGINEER' end",
        "TRANSACTION_DT": (
            "case when l_orderkey % 13 = 0 then ''"
            f" when l_orderkey % 17 = 0 then '13' || substr({mdy}, 3)"
            f" when l_orderkey % 19 = 0 then '  ' || {mdy} || ' '"
            f" when l_orderkey % 37 = 0 then substr({mdy}, 1, 4) || cast(year(l_shipdate) + 10 as string)"
            f" else {mdy} end"),
        "TRANSACTION_AMT": (f"case when l_partkey % 7 = 0 then '' when l_partkey % 11 = 0 then '1,000'"
                            f" when l_partkey % 53 = 0 then '1_000.5' when l_partkey % 59 = 0 then '0x1F'"
                            f" else {_money('l_extendedprice')} end"),
        "OTHER_ID": f"case when l_linenumber = 1 then 'C' || {_k('l_partkey % 50')} else '' end",
        "TRAN_ID": "'SA' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
        "FILE_NUM": "cast(l_orderkey + 1000000 as string)",
        "MEMO_CD": "case when l_linenumber = 7 then 'X' else '' end",
        "MEMO_TEXT": "case when l_linenumber = 7 then 'EARMARKED' else '' end",
        "SUB_ID": "case when l_partkey % 31 = 0 then '' when l_partkey % 61 = 0 then '0x1F' when l_partkey % 67 = 0 "
                   "then cast(l_orderkey as string) || '.49999999999' when l_partkey % 71 = 0 then '1_0' || "
                   "cast(l_orderkey as string) else cast(l_orderkey * 10 + l_linenumber as string) end",
    }


def _indiv(dialect: str) -> list[str]:
    c = _fact_common(dialect)
    order = ("CMTE_ID AMNDT_IND RPT_TP TRANSACTION_PGI IMAGE_NUM TRANSACTION_TP ENTITY_TP NAME CITY STATE "
             "ZIP_CODE EMPLOYER OCCUPATION TRANSACTION_DT TRANSACTION_AMT OTHER_ID TRAN_ID FILE_NUM "
             "MEMO_CD MEMO_TEXT SUB_ID").split()
    return [c[n] for n in order]


def _oth(dialect: str) -> list[str]:
    c = _fact_common(dialect)
    c["OTHER_ID"] = f"'C' || {_k('(l_suppkey + l_linenumber) % 10')}"
    c["ENTITY_TP"] = "case when l_partkey % 3 = 0 then 'PAC' else 'PTY' end"
    order = ("CMTE_ID AMNDT_IND RPT_TP TRANSACTION_PGI IMAGE_NUM TRANSACTION_TP ENTITY_TP NAME CITY STATE "
             "ZIP_CODE EMPLOYER OCCUPATION TRANSACTION_DT TRANSACTION_AMT OTHER_ID TRAN_ID FILE_NUM "
             "MEMO_CD MEMO_TEXT SUB_ID").split()
    return [c[n] for n in order]


def _pas2(dialect: str) -> list[str]:
    c = _fact_common(dialect)
    c["OTHER_ID"] = f"'C' || {_k('l_suppkey')}"
    c["CAND_ID"] = f"case when l_orderkey % 29 = 0 then '' else 'H' || {_k('l_suppkey')} end"
    c["TRANSACTION_TP"] = "case l_linenumber % 2 when 0 then '24K' else '24E' end"
    order = ("CMTE_ID AMNDT_IND RPT_TP TRANSACTION_PGI IMAGE_NUM TRANSACTION_TP ENTITY_TP NAME CITY STATE "
             "ZIP_CODE EMPLOYER OCCUPATION TRANSACTION_DT TRANSACTION_AMT OTHER_ID CAND_ID TRAN_ID FILE_NUM "
             "MEMO_CD MEMO_TEXT SUB_ID").split()
    return [c[n] for n in order]


def _oppexp(dialect: str) -> list[str]:
    c = _fact_common(dialect)
    purpose = "case l_partkey % 4 when 0 then 'CONSULTING' when 1 then 'TRAVEL' when 2 then 'PAYROLL' else 'ADVERTISING' end"
    return [
        c["CMTE_ID"], c["AMNDT_IND"],
        ("case when l_orderkey % 41 = 0 then '99999' when l_orderkey % 43 = 0 then "
         "cast(year(l_shipdate) as string) || '.4' else cast(year(l_shipdate) as string) end"),
        c["RPT_TP"], c["IMAGE_NUM"], "'17'", "'F3X'", "'SB17'",
        "'VENDOR ' || cast(l_partkey % 300 as string)", c["CITY"], c["STATE"], c["ZIP_CODE"],
        c["TRANSACTION_DT"], c["TRANSACTION_AMT"], c["TRANSACTION_PGI"], purpose,
        "lpad(cast(l_partkey % 4 + 1 as string), 3, '0')", purpose,
        c["MEMO_CD"], c["MEMO_TEXT"], "case when l_partkey % 3 = 0 then 'ORG' else 'IND' end",
        c["SUB_ID"], c["FILE_NUM"], c["TRAN_ID"], "''",
    ]


def _cm(dialect: str) -> list[str]:
    k = _k("s_suppkey")
    return [
        f"'C' || {k}", "upper(s_name)", "'TREASURER ' || cast(s_nationkey as string)",
        "cast(s_suppkey as string) || ' MAIN ST'", "''", "'CITY ' || cast(s_nationkey as string)",
        "substr('CANYTXFLILPAOHGAMINC', cast((s_nationkey % 10) * 2 + 1 as int), 2)",
        ("case when s_suppkey % 10 = 0 then '' when s_suppkey % 10 = 1 then '  12345-6789'"
         " else lpad(cast((s_suppkey * 7919) % 1000000000 as string), 9, '0') end"),
        "substr('PAUBDJ', cast(s_suppkey % 6 + 1 as int), 1)",
        "substr('HSPNQXYZ', cast(s_suppkey % 8 + 1 as int), 1)",
        "substr('DEMREPLIBGREIND', cast(((s_nationkey + cycle) % 5) * 3 + 1 as int), 3)",
        "substr('QMTA', cast(s_suppkey % 4 + 1 as int), 1)",
        "case when s_suppkey % 3 = 0 then '' else substr('CLMTVW', cast(s_suppkey % 6 + 1 as int), 1) end",
        "case when s_suppkey % 4 = 0 then 'ORG ' || cast(s_nationkey as string) else '' end",
        f"case when s_suppkey % 9 = 4 then 'X' || {k} else 'H' || {k} end",
    ]


_STATES = "'CANYTXFLILPAOHGAMINC'"


def _cn(dialect: str) -> list[str]:
    k = _k("c_custkey")
    return [
        f"'H' || {k}", "upper(c_name)",
        "substr('DEMREPLIBGREIND', cast(((c_custkey + cycle) % 5) * 3 + 1 as int), 3)",
        ("case c_custkey % 8 when 0 then ' ' || cast(cycle as string) || ' '"
         " when 1 then substr(cast(cycle as string), 3, 2) when 2 then '20.6' when 3 then 'abcd'"
         " else cast(cycle as string) end"),
        f"substr({_STATES}, cast((c_nationkey % 10) * 2 + 1 as int), 2)",
        "substr('HSP', cast(c_custkey % 3 + 1 as int), 1)",
        "lpad(cast(c_custkey % 20 as string), 2, '0')",
        "substr('ICO', cast((c_custkey + cycle) % 3 + 1 as int), 1)",
        "substr('CNPF', cast(c_custkey % 4 + 1 as int), 1)",
        f"'C' || {k}",
        "cast(c_custkey as string) || ' ELM ST'", "''", "'TOWN ' || cast(c_nationkey as string)",
        f"substr({_STATES}, cast((c_nationkey % 10) * 2 + 1 as int), 2)",
        "case when c_custkey % 10 = 0 then '' else lpad(cast((c_custkey * 104729) % 1000000000 as string), 9, '0') end",
    ]


def _weball(dialect: str) -> list[str]:
    bal = "cast(c_acctbal as decimal(14,2))"

    def m(f: int) -> str:
        return f"cast({bal} * {f} as string)"

    return [
        f"'H' || {_k('c_custkey')}", "upper(c_name)",
        "substr('ICO', cast((c_custkey + cycle) % 3 + 1 as int), 1)",
        "cast(c_custkey % 3 + 1 as string)",
        "substr('DEMREPLIBGREIND', cast(((c_custkey + cycle) % 5) * 3 + 1 as int), 3)",
        f"case when c_custkey % 6 = 0 then '1,000' else {m(3)} end",  # TTL_RECEIPTS
        m(1), m(2), "'0'", m(1), m(2),  # TRANS_FROM_AUTH TTL_DISB TRANS_TO_AUTH COH_BOP COH_COP
        f"case when c_custkey % 4 = 0 then '' else {m(1)} end",  # CAND_CONTRIB
        f"case when c_custkey % 5 = 0 then {m(1)} else '' end",  # CAND_LOANS
        "''", "''", "''",  # OTHER_LOANS CAND_LOAN_REPAY OTHER_LOAN_REPAY
        f"case when c_acctbal < 0 then {m(-1)} else '0' end",  # DEBTS_OWED_BY
        m(2),  # TTL_INDIV_CONTRIB
        f"substr({_STATES}, cast((c_nationkey % 10) * 2 + 1 as int), 2)",
        "lpad(cast(c_custkey % 20 as string), 2, '0')",
        "''", "'W'", "''", "case when c_custkey % 2 = 0 then 'W' else 'L' end",
        ("case when c_custkey % 7 = 0 then '1000' else cast(c_custkey % 100 as string) || '.'"
         " || lpad(cast(c_custkey % 100000 as string), 5, '0') end"),
        m(1), "''",
        ("case when c_custkey % 4 = 1 then '6/30/' || cast(cycle as string)"
         " when c_custkey % 2 = 1 then '12/31/' || cast(cycle as string)"
         " else '1231' || cast(cycle as string) end"),
        "'0'", "''",
    ]


def _ccl_branches(dialect: str) -> list[tuple[str, list[str]]]:
    k = _k("s_suppkey")
    yr = "cast(cycle as string)"
    first = [
        f"case when s_suppkey % 9 = 0 then 'X' || {k} else 'H' || {k} end", yr, yr, f"'C' || {k}",
        "substr('HSPNQ', cast(s_suppkey % 5 + 1 as int), 1)", "'P'",
        "cast(cycle * 100000 + s_suppkey * 10 + 1 as string)",
    ]
    second = [
        f"'H' || {_k('s_suppkey + 1')}", yr, yr, f"'C' || {k}",
        "substr('HSPNQ', cast(s_suppkey % 5 + 1 as int), 1)", "'A'",
        "cast(cycle * 100000 + s_suppkey * 10 + 2 as string)",
    ]
    return [("s_suppkey % 5 <> 0", first), ("s_suppkey % 7 = 0", second)]


# table -> (source table, renderer)
_SOURCES = {
    "indiv": ("lineitem", _indiv), "oth": ("lineitem", _oth), "pas2": ("lineitem", _pas2),
    "oppexp": ("lineitem", _oppexp), "cm": ("supplier", _cm), "cn": ("customer", _cn),
    "weball": ("customer", _weball),
}


def _line(fields: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(fields) + ")"


def _branches(table: str, dialect: str) -> list[tuple[str, str, str, list[str]]]:
    """``[(source, cycle_sql, where_sql, field_sqls)]``; dims carry a ``cycle`` column."""
    if table == "ccl":
        return [("supplier", "cycle", w, f) for w, f in _ccl_branches(dialect)]
    source, fn = _SOURCES[table]
    cyc = FACT_CYCLE if source == "lineitem" else "cycle"
    return [(source, cyc, "true", fn(dialect))]


def render_branches(table: str, dialect: str) -> list[tuple[str, str, str, str]]:
    """``[(source, cycle_sql, where_sql, line_sql)]`` of the same."""
    return [(source, cyc, where, _line(fields)) for source, cyc, where, fields in _branches(table, dialect)]


def render_sql(table: str) -> str:
    """DuckDB text of the landing lines of ``table`` as ``(cycle, value)``."""
    lo, hi = DIM_CYCLES
    parts = []
    for source, cyc, where, line in render_branches(table, "duckdb"):
        src = source
        if source != "lineitem":
            src = f"(select *, cast(unnest(range({lo}, {hi + 1}, 2)) as integer) as cycle from {source})"
        parts.append(f"select cast({cyc} as integer) as cycle, {line} as value from {src} where {where}")
    return " union all ".join(parts)


def _source_text(source: str) -> str:
    """All render expression text reading ``source`` (every table, every branch)."""
    return " ".join(" ".join((cyc, where, line)) for t in ("ccl", *_SOURCES)
                    for src, cyc, where, line in render_branches(t, "spark") if src == source)


def _read_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Rows that lines are rendered from; those of dimensions once per cycle of ``DIM_CYCLES``."""
    lo, hi = DIM_CYCLES
    src = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    # Prune to the columns the renders read *before* spreading: the spread
    # hashes its input's columns, which would otherwise pin every column of
    # the source (long comments included) into the scan and the shuffle.
    # The set is per source, not per table, so every table rendered from
    # one source shares one spread exchange (reused within a query).
    used = _source_text(source)
    src = src.select(*[c for c in src.columns if re.search(rf"\b{c}\b", used)])
    if source == "lineitem":
        return spread(src)
    # A generator, not a join: each dimension row is emitted once per cycle.
    return dealt(src).select("*", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.lit(2))).alias("cycle"))


def render_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Spark frame of the landing lines of ``table`` as ``(cycle, value)``."""
    out = None
    compiled_methods(spark)
    for source, cyc, where, line in render_branches(table, "spark"):
        src = _read_source(spark, sf_dir, source)
        # A one-row generator is used as an optimization barrier: filters on
        # ``value`` (blank / UTF-8 / field count) cannot be inlined below it, so
        # the wide render expression is evaluated once per row instead of once
        # per predicate.  The line is projected before it, since expressions of a
        # generator are walked node by node; the lambda, which has no generated
        # code, ends the stage there, so what reads the lines is compiled by itself.
        if where != "true":
            src = src.where(F.expr(where))
        line_of = src.select(F.expr(cyc).cast("int").alias("cycle"), F.expr(line).alias("value"))
        part = line_of.select("cycle", F.explode(F.transform(F.array("value"), lambda x: x)).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def render_tables(spark: SparkSession, sf_dir: str, tables: Iterable[str]) -> DataFrame:
    """The landing lines of several tables as ``(table_name, cycle, value)``, each source read once.

    Tables of one source share most of their fields: a field is rendered once a row and joined into the line of each table.
    """
    compiled_methods(spark)
    made: dict[str, list[tuple[str, str, str, list[str]]]] = {}
    for t in tables:
        for source, cyc, where, fields in _branches(t, "spark"):
            made.setdefault(source, []).append((t, cyc, where, fields))
    out = None
    for source, branches in made.items():
        texts = list(dict.fromkeys(x for *_, where, fields in branches for x in (where, *fields)))
        at = {x: f"_f{i}" for i, x in enumerate(texts)}
        row = _read_source(spark, sf_dir, source).select(
            F.expr(branches[0][1]).cast("int").alias("cycle"), *[F.expr(x).alias(at[x]) for x in texts])
        own = [F.when(F.col(at[where]), F.struct(F.lit(t).alias("table_name"), F.expr(_line([at[x] for x in fields])).alias("value")))
               for t, _, where, fields in branches]
        # the lines of a row as an array: its lambda ends the compiled stage and keeps filters above, as in ``render_lines``
        lines = row.select("cycle", F.array(*own).alias("lines"))
        lines = lines.select("cycle", F.explode(F.filter("lines", lambda x: x.isNotNull())).alias("line"))
        part = lines.select("line.table_name", "cycle", "line.value")
        out = part if out is None else out.unionByName(part)
    return out


# --- files with quoted fields -------------------------------------------------------------

# Cycles whose files are written with quotes; the others hold stray quotes and are literal.
QUOTED_CYCLE = "cycle % 4 = 0"


def _quotable_fields(dialect: str) -> list[str]:
    """Fields of indiv lines: delimiters, quotes and line ends where files are quoted, stray quotes elsewhere."""
    c = _indiv(dialect)
    at = {name: i for i, name in enumerate(LAYOUTS["indiv"].names)}
    key = "cast(l_partkey as string)"
    quoted = FACT_CYCLE + " % 4 = 0"
    c[at["NAME"]] = (
        f"case when {quoted} then case l_partkey % 6 when 0 then 'DONOR \"' || {key} || '\" | SONS' when 1 then '|' || chr(10) || chr(10) || {key}"
        f" when 2 then '\"' when 3 then '\"\"|' || {key} else 'DONOR \"' || {key} || '\"' end"
        f" else case l_partkey % 6 when 0 then '\"Q\" S ' || {key} when 1 then '\"A|B\" ' || {key} when 2 then '\"open ' || {key}"
        f" else 'DONOR \"' || {key} || '\"' end end")
    c[at["MEMO_TEXT"]] = f"case when {quoted} and l_linenumber = 2 then 'FIRST' || chr(10) || '\"SECOND\"|' || chr(10) else '' end"
    return c


def quotable_sql(dialect: str = "duckdb") -> tuple[str, list[str]]:
    """(cycle expression, field expressions) of the rows behind the files with quotes."""
    return FACT_CYCLE, _quotable_fields(dialect)


def write_quoted_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Text files per cycle below ``path`` (``cycle=Y``): quoted or literal, see QUOTED_CYCLE.

    A cycle's rows are dealt to tasks by size, so that none holds a whole cycle; each task writes a file of its own.
    """
    compiled_methods(spark)
    fields = _quotable_fields("spark")
    li = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    row = li.select(F.expr(FACT_CYCLE).alias("cycle"), F.expr(f"array({', '.join(fields)})").alias("fields"))
    written = F.transform("fields", lambda x: F.when(x.rlike('[|"\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
    value = F.array_join(F.when(F.expr(QUOTED_CYCLE), written).otherwise(F.col("fields")), "|")
    # the text writer ends a row with a line feed and leaves those inside as they are
    row.select("cycle", value.alias("value")).hint("rebalance", "cycle").write.partitionBy("cycle").text(path)


# --- lines of archives ------------------------------------------------------------------------

# Lines planted after a line of such a length: with bytes that are no UTF-8, with too many fields, empty.
BAD_BYTES, OVER_LONG, BLANK = (f"length(value) % {m} = 0" for m in (17, 19, 23))


def archived_lines(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    """``(table_name, cycle, raw)``: landing lines in bytes with planted bad ones; CRLF where 4 divides the cycle."""
    end = F.when(F.col("cycle") % 4 == 0, F.lit(b"\r\n")).otherwise(F.lit(b"\n"))
    text = F.col("value").cast("binary")
    over = F.concat("value", F.lit("|x" * 40)).cast("binary")
    raws = F.array(F.concat(text, end), F.when(F.expr(BAD_BYTES), F.concat(text, F.lit(b"\xc3\x28"), end)),
                   F.when(F.expr(OVER_LONG), F.concat(over, end)), F.when(F.expr(BLANK), end))
    return render_tables(spark, sf_dir, tables).select(
        "table_name", "cycle", F.explode(F.filter(raws, lambda x: x.isNotNull())).alias("raw"))


def rendered_cycles(spark: SparkSession, sf_dir: str) -> list[int | None]:
    """Cycles that have landing lines (a bounded list); NULL is one where a fact has no ship date, and comes first."""
    found = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(FACT_CYCLE).alias("cycle")).distinct().collect()
    return sorted({r.cycle for r in found} | set(range(DIM_CYCLES[0], DIM_CYCLES[1] + 1, 2)), key=lambda c: (c is not None, c or 0))
