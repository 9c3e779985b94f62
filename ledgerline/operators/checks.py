"""Declarative data tests: ``not_null``, ``unique``, ``relationships`` (G1..G23).

Generic semantics (public definitions of these generic tests):

* ``not_null``      failures = rows where the column is NULL;
* ``unique``        failures = non-NULL values that occur more than once;
* ``relationships`` failures = child rows whose non-NULL value is absent from
  the parent column.  Severity is ``error`` unless configured ``warn``.

All tests run per ``cycle`` (each cycle is its own set of tables).

Physical shape: every not_null and relationships test of one child table is
evaluated in **one** scan of key counts (``operators.edges``), whatever the
size of the parents, then ``stack`` turns the wide row per cycle into one row
per test.  ``unique`` needs a shuffle on the
key; partial aggregation collapses hot keys map-side before the exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.edges import Parents, edge_counts, edges_of, parents_of
from ledgerline.plans.joins import every_cycle


@dataclass(frozen=True)
class DataTest:
    test_id: str
    test_name: str  # not_null | unique | relationships
    table: str
    column: str
    severity: str
    parent_table: str | None = None
    parent_column: str | None = None


def _t(spec: str) -> DataTest:
    tid, name, tc, sev, *rest = spec.split()
    table, column = tc.split(".")
    if rest:
        pt, pc = rest[0].split(".")
        return DataTest(tid, name, table, column, sev, pt, pc)
    return DataTest(tid, name, table, column, sev)


# The 23 configured tests (id, test, table.column, severity, parent).
DATA_TESTS: tuple[DataTest, ...] = tuple(_t(s) for s in """
G1 not_null ccl.CAND_ID error
G2 relationships ccl.CAND_ID warn cn.CAND_ID
G3 not_null ccl.CMTE_ID error
G4 relationships ccl.CMTE_ID warn cm.CMTE_ID
G5 not_null cm.CMTE_ID error
G6 unique cm.CMTE_ID error
G7 relationships cm.CAND_ID warn cn.CAND_ID
G8 not_null cn.CAND_ID error
G9 unique cn.CAND_ID error
G10 relationships cn.CAND_PCC warn cm.CMTE_ID
G11 not_null indiv.SUB_ID error
G12 not_null indiv.CMTE_ID error
G13 relationships indiv.CMTE_ID warn cm.CMTE_ID
G14 not_null oppexp.SUB_ID error
G15 relationships oppexp.CMTE_ID warn cm.CMTE_ID
G16 not_null oth.SUB_ID error
G17 relationships oth.CMTE_ID warn cm.CMTE_ID
G18 not_null pas2.SUB_ID error
G19 relationships pas2.CMTE_ID warn cm.CMTE_ID
G20 not_null pas2.CAND_ID warn
G21 relationships pas2.CAND_ID warn cn.CAND_ID
G22 not_null weball.CAND_ID error
G23 relationships weball.CAND_ID warn cn.CAND_ID
""".strip().splitlines())

RESULT_COLUMNS = ["test_id", "test_name", "table_name", "column_name", "cycle", "severity", "failures", "status"]


def _stack(wide: DataFrame, tests: list[DataTest]) -> DataFrame:
    """Wide ``(cycle, f_<test_id>...)`` -> one row per test."""
    pairs = ", ".join(f"'{t.test_id}', f_{t.test_id}" for t in tests)
    long = wide.selectExpr("cycle", f"stack({len(tests)}, {pairs}) as (test_id, failures)")
    meta = {t.test_id: t for t in tests}

    def pick(attr: str):
        col = None
        for tid, t in meta.items():
            cond = F.col("test_id") == tid
            col = F.when(cond, getattr(t, attr)) if col is None else col.when(cond, getattr(t, attr))
        return col

    return long.select(
        "test_id",
        pick("test_name").alias("test_name"),
        pick("table").alias("table_name"),
        pick("column").alias("column_name"),
        "cycle",
        pick("severity").alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
    ).withColumn("status", F.when(F.col("failures") > 0, F.col("severity")).otherwise(F.lit("pass")))


def table_checks(child: DataFrame, tests: list[DataTest], parents: Parents,
                 cycles: DataFrame | None = None) -> DataFrame:
    """All not_null + relationships tests of one child table in one scan.

    ``parents[(table, column)]`` is that column's ``parent_keys`` frame.
    """
    for t in tests:
        if t.test_name not in ("not_null", "relationships"):
            raise ValueError(t.test_name)
    edges = edges_of(child=tests[0].table, tests=tests)
    beside = {f"f_{t.test_id}": F.col(t.column).isNull() for t in tests if t.test_name == "not_null"}
    wide = edge_counts(child, edges, parents, beside)
    wide = wide.withColumnsRenamed({f"orphans_{i}": f"f_{t.test_id}" for i, t in enumerate(edges)})
    return _stack(every_cycle(wide, cycles), tests)


def unique_check(df: DataFrame, t: DataTest, cycles: DataFrame | None = None) -> DataFrame:
    counts = df.groupBy("cycle", t.column).agg(F.count(F.lit(1)).alias("_n"))
    wide = counts.groupBy("cycle").agg(
        F.count_if(F.col(t.column).isNotNull() & (F.col("_n") > 1)).alias(f"f_{t.test_id}"))
    return _stack(every_cycle(wide, cycles), [t])


def run_tests(
    table: Callable[[str], DataFrame],
    kinds: tuple[str, ...] = ("not_null", "unique", "relationships"),
    tests: tuple[DataTest, ...] = DATA_TESTS,
    parents: dict[tuple[str, str], DataFrame] | None = None,
    cycles: DataFrame | None = None,
) -> DataFrame:
    """Union of the selected tests; ``table(name)`` returns a typed table.

    ``parents`` memoizes the parent key frames across calls.  ``cycles``: expected
    cycles; a test over a cycle without rows passes with zero failures.
    """
    chosen = [t for t in tests if t.test_name in kinds]
    out = []
    by_table: dict[str, list[DataTest]] = {}
    for t in chosen:
        if t.test_name == "unique":
            out.append(unique_check(table(t.table).select("cycle", t.column), t, cycles))
        else:
            by_table.setdefault(t.table, []).append(t)
    # One key frame per distinct parent column (10 edges share 2 parents).
    parents = parents_of([t for t in chosen if t.parent_table], table, parents)
    for name, ts in by_table.items():
        cols = {"cycle"} | {t.column for t in ts}
        out.append(table_checks(table(name).select(*sorted(cols)), ts, parents, cycles))
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result
