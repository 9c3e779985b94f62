"""Registered queries: declarative data tests (G)."""

from __future__ import annotations

from ledgerline.operators.checks import DATA_TESTS, run_tests
from ledgerline.plans.catalog import register
from ledgerline.plans.oracle_sql import every_cycle_sql, typed_sql
from ledgerline.plans.tables import Tables


def _test_sql(t) -> str:
    head = (f"select '{t.test_id}' as test_id, '{t.test_name}' as test_name, '{t.table}' as table_name, "
            f"'{t.column}' as column_name, cycle, '{t.severity}' as severity, cast(failures as bigint) as failures")
    src = typed_sql(t.table)
    if t.test_name == "not_null":
        body = f"select cycle, count(*) filter (where {t.column} is null) as failures from {src} c group by cycle"
    elif t.test_name == "unique":
        body = (f"select cycle, count(*) filter (where v is not null and n > 1) as failures from "
                f"(select cycle, {t.column} as v, count(*) as n from {src} c group by all) g group by cycle")
    else:
        body = (f"select c.cycle, count(*) filter (where c.{t.column} is not null and p.k is null) as failures "
                f"from {src} c left join (select distinct cycle, {t.parent_column} as k from "
                f"{typed_sql(t.parent_table)} pp where {t.parent_column} is not null) p "
                f"on c.cycle = p.cycle and c.{t.column} = p.k group by c.cycle")
    return f"{head}, case when failures > 0 then '{t.severity}' else 'pass' end as status from ({every_cycle_sql(body)}) b"


def _suite_sql(kinds: tuple[str, ...]) -> str:
    return " union all ".join(_test_sql(t) for t in DATA_TESTS if t.test_name in kinds)


def _suite(kinds: tuple[str, ...]):
    def build(spark, sf_dir):
        tables = Tables(spark, sf_dir)
        return run_tests(tables.get, kinds, parents=tables.parents, cycles=tables.cycles)

    return build


register("test_not_null", _suite_sql(("not_null",)))(_suite(("not_null",)))
register("test_unique", _suite_sql(("unique",)))(_suite(("unique",)))
register("test_relationships", _suite_sql(("relationships",)))(_suite(("relationships",)))
_ALL = ("not_null", "unique", "relationships")
register("test_suite", _suite_sql(_ALL))(_suite(_ALL))
