"""Independent DuckDB SQL for every registered query (the correctness oracle).

The landing lines are rendered by the same SQL expression text as on Spark
(``sources.render``); everything after that -- parsing, casts, checks,
audits, joins -- is written here natively in the oracle engine's dialect
(``try_cast``, ``try_strptime``, ``string_split``, ``list`` ...), i.e. with
the source engine's own semantics, so a Spark emulation error shows up as a
hash mismatch.
"""

from __future__ import annotations

from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.render import render_sql


def duck_clean(kind: str, x: str) -> str:
    t = f"nullif(trim({x}), '')"
    if kind == "s":
        return f"nullif({x}, '')"
    if kind == "z":
        return f"nullif(substr(trim({x}), 1, 5), '')"
    if kind == "y":
        return f"try_cast(case when length(trim({x})) = 4 then trim({x}) end as smallint)"
    if kind == "h":
        return f"try_cast({t} as smallint)"
    if kind == "b":
        return f"try_cast({t} as bigint)"
    if kind == "m":
        return f"try_cast({t} as decimal(14,2))"
    if kind == "p":
        return f"try_cast({t} as decimal(7,4))"
    if kind == "d":
        return f"cast(try_strptime({t}, '%m%d%Y') as date)"
    if kind == "D":
        return (f"coalesce(cast(try_strptime({t}, '%m/%d/%Y') as date), "
                f"cast(try_strptime({t}, '%m%d%Y') as date))")
    raise ValueError(kind)


def typed_sql(table: str, keep_raw: tuple[str, ...] = ()) -> str:
    """Subquery text: typed rows of ``table`` (``cycle`` + layout columns)."""
    lay = LAYOUTS[table]
    n = len(lay.columns)
    cols = [f"{duck_clean(k, f'f[{i + 1}]')} as {c}" for i, (c, k) in enumerate(lay.columns)]
    pos = {c: i + 1 for i, (c, _) in enumerate(lay.columns)}
    raws = [f"f[{pos[c]}] as {c}_raw" for c in keep_raw]
    return (
        f"(select cycle, {', '.join(cols + raws)} from ("
        f"select cycle, string_split(value, '|') as f from ({render_sql(table)}) lines_ where value <> ''"
        f") split_ where len(f) <= {n} or (len(f) = {n + 1} and f[{n + 1}] = ''))"
    )


def lines_sql(table: str) -> str:
    return f"({render_sql(table)})"


EXPECTED_CYCLES_SQL = (
    "(select cast(unnest(range(lo + lo % 2, hi + 1, 2)) as integer) as cycle from "
    "(select min(year(l_shipdate)) - 2 as lo, max(year(l_shipdate)) as hi from lineitem) yrs)")


def every_cycle_sql(counts: str) -> str:
    """Query ``counts`` (numeric columns, one row per cycle) with zeros for expected cycles without rows."""
    return (f"select coalesce(columns(*), 0) from (select * from {EXPECTED_CYCLES_SQL} want "
            f"full join ({counts}) have using (cycle)) both_")
