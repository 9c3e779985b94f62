"""QA audits (null rate, duplicate key, referential orphan, amount/date domain).

Every audit yields frames in one *metric contract*::

    run_id, cycle, table_name, metric_name, metric_value, status, computed_at,
    issue_key, issue_count, issue_details

``summary()`` projects it to the run-summary table (``issue_key`` appended so
several columns of one table stay distinguishable) and ``issue_log()`` keeps
rows with ``issue_count > 0`` as issue-log rows (severity ``warn``).

Definitions the templated audits leave open (chosen here, kept visible):

* null rate: per column, value = nulls / rows (0 for an empty table), key =
  column, count = nulls, details ``null_rows=<n>``;
* duplicate key: groups of the key expression with more than one row; a NULL
  key *is* a group.  Summary value = rows in duplicate groups (not the
  excess); details ``duplicate_rows=<n>``;
* referential orphan: per relationship edge, count = orphan rows, value =
  orphans / non-NULL child rows, key ``child.col->parent.col``;
* amount/date domain: per fact table four rules -- amount present but
  unparseable, amount outside ``[lo, hi]``, date present but unparseable, date
  outside ``{cycle - 1, cycle}`` -- value = count / rows.

``cycles`` names the expected cycles: one of them without rows yields ``pass``
rows with zero counts instead of no rows at all.

``run_ts`` is a parameter (not ``now()``) so results are reproducible.

Each audit is one aggregate pass per table (wide ``agg`` + ``stack``); the
duplicate audit shuffles on the key once, with partial aggregation first.
``audit_pass`` does several audits of all tables with one scan per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.operators.checks import DATA_TESTS
from ledgerline.operators.edges import edge_counts, edges_of, parents_of
from ledgerline.plans.joins import every_cycle, materialize
from ledgerline.sources.layouts import FACTS, LAYOUTS

DEFAULT_RUN_ID = 1
DEFAULT_RUN_TS = "2026-01-01 00:00:00"

# Key expression audited for duplicates, per table (natural keys).
DUPLICATE_KEYS = {
    "cm": "CMTE_ID", "cn": "CAND_ID", "ccl": "LINKAGE_ID", "weball": "CAND_ID",
    "indiv": "SUB_ID", "oppexp": "SUB_ID", "oth": "SUB_ID", "pas2": "SUB_ID",
}

METRIC_COLUMNS = ["run_id", "cycle", "table_name", "metric_name", "metric_value", "status",
                  "computed_at", "issue_key", "issue_count", "issue_details"]
SUMMARY_COLUMNS = ["run_id", "cycle", "table_name", "metric_name", "metric_value", "status",
                   "computed_at", "issue_key"]
ISSUE_COLUMNS = ["run_id", "cycle", "table_name", "issue_type", "severity", "issue_key",
                 "issue_count", "issue_details", "detected_at"]

# Insert order of the audits (drives batch issue ids).
AUDIT_ORDER = ("null_rate", "duplicate_key", "referential_orphan", "amount_date_domain")


def _ts(run_ts: str) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


def _metrics(long: DataFrame, table: str, metric: str, run_id: int, run_ts: str, details: str) -> DataFrame:
    """``(cycle, issue_key, issue_count, rows)`` -> metric contract."""
    value = F.when(F.col("rows") > 0, F.col("issue_count") / F.col("rows")).otherwise(F.lit(0.0))
    return long.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("cycle").cast("bigint").alias("cycle"),
        F.lit(table).alias("table_name"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.when(F.col("issue_count") > 0, "warn").otherwise("pass").alias("status"),
        _ts(run_ts).alias("computed_at"),
        F.col("issue_key"),
        F.col("issue_count").cast("bigint").alias("issue_count"),
        F.concat(F.lit(details + "="), F.col("issue_count").cast("string")).alias("issue_details"),
    )


def _stack_counts(wide: DataFrame, keys: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{k}', `c_{i}`" for i, k in enumerate(keys))
    return wide.selectExpr("cycle", "rows", f"stack({len(keys)}, {pairs}) as (issue_key, issue_count)")


def null_rate(df: DataFrame, table: str, run_id: int = DEFAULT_RUN_ID, run_ts: str = DEFAULT_RUN_TS,
              cycles: DataFrame | None = None) -> DataFrame:
    """H1 over every layout column of ``table``: one aggregate pass."""
    cols = LAYOUTS[table].names
    wide = df.groupBy("cycle").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"c_{i}") for i, c in enumerate(cols)],
    )
    return _metrics(_stack_counts(every_cycle(wide, cycles), cols), table, "null_rate", run_id, run_ts, "null_rows")


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """``(cycle, issue_key, issue_count)`` for every key group (NULL key included).

    Grouped by the typed key, written as text only afterwards: an integer and its text name the same group.
    """
    return df.groupBy("cycle", F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("issue_count")).select(
        "cycle", F.col("_key").cast("string").alias("issue_key"), "issue_count")


def duplicate_key_issues(df: DataFrame, table: str, run_id: int = DEFAULT_RUN_ID) -> DataFrame:
    """H2 issue rows: one per key group with more than one row."""
    g = duplicate_groups(df, DUPLICATE_KEYS[table]).where(F.col("issue_count") > 1)
    return g.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("cycle").cast("bigint").alias("cycle"),
        F.lit(table).alias("table_name"),
        F.lit("duplicate_key").alias("issue_type"),
        F.lit("warn").alias("severity"),
        "issue_key",
        F.col("issue_count").cast("bigint").alias("issue_count"),
        F.concat(F.lit("duplicate_rows="), F.col("issue_count").cast("string")).alias("issue_details"),
    )


def duplicate_key_summary(df: DataFrame, table: str, run_id: int = DEFAULT_RUN_ID, run_ts: str = DEFAULT_RUN_TS,
                          cycles: DataFrame | None = None) -> DataFrame:
    """H2 summary: rows in duplicate groups per cycle; ``pass`` when there are none."""
    g = duplicate_groups(df, DUPLICATE_KEYS[table])
    dup = F.col("issue_count") > 1
    per_cycle = every_cycle(g.groupBy("cycle").agg(
        F.coalesce(F.sum(F.when(dup, F.col("issue_count"))), F.lit(0)).alias("dup_rows"),
        F.count_if(dup).alias("dup_groups"),
    ), cycles)
    return _duplicate_summary(per_cycle, table, run_id, run_ts)


def _duplicate_summary(per_cycle: DataFrame, table: str, run_id: int, run_ts: str) -> DataFrame:
    return per_cycle.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("cycle").cast("bigint").alias("cycle"),
        F.lit(table).alias("table_name"),
        F.lit("duplicate_key").alias("metric_name"),
        F.col("dup_rows").cast("double").alias("metric_value"),
        F.when(F.col("dup_groups") > 0, "warn").otherwise("pass").alias("status"),
        _ts(run_ts).alias("computed_at"),
        F.lit(None).cast("string").alias("issue_key"),
    )


def edge_name(t) -> str:
    return f"{t.table}.{t.column}->{t.parent_table}.{t.parent_column}"


def referential_orphans(table: Callable[[str], DataFrame], child: str, run_id: int = DEFAULT_RUN_ID,
                        run_ts: str = DEFAULT_RUN_TS,
                        parents: dict[tuple[str, str], DataFrame] | None = None,
                        cycles: DataFrame | None = None) -> DataFrame:
    """H3 for every relationship edge leaving ``child``, in one scan of the child."""
    edges = edges_of(child, DATA_TESTS)
    parents = parents_of(edges, table, parents)
    df = table(child).select(*sorted({"cycle"} | {t.column for t in edges}))
    wide = every_cycle(edge_counts(df, edges, parents), cycles)
    keys = [edge_name(t) for t in edges]
    pairs = ", ".join(f"'{k}', `orphans_{i}`, `present_{i}`" for i, k in enumerate(keys))
    long = wide.selectExpr("cycle", f"stack({len(keys)}, {pairs}) as (issue_key, issue_count, rows)")
    return _metrics(long, child, "referential_orphan", run_id, run_ts, "orphan_rows")


def domain_rules(lo: float, hi: float, amount: str = "TRANSACTION_AMT", date: str = "TRANSACTION_DT") -> dict[str, Column]:
    """H4: the condition that breaks each rule."""
    amt, dt = F.col(amount), F.col(date)
    present = lambda raw: F.coalesce(F.trim(F.col(raw)), F.lit("")) != ""
    lo_c, hi_c = F.lit(lo).cast("decimal(14,2)"), F.lit(hi).cast("decimal(14,2)")
    return {
        "amount_unparseable": present(f"{amount}_raw") & amt.isNull(),
        "amount_out_of_range": amt.isNotNull() & ((amt < lo_c) | (amt > hi_c)),
        "date_unparseable": present(f"{date}_raw") & dt.isNull(),
        "date_out_of_cycle": dt.isNotNull() & ~F.year(dt).isin(F.col("cycle") - 1, F.col("cycle")),
    }


def amount_date_domain(df: DataFrame, table: str, lo: float = 0.0, hi: float = 50000.0,
                       run_id: int = DEFAULT_RUN_ID, run_ts: str = DEFAULT_RUN_TS,
                       amount: str = "TRANSACTION_AMT", date: str = "TRANSACTION_DT",
                       cycles: DataFrame | None = None) -> DataFrame:
    """H4; ``df`` must carry ``<amount>_raw`` and ``<date>_raw`` (see ``parse_lines(keep_raw=...)``)."""
    rules = domain_rules(lo, hi, amount, date)
    wide = df.groupBy("cycle").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(cond).alias(f"c_{i}") for i, cond in enumerate(rules.values())],
    )
    return _metrics(_stack_counts(every_cycle(wide, cycles), list(rules)), table, "amount_date_domain", run_id, run_ts, "rows")


def summary(metrics: DataFrame) -> DataFrame:
    """H5: run-summary projection of metric-contract rows."""
    return metrics.select(*SUMMARY_COLUMNS)


def issue_log(metrics: DataFrame, issue_type: str | None = None) -> DataFrame:
    """H5: issue-log rows (``issue_count > 0``) of metric-contract rows."""
    it = F.lit(issue_type) if issue_type else F.col("metric_name")
    return metrics.where(F.col("issue_count") > 0).select(
        "run_id", "cycle", "table_name", it.alias("issue_type"), F.lit("warn").alias("severity"),
        "issue_key", "issue_count", "issue_details", F.col("computed_at").alias("detected_at"))


def assign_issue_ids(issues: DataFrame, mode: str = "batch", existing_max: int = 0,
                     partitions: int | None = None) -> DataFrame:
    """H6: issue ids for a log built from the audits in ``AUDIT_ORDER``.

    ``batch`` reproduces the source behaviour: each audit's insert takes
    ``max(issue_id) + 1`` once, so every row of one insert shares the id and
    the id advances by one per non-empty insert.

    ``unique`` gives ``max + row_number() over (order by audit, table_name,
    cycle, issue_key nulls first)`` without funnelling the log through one
    task: the log is range-partitioned on that order, ``row_number`` gives each
    row's position in its partition, and a prefix sum over the per-partition
    counts (one row per partition: bounded by the partition count, not the data)
    offsets them.
    ``(audit, table, cycle, issue_key)`` is unique in the log, so the order is
    total.  The ranked log is materialized (checkpoint in the shared folder)
    before it is read twice, so both reads see one range partitioning.
    """
    order = F.array_position(F.array(*[F.lit(a) for a in AUDIT_ORDER]), F.col("issue_type"))
    df = issues.withColumn("_batch", order)
    if mode == "batch":
        present = df.groupBy("_batch").count()  # at most len(AUDIT_ORDER) rows: bounded
        ranks = present.select("_batch", F.dense_rank().over(Window.orderBy("_batch")).alias("_rank"))
        return df.join(F.broadcast(ranks), "_batch").select(
            (F.lit(existing_max) + F.col("_rank")).cast("bigint").alias("issue_id"), *issues.columns)
    if mode != "unique":
        raise ValueError(mode)
    n = partitions or int(issues.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = materialize(df)  # the range exchange samples its input before shuffling it: read the log once
    keys = [F.col("_batch"), F.col("table_name"), F.col("cycle"), F.col("issue_key").asc_nulls_first()]
    # Stored once: the counts and the positions must come from the same range
    # partitioning (two plans would each sample their own range bounds).
    dealt = materialize(df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))
    ranked = dealt.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid").orderBy(*keys)))
    sizes = dealt.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return ranked.join(F.broadcast(offsets), "_pid").select(
        (F.lit(existing_max) + F.col("_off") + F.col("_pos")).cast("bigint").alias("issue_id"), *issues.columns)


def replace_slices(old: DataFrame, new: DataFrame, covered: DataFrame) -> DataFrame:
    """A7 semantics: drop every covered ``(run_id, cycle, table_name, issue_type)``
    slice from ``old`` -- even when the re-run found nothing there -- then append."""
    keys = ["run_id", "cycle", "table_name", "issue_type"]
    return old.join(covered.select(*keys).distinct(), keys, "left_anti").unionByName(new)


# ---------------------------------------------------------------- several audits in one scan per table

#: ``_kind`` of a group: the rows themselves by the conditions they meet, a relationship edge (0, 1, ...), the duplicate key.
ROWS, DUPLICATES = -1, -2
_GROUP = ["cycle", "_kind", "_key", "_id"]


def _conditions(name: str, ranges: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """Condition of every null count and, per amount range of a fact, of every domain rule; by the name of its count."""
    conds = {f"n_{i}": F.col(c).isNull() for i, c in enumerate(LAYOUTS[name].names)}
    if name in FACTS:
        for family, (lo, hi) in ranges.items():
            conds |= {f"{family}_{i}": cond for i, cond in enumerate(domain_rules(lo, hi).values())}
    return conds


def audit_groups(df: DataFrame, name: str, conds: dict[str, Column], edges: list, duplicates: bool) -> DataFrame:
    """``(table_name, cycle, _kind, _key, _id, n)``: what all audits of a table count, from one scan and one exchange.

    Each row is a line of its conditions as bits, one per edge value and one of its duplicate key; lines
    are counted.  An integer duplicate key stays one (``_id``); groups of one row are dropped.
    """
    bits = [F.when(c, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(conds.values())]
    text, number = "cast(null as string)", "cast(null as bigint)"
    lines = [f"{ROWS}, {text}, _bits"] + [f"{i}, cast({t.column} as string), {number}" for i, t in enumerate(edges)]
    key = DUPLICATE_KEYS[name]
    if duplicates:
        lines.append(f"{DUPLICATES}, " + (f"{text}, {key}" if LAYOUTS[name].kind(key) == "b" else f"{key}, {number}"))
    used = {t.column for t in edges} | ({key} if duplicates else set())
    rows = df.select("cycle", reduce(Column.bitwiseOR, bits).alias("_bits"), *sorted(used))
    tagged = rows.selectExpr("cycle", f"stack({len(lines)}, {', '.join(lines)}) as (_kind, _key, _id)")
    counted = tagged.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"))
    if duplicates:
        counted = counted.where((F.col("_kind") != DUPLICATES) | (F.col("n") > 1))
    return counted.select(F.lit(name).alias("table_name"), *_GROUP, "n")


def audit_pass(table: Callable[[str], DataFrame], names: Iterable[str], ranges: dict[str, tuple[float, float]],
               parents: dict[tuple[str, str], DataFrame] | None = None, edges: bool = True,
               duplicates: bool = True) -> tuple[DataFrame, DataFrame]:
    """All audits of ``names``, each table scanned once: ``(groups, wide)``, both checkpointed.

    ``groups``: findings-sized, see ``audit_groups``.  ``wide``: one row per table and cycle with ``rows``, the count
    of every condition (``n_<column>``, ``<range>_<rule>``), ``orphans_<edge>``, ``present_<edge>``, and rows and
    number of duplicate groups.  ``table(name)`` returns a typed table, facts with raw amount and date.
    """
    names = list(names)
    own = {n: edges_of(n, DATA_TESTS) if edges else [] for n in names}
    conds = {n: _conditions(n, ranges) for n in names}
    groups = materialize(reduce(DataFrame.unionByName, [
        audit_groups(table(n), n, conds[n], own[n], duplicates) for n in names]))
    kind, n = F.col("_kind"), F.col("n")
    # The parent column of an edge group; parent keys carry the same number.
    known = parents_of([t for ts in own.values() for t in ts], table, parents) if edges else {}
    at = {parent: i for i, parent in enumerate(known)}
    parent = F.lit(None).cast("int")
    for name, ts in own.items():
        for i, t in enumerate(ts):
            parent = F.when((F.col("table_name") == name) & (kind == i), F.lit(at[t.parent_table, t.parent_column])).otherwise(parent)
    counted = groups.withColumn("_hit", F.lit(None).cast("boolean"))
    if known:
        keys = reduce(DataFrame.unionByName, [
            f.select("cycle", F.lit(at[p]).alias("_parent"), "_key") for p, f in known.items()]).distinct()
        met = groups.where(kind >= 0).withColumn("_parent", parent).join(
            keys.withColumn("_hit", F.lit(True)), ["cycle", "_parent", "_key"], "left")
        counted = counted.where(kind < 0).unionByName(met.select(*counted.columns))
    total = lambda cond, alias: F.sum(F.when(cond, n).otherwise(0)).alias(alias)
    bits: dict[str, dict[int, list[str]]] = {}  # the place of a condition among the bits differs by table
    for name, ts in conds.items():
        for i, c in enumerate(ts):
            bits.setdefault(c, {}).setdefault(i, []).append(name)
    meets = lambda c: reduce(Column.__or__, [
        F.col("table_name").isin(ts) & (F.col("_id").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0) for i, ts in bits[c].items()])
    out = [total(kind == ROWS, "rows")] + [total((kind == ROWS) & meets(c), c) for c in bits]
    for i in range(max(map(len, own.values()))):
        present = (kind == i) & F.col("_key").isNotNull()
        out += [total(present & F.col("_hit").isNull(), f"orphans_{i}"), total(present, f"present_{i}")]
    out += [total(kind == DUPLICATES, "dup_rows"), F.count_if(kind == DUPLICATES).alias("dup_groups")]
    return groups, materialize(counted.groupBy("table_name", "cycle").agg(*out))


def pass_metrics(wide: DataFrame, name: str, families: Iterable[str], run_id: int = DEFAULT_RUN_ID,
                 run_ts: str = DEFAULT_RUN_TS, domain: str = "d", cycles: DataFrame | None = None) -> DataFrame | None:
    """Metric rows of ``name`` from the ``wide`` of ``audit_pass``: the audits in ``families``, None if it has none of them.

    ``domain`` names the amount range of the domain audit.
    """
    entries = []
    if "null_rate" in families:
        entries += [("null_rate", c, f"n_{i}", "rows") for i, c in enumerate(LAYOUTS[name].names)]
    if "referential_orphan" in families:
        entries += [("referential_orphan", edge_name(t), f"orphans_{j}", f"present_{j}")
                    for j, t in enumerate(edges_of(name, DATA_TESTS))]
    if "amount_date_domain" in families and name in FACTS:
        entries += [("amount_date_domain", r, f"{domain}_{i}", "rows") for i, r in enumerate(domain_rules(0, 0))]
    if not entries:
        return None
    pairs = ", ".join(f"'{fam}', '{key}', `{cnt}`, `{rows}`" for fam, key, cnt, rows in entries)
    own = every_cycle(wide.where(F.col("table_name") == name).drop("table_name"), cycles)
    long = own.selectExpr("cycle", f"stack({len(entries)}, {pairs}) as (metric_name, issue_key, issue_count, rows)")
    details = (F.when(F.col("metric_name") == "null_rate", "null_rows")
               .when(F.col("metric_name") == "referential_orphan", "orphan_rows").otherwise("rows"))
    value = F.when(F.col("rows") > 0, F.col("issue_count") / F.col("rows")).otherwise(F.lit(0.0))
    return long.select(
        F.lit(run_id).cast("bigint").alias("run_id"), F.col("cycle").cast("bigint").alias("cycle"),
        F.lit(name).alias("table_name"), "metric_name", value.cast("double").alias("metric_value"),
        F.when(F.col("issue_count") > 0, "warn").otherwise("pass").alias("status"),
        _ts(run_ts).alias("computed_at"), "issue_key", F.col("issue_count").cast("bigint").alias("issue_count"),
        F.concat(details, F.lit("="), F.col("issue_count").cast("string")).alias("issue_details"))


def pass_duplicate_issues(groups: DataFrame, run_id: int = DEFAULT_RUN_ID) -> DataFrame:
    """H2 issue rows of every table from the ``groups`` of ``audit_pass``."""
    found = groups.where(F.col("_kind") == DUPLICATES).withColumn("issue_key", F.coalesce("_key", F.col("_id").cast("string")))
    return found.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("cycle").cast("bigint").alias("cycle"),
        "table_name",
        F.lit("duplicate_key").alias("issue_type"),
        F.lit("warn").alias("severity"),
        "issue_key",
        F.col("n").cast("bigint").alias("issue_count"),
        F.concat(F.lit("duplicate_rows="), F.col("n").cast("string")).alias("issue_details"),
    )


def pass_duplicate_summary(wide: DataFrame, name: str, run_id: int = DEFAULT_RUN_ID, run_ts: str = DEFAULT_RUN_TS,
                           cycles: DataFrame | None = None) -> DataFrame:
    """H2 summary of ``name`` from the ``wide`` of ``audit_pass``."""
    own = wide.where(F.col("table_name") == name).select("cycle", "dup_rows", "dup_groups")
    return _duplicate_summary(every_cycle(own, cycles), name, run_id, run_ts)
