"""Review and investigation analytics over the typed tables (J1..J7).

* null-key profile of the committee->candidate table;
* candidate inference for rows whose ``CAND_ID`` is NULL: follow ``OTHER_ID``
  to the candidate-committee linkage and classify the row as ``unique``
  (exactly one candidate), ``ambiguous`` (more than one) or ``none``;
* affected rows / amount per recipient committee;
* committees linked to more than one candidate;
* committee -> candidate listing (linkage x candidates x candidate totals);
* issue tables derived from those findings, their roll-up, and the
  ``explains_part_of`` closure between issues.

Shape at scale: the linkage side is aggregated to one row per
``(cycle, CMTE_ID)`` *before* any join, so the fact side never fans out; the
fact side is aggregated per ``(cycle, OTHER_ID)`` before it meets the
linkage in the summary, so a committee holding a third of all rows is one
pre-aggregated row after the map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.asof import as_of
from ledgerline.plans.joins import materialize

MONEY = "decimal(38,2)"


def null_key_profile(pas2: DataFrame, key: str = "CAND_ID", amount: str = "TRANSACTION_AMT") -> DataFrame:
    """Rows, NULL-key rows and their amount, per cycle (one aggregate pass)."""
    is_null = F.col(key).isNull()
    return pas2.groupBy("cycle").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_null).alias("null_rows"),
        F.sum(F.when(is_null, F.col(amount))).cast(MONEY).alias("affected_amount"),
    )


def linkage_candidates(ccl: DataFrame) -> DataFrame:
    """One row per ``(cycle, CMTE_ID)``: distinct candidate count and the single candidate."""
    return ccl.where(F.col("CMTE_ID").isNotNull() & F.col("CAND_ID").isNotNull()).groupBy("cycle", "CMTE_ID").agg(
        F.count_distinct("CAND_ID").alias("n_candidates"),
        F.min("CAND_ID").alias("_first"),
    )


def _classify(n: F.Column) -> F.Column:
    return F.when(n.isNull() | (n == 0), "none").when(n == 1, "unique").otherwise("ambiguous")


def infer_candidate(pas2: DataFrame, ccl: DataFrame) -> DataFrame:
    """J2 rows: every NULL-``CAND_ID`` row with its inferred candidate."""
    links = linkage_candidates(ccl).select(
        F.col("cycle").alias("_cy"), F.col("CMTE_ID").alias("_cm"), "n_candidates", "_first")
    rows = pas2.where(F.col("CAND_ID").isNull()).select("cycle", "SUB_ID", "CMTE_ID", "OTHER_ID", "TRANSACTION_AMT")
    j = rows.join(links, (F.col("cycle") == F.col("_cy")) & (F.col("OTHER_ID") == F.col("_cm")), "left")
    n = F.coalesce(F.col("n_candidates"), F.lit(0)).cast("bigint")
    return j.select(
        "cycle", "SUB_ID", "CMTE_ID", "OTHER_ID", "TRANSACTION_AMT",
        n.alias("n_candidates"),
        F.when(n == 1, F.col("_first")).alias("inferred_cand_id"),
        _classify(n).alias("inference"),
    )


def affected_by_committee(pas2: DataFrame) -> DataFrame:
    """J3 generalised: NULL-``CAND_ID`` rows and amount per recipient committee."""
    return pas2.where(F.col("CAND_ID").isNull()).groupBy("cycle", "OTHER_ID").agg(
        F.count(F.lit(1)).alias("affected_rows"),
        F.sum("TRANSACTION_AMT").cast(MONEY).alias("affected_amount"),
    )


def infer_candidate_summary(pas2: DataFrame, ccl: DataFrame) -> DataFrame:
    """J2 summary: rows and amount per inference class (pre-aggregated both sides)."""
    per_cmte = affected_by_committee(pas2)
    links = linkage_candidates(ccl).select(
        F.col("cycle").alias("_cy"), F.col("CMTE_ID").alias("_cm"), "n_candidates")
    j = per_cmte.join(links, (F.col("cycle") == F.col("_cy")) & (F.col("OTHER_ID") == F.col("_cm")), "left")
    return j.groupBy("cycle", _classify(F.col("n_candidates")).alias("inference")).agg(
        F.sum("affected_rows").cast("bigint").alias("rows"),
        F.sum("affected_amount").cast(MONEY).alias("amount"),
    )


def ambiguous_linkage(ccl: DataFrame) -> DataFrame:
    """Committees linked to more than one distinct candidate, a row per candidate with its number of links."""
    keyed = ccl.where(F.col("CMTE_ID").isNotNull() & F.col("CAND_ID").isNotNull())
    pairs = keyed.groupBy("cycle", "CMTE_ID", "CAND_ID").agg(F.count(F.lit(1)).alias("n_links"))
    several = pairs.groupBy("cycle", "CMTE_ID").agg(F.count(F.lit(1)).alias("n_candidates")).where("n_candidates > 1")
    return pairs.join(several, ["cycle", "CMTE_ID"]).select("cycle", "CMTE_ID", "CAND_ID", "n_candidates", "n_links")


def committee_candidates(ccl: DataFrame, cn: DataFrame, weball: DataFrame) -> DataFrame:
    """Linkage x candidate master x candidate totals on ``(cycle, CAND_ID)``."""
    cols = ["CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST", "CAND_OFFICE_DISTRICT", "CAND_ELECTION_YR", "CAND_ICI"]
    # One row per (cycle, candidate) on both sides: repeated keys must not multiply links.
    cand = (cn.where(F.col("CAND_ID").isNotNull()).groupBy(F.col("cycle").alias("_c1"), F.col("CAND_ID").alias("_k1"))
            .agg(F.max(F.struct(*cols)).alias("_row")).select("_c1", "_k1", "_row.*"))
    tot = (weball.where(F.col("CAND_ID").isNotNull())
           .groupBy(F.col("cycle").alias("_c2"), F.col("CAND_ID").alias("_k2"))
           .agg(F.max("TTL_RECEIPTS").alias("TTL_RECEIPTS")))
    j = (ccl.select("cycle", "CMTE_ID", "CAND_ID")
         .join(cand, (F.col("cycle") == F.col("_c1")) & (F.col("CAND_ID") == F.col("_k1")))
         .join(tot, (F.col("cycle") == F.col("_c2")) & (F.col("CAND_ID") == F.col("_k2"))))
    return j.select("cycle", "CMTE_ID", "CAND_ID", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST",
                    "CAND_OFFICE_DISTRICT", "CAND_ELECTION_YR", "CAND_ICI", "TTL_RECEIPTS")


# ---------------------------------------------------------------- issue tables

def derive_issues(suite: DataFrame, ambiguous: DataFrame, affected: DataFrame) -> dict[str, DataFrame]:
    """Issues and their entities, derived from findings.

    * one issue per failing data test and cycle (``data_quality_test``);
    * one issue per ambiguous committee that has NULL-candidate rows (``duplicate_id``);
    * entities: table and column, or committee and each candidate.
    Both frames are keyed by ``issue_key``; sizes follow the number of findings.
    """
    fail = materialize(suite.where(F.col("failures") > 0))  # findings: tiny, reused by every table below
    test_key = F.concat_ws("_", F.col("cycle").cast("string"), "table_name", "test_name", "column_name")
    tests = fail.select(
        test_key.alias("issue_key"), F.lit("data_quality_test").alias("issue_type"), "severity",
        F.col("cycle").cast("bigint").alias("cycle"), F.col("failures").cast("bigint").alias("detected_row_count"),
        F.lit(None).cast(MONEY).alias("detected_amount"), "table_name", "column_name", "test_id")
    amb = materialize(ambiguous.join(affected.withColumnRenamed("OTHER_ID", "CMTE_ID"), ["cycle", "CMTE_ID"]))
    dup_key = F.concat_ws("_", F.col("cycle").cast("string"), "CMTE_ID", F.lit("duplicate_candidate_ids"))
    dups = amb.select("cycle", "CMTE_ID", "affected_rows", "affected_amount").distinct().select(
        dup_key.alias("issue_key"), F.lit("duplicate_id").alias("issue_type"), F.lit("low").alias("severity"),
        F.col("cycle").cast("bigint").alias("cycle"), F.col("affected_rows").cast("bigint").alias("detected_row_count"),
        F.col("affected_amount").cast(MONEY).alias("detected_amount"), "CMTE_ID")
    dups = dups.withColumn("table_name", F.lit("ccl"))
    cols = ["issue_key", "issue_type", "severity", "cycle", "table_name", "detected_row_count", "detected_amount"]
    issue = tests.select(*cols).unionByName(dups.select(*cols))

    ent = tests.select("issue_key", F.explode(F.array(
        F.struct(F.lit("table").alias("entity_type"), F.col("table_name").alias("entity_id")),
        F.struct(F.lit("column").alias("entity_type"), F.col("column_name").alias("entity_id")))).alias("e")) \
        .unionByName(dups.select("issue_key", F.struct(F.lit("committee").alias("entity_type"), F.col("CMTE_ID").alias("entity_id")).alias("e"))) \
        .unionByName(amb.select(dup_key.alias("issue_key"), F.struct(F.lit("candidate").alias("entity_type"), F.col("CAND_ID").alias("entity_id")).alias("e"))) \
        .select("issue_key", "e.entity_type", "e.entity_id")

    return {"issue": issue, "issue_entity": ent}


def issue_status(issue: DataFrame, entity: DataFrame, log: DataFrame, as_of_time: str) -> DataFrame:
    """Every issue with what its review log says between its opening and ``as_of_time``.

    ``issue`` has (issue_key, cycle, table_name, opened_at, ...), ``log`` (cycle, table_name, log_id, logged_at,
    kind, decision) with kind evidence, metric or decision; an entry concerns the issues of its cycle and
    table.  Counts are those of entries after the opening up to the time asked; ``inherited_decision`` was
    in force when the issue was opened, ``latest_decision`` is the last one made since.  No issue meets the log
    row by row: what lies before the opening is an as-of lookup, the rest one total per cycle and table.
    """
    by = ["cycle", "table_name"]
    moment = F.lit(as_of_time).cast("timestamp_ntz")
    past = log.where(F.col("logged_at") <= moment)
    counts = {f"n_{k}": F.col("kind") == k for k in ("evidence", "metric", "decision")}
    made = F.when(F.col("kind") == "decision", F.col("decision"))
    opened = as_of(issue, past, by, "opened_at", "logged_at", "log_id", counts, {"inherited_decision": made})
    total = past.groupBy(*by).agg(
        *[F.count_if(c).alias(f"_{n}") for n, c in counts.items()],
        F.max(F.when(made.isNotNull(), F.struct("logged_at", "log_id", "decision"))).alias("_last"))
    entities = entity.groupBy("issue_key").agg(F.count(F.lit(1)).alias("n_entities"))
    out = opened.join(total, by, "left").join(entities, "issue_key", "left")
    since = F.col("_last.logged_at") > F.col("opened_at")
    own = [c for c in issue.columns if c not in ("table_name",)]
    return out.select(
        *own, F.coalesce("n_entities", F.lit(0)).cast("bigint").alias("n_entities"),
        *[(F.coalesce(f"_{n}", F.lit(0)) - F.col(n)).cast("bigint").alias(n) for n in counts],
        "inherited_decision", F.when(since, F.col("_last.decision")).alias("latest_decision"), F.when(since, F.col("_last.logged_at")).alias("decided_at"))


def issue_rollup(t: dict[str, DataFrame]) -> DataFrame:
    """Each issue with counts of entities / evidence / metrics and its latest decision.

    Every child table is aggregated to one row per issue *before* the joins,
    so the roll-up never multiplies rows (no entity x evidence fan-out).
    """
    def counted(name: str, alias: str) -> DataFrame:
        return t[name].groupBy("issue_key").agg(F.count(F.lit(1)).cast("bigint").alias(alias))

    latest = t["issue_decision"].groupBy("issue_key").agg(
        F.max_by("decision", F.struct("decided_at", "decision_seq")).alias("latest_decision"))
    out = t["issue"]
    for part in (counted("issue_entity", "n_entities"), counted("issue_evidence", "n_evidence"),
                 counted("issue_metric", "n_metrics"), latest):
        out = out.join(part, "issue_key", "left")
    return out.select("issue_key", "issue_type", "severity", "cycle", "detected_row_count", "detected_amount",
                      *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_entities", "n_evidence",
                                                                                   "n_metrics")],
                      "latest_decision")


def closure_pairs(edges: DataFrame) -> DataFrame:
    """(descendant_key, ancestor_key, depth): transitive ``explains_part_of`` pairs and their least number of hops.

    Each round adds the pairs one hop further that were not seen before, until
    there are none: chains of any length are followed whole, and cycles end
    because a pair is visited once.  A pair of an issue with itself is left out.
    """
    e = materialize(edges.where(F.col("relationship_type") == "explains_part_of").select(
        F.col("from_issue_key").alias("descendant_key"), F.col("to_issue_key").alias("ancestor_key"))
        .where("descendant_key <> ancestor_key").distinct())
    step = e.select(F.col("descendant_key").alias("_mid"), F.col("ancestor_key").alias("_up"))
    pairs = level = e.withColumn("depth", F.lit(1))
    depth = 1
    while not level.isEmpty():
        depth += 1
        level = materialize(level.join(step, F.col("ancestor_key") == F.col("_mid"))
                            .select("descendant_key", F.col("_up").alias("ancestor_key"))
                            .where("descendant_key <> ancestor_key").distinct()
                            .join(pairs, ["descendant_key", "ancestor_key"], "left_anti").withColumn("depth", F.lit(depth)))
        pairs = pairs.unionByName(level)
    return pairs


def explains_closure(issue: DataFrame, edges: DataFrame) -> DataFrame:
    """Transitive pairs of issues of which only row counts are known (hand-kept seeds), with the
    descendant's rows over the ancestor's.  Shares of overlapping parts need the rows: ``explain``.
    """
    pairs = closure_pairs(edges)
    rows = issue.select("issue_key", "detected_row_count")
    d = rows.select(F.col("issue_key").alias("_dk"), F.col("detected_row_count").alias("explained_rows"))
    a = rows.select(F.col("issue_key").alias("_ak"), F.col("detected_row_count").alias("ancestor_rows"))
    j = pairs.join(d, F.col("descendant_key") == F.col("_dk")).join(a, F.col("ancestor_key") == F.col("_ak"))
    return j.select("ancestor_key", "descendant_key", F.col("depth").cast("int").alias("depth"), "explained_rows",
                    "ancestor_rows", F.when(F.col("ancestor_rows") > 0, F.col("explained_rows") / F.col("ancestor_rows"))
                    .cast("double").alias("explained_share"))
