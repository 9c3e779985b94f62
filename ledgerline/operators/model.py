"""Snowflake model over the typed tables (K1..K13).

Dimensions are small (one row per candidate / committee / code / day) and are
broadcast only where Catalyst or AQE finds them small; facts are never shuffled just to
meet a dimension.  The "who gives / who spends" star query aggregates with a
map-side partial aggregate on ``(cycle, party, flow)`` -- a handful of groups
-- so a committee that holds a third of all rows costs no skewed task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



MONEY = "decimal(38,2)"

# Canonical column names of the model (source column -> canonical).
CANONICAL_NAMES = {
    "CAND_ID": "candidate_id",
    "CMTE_ID": "committee_id",
    "SUB_ID": "transaction_id",
    "TRANSACTION_DT": "transaction_date",
    "TRANSACTION_AMT": "transaction_amount",
    "EMPLOYER": "employer_name",
    "OCCUPATION": "occupation",
    "cycle": "election_cycle",
    "RPT_TP": "report_type",
    "FILE_NUM": "filing_id",
}

# Code dimensions: (domain, table, column).
CODE_DOMAINS = (
    ("party", "cn", "CAND_PTY_AFFILIATION"),
    ("party", "cm", "CMTE_PTY_AFFILIATION"),
    ("office", "cn", "CAND_OFFICE"),
    ("incumbent_status", "cn", "CAND_ICI"),
    ("candidate_status", "cn", "CAND_STATUS"),
    ("committee_type", "cm", "CMTE_TP"),
    ("designation", "cm", "CMTE_DSGN"),
    ("filing_frequency", "cm", "CMTE_FILING_FREQ"),
    ("org_type", "cm", "ORG_TP"),
    ("linkage_type", "ccl", "CMTE_DSGN"),
    ("transaction_code", "indiv", "TRANSACTION_TP"),
    ("transaction_code", "oth", "TRANSACTION_TP"),
    ("transaction_code", "pas2", "TRANSACTION_TP"),
)

# Candidate totals, grouped into the model's finance facts.
FINANCE_MEASURES = {
    "raising": ("TTL_RECEIPTS", "TRANS_FROM_AUTH", "CAND_CONTRIB", "TTL_INDIV_CONTRIB",
                "OTHER_POL_CMTE_CONTRIB", "POL_PTY_CONTRIB"),
    "loans_and_debts": ("CAND_LOANS", "OTHER_LOANS", "CAND_LOAN_REPAY", "OTHER_LOAN_REPAY", "DEBTS_OWED_BY"),
    "spending": ("TTL_DISB", "TRANS_TO_AUTH"),
    "cash": ("COH_BOP", "COH_COP"),
    "refunds": ("INDIV_REFUNDS", "CMTE_REFUNDS"),
}


def canonical_columns(df: DataFrame) -> DataFrame:
    """K1: rename source columns to canonical names (others unchanged)."""
    return df.withColumnsRenamed({k: v for k, v in CANONICAL_NAMES.items() if k in df.columns})


def canonical_union(tables: dict[str, DataFrame]) -> DataFrame:
    """K1 over several tables: their rows under canonical names, one column per name, with ``source_table`` in front.

    A column that a table lacks is NULL; equal names must have equal types.
    """
    parts = [canonical_columns(df).select(F.lit(name).alias("source_table"), "*") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def latest_per_key(df: DataFrame, key: str) -> DataFrame:
    """Latest-cycle row per key plus the number of cycles the key appears in.

    Of several rows of one cycle the largest counts, compared column by column
    (nulls lowest).  Both steps aggregate before their shuffle.
    """
    rest = [c for c in df.columns if c not in (key, "cycle")]
    per_cycle = df.groupBy(key, "cycle").agg(F.max(F.struct(*rest)).alias("_row"))
    g = per_cycle.groupBy(key).agg(F.max(F.struct("cycle", "_row")).alias("_last"),
                                   F.count(F.lit(1)).alias("n_cycles"))
    return g.select(key, F.col("_last.cycle").alias("latest_cycle"),
                    *[F.col(f"_last._row.{c}").alias(c) for c in rest], "n_cycles")


def committee_names(cm: DataFrame, column: str) -> DataFrame:
    """One row per ``(cycle, CMTE_ID)`` with the largest ``column``: joins to it cannot multiply rows."""
    return cm.where(F.col("CMTE_ID").isNotNull()).groupBy("cycle", "CMTE_ID").agg(F.max(column).alias(column))


def dim_candidate(cn: DataFrame) -> DataFrame:
    """K3 candidate dimension (latest record per candidate)."""
    d = latest_per_key(cn.where(F.col("CAND_ID").isNotNull()), "CAND_ID")
    return d.select(
        F.col("CAND_ID").alias("candidate_id"), F.col("CAND_NAME").alias("candidate_name"),
        F.col("CAND_PTY_AFFILIATION").alias("party"), F.col("CAND_OFFICE").alias("office"),
        F.col("CAND_OFFICE_ST").alias("office_state"), F.col("CAND_OFFICE_DISTRICT").alias("office_district"),
        F.col("CAND_ICI").alias("incumbent_status"), F.col("CAND_STATUS").alias("candidate_status"),
        F.col("CAND_ELECTION_YR").alias("election_year"), F.col("CAND_PCC").alias("principal_committee_id"),
        "latest_cycle", F.col("n_cycles").cast("bigint").alias("n_cycles"))


def dim_committee(cm: DataFrame) -> DataFrame:
    """K3 committee dimension (latest record per committee)."""
    d = latest_per_key(cm.where(F.col("CMTE_ID").isNotNull()), "CMTE_ID")
    return d.select(
        F.col("CMTE_ID").alias("committee_id"), F.col("CMTE_NM").alias("committee_name"),
        F.col("CMTE_TP").alias("committee_type"), F.col("CMTE_DSGN").alias("designation"),
        F.col("CMTE_PTY_AFFILIATION").alias("party"), F.col("CMTE_FILING_FREQ").alias("filing_frequency"),
        F.col("ORG_TP").alias("org_type"), F.col("CMTE_ST").alias("state"),
        F.col("CAND_ID").alias("candidate_id"), "latest_cycle",
        F.col("n_cycles").cast("bigint").alias("n_cycles"))


def dim_time(facts: list[DataFrame], date: str = "TRANSACTION_DT") -> DataFrame:
    """K4: one row per day between the first and last transaction date."""
    dates = reduce(lambda a, b: a.unionByName(b), [f.select(F.col(date).alias("d")) for f in facts])
    bounds = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    y = F.year("date")
    return days.select(
        (y * 10000 + F.month("date") * 100 + F.dayofmonth("date")).cast("int").alias("date_key"),
        "date", y.alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.weekofyear("date").alias("iso_week"), F.dayofmonth("date").alias("day"),
        F.expr("extract(DAYOFWEEK_ISO FROM date)").cast("int").alias("iso_day_of_week"),
        (y + F.pmod(y, F.lit(2))).cast("int").alias("cycle"))


def dim_election(facts: list[DataFrame]) -> DataFrame:
    """K5: election codes (type letter + year) seen on transactions."""
    codes = reduce(lambda a, b: a.unionByName(b),
                   [f.select(F.col("TRANSACTION_PGI").alias("election_code")) for f in facts])
    g = codes.where(F.col("election_code").isNotNull()).groupBy("election_code").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return g.select(
        "election_code", F.substring("election_code", 1, 1).alias("election_type"),
        F.substring("election_code", 2, 4).try_cast("int").alias("election_year"),
        F.col("n_rows").cast("bigint").alias("n_rows"))


# Names of election types and offices.
ELECTION_TYPES = {"C": "Convention", "E": "Recount", "G": "General", "O": "Other", "P": "Primary", "R": "Runoff",
                  "S": "Special"}
OFFICES = {"H": "House", "P": "President", "S": "Senate"}


def _named(code: str, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col(code))


def dim_election_type(facts: list[DataFrame]) -> DataFrame:
    """K5: election types, the named ones and any other letter that a transaction carries (its name is NULL)."""
    named = F.explode(F.array(*[F.lit(c) for c in ELECTION_TYPES])).alias("election_type")
    counts = dim_election(facts).groupBy("election_type").agg(
        F.count(F.lit(1)).alias("n_elections"), F.sum("n_rows").alias("n_rows"))
    every = facts[0].sparkSession.range(1).select(named).join(counts, "election_type", "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return every.select("election_type", _named("election_type", ELECTION_TYPES).alias("type_name"),
                        zero("n_elections"), zero("n_rows"))


def office_key(office: str, state: str) -> Column:
    """``<office>-<state>``; NULL without an office."""
    return F.when(F.col(office).isNotNull(), F.concat_ws("-", office, state))


def dim_office(cn: DataFrame) -> DataFrame:
    """K5: offices that candidates ran for, by state."""
    return cn.where(F.col("CAND_OFFICE").isNotNull()).groupBy("CAND_OFFICE", "CAND_OFFICE_ST").agg(
        F.count_distinct("CAND_ID").alias("n_candidates")).select(
        office_key("CAND_OFFICE", "CAND_OFFICE_ST").alias("office_key"), F.col("CAND_OFFICE").alias("office"),
        _named("CAND_OFFICE", OFFICES).alias("office_name"), F.col("CAND_OFFICE_ST").alias("state"),
        F.col("n_candidates").cast("bigint").alias("n_candidates"))


def dim_contest(facts: dict[str, DataFrame], cm: DataFrame, cn: DataFrame) -> DataFrame:
    """K5 as a snowflake: one row per election code and office, keyed to ``dim_election_type`` and ``dim_office``.

    The office is that of the transaction's candidate, or of its committee's candidate
    where the layout names none; without one ``office_key`` is NULL.  Every transaction
    with an election code belongs to exactly one row.  Facts are counted per code and
    candidate or committee before any join, and the masters come down to one row per key.
    """
    parts = []
    for f in facts.values():
        own = F.col("CAND_ID") if "CAND_ID" in f.columns else F.lit(None).cast("string")
        parts.append(f.where(F.col("TRANSACTION_PGI").isNotNull()).select(
            "cycle", F.col("TRANSACTION_PGI").alias("election_code"), own.alias("_cand"),
            F.when(own.isNull(), F.col("CMTE_ID")).alias("_cmte")))
    counted = reduce(lambda a, b: a.unionByName(b), parts).groupBy("cycle", "election_code", "_cand", "_cmte").agg(
        F.count(F.lit(1)).alias("n"))
    of_committee = committee_names(cm, "CAND_ID").select(
        "cycle", F.col("CMTE_ID").alias("_cmte"), F.col("CAND_ID").alias("_of_cmte"))
    office = cn.where(F.col("CAND_ID").isNotNull()).groupBy("cycle", "CAND_ID").agg(
        F.max(F.struct("CAND_OFFICE", "CAND_OFFICE_ST")).alias("o")).select(
        "cycle", F.col("CAND_ID").alias("_cand"), "o.CAND_OFFICE", "o.CAND_OFFICE_ST")
    # Committees are resolved and counted again, so a candidate is one row a code at the second join.
    by_candidate = counted.join(of_committee, ["cycle", "_cmte"], "left").groupBy(
        "cycle", "election_code", F.coalesce("_cand", "_of_cmte").alias("_cand")).agg(F.sum("n").alias("n"))
    g = by_candidate.join(office, ["cycle", "_cand"], "left").groupBy(
        "election_code", office_key("CAND_OFFICE", "CAND_OFFICE_ST").alias("office_key")).agg(F.sum("n").alias("n"))
    return g.select(
        F.concat_ws("/", "election_code", F.coalesce("office_key", F.lit("-"))).alias("contest_key"), "election_code",
        F.substring("election_code", 1, 1).alias("election_type"),
        F.substring("election_code", 2, 4).try_cast("int").alias("election_year"), "office_key",
        F.col("n").cast("bigint").alias("n_rows"))


def dim_codes(tables: dict[str, DataFrame]) -> DataFrame:
    """K6: generic ``(domain, code, n_rows)`` for every code domain, one pass per table."""
    per_table: dict[str, list[tuple[str, str]]] = {}
    for domain, table, col in CODE_DOMAINS:
        per_table.setdefault(table, []).append((domain, col))
    parts = []
    for table, pairs in per_table.items():
        arr = F.array(*[F.struct(F.lit(d).alias("domain"), F.col(c).alias("code")) for d, c in pairs])
        parts.append(tables[table].select(F.explode(arr).alias("x")).select("x.domain", "x.code"))
    codes = reduce(lambda a, b: a.unionByName(b), parts)
    return codes.where(F.col("code").isNotNull()).groupBy("domain", "code").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows")).withColumn("name", F.lit(None).cast("string"))


def bridge_linkage(ccl: DataFrame) -> DataFrame:
    """K7: distinct candidate-committee pairs per cycle with their link count."""
    return ccl.where(F.col("CAND_ID").isNotNull() & F.col("CMTE_ID").isNotNull()).groupBy(
        "cycle", "CAND_ID", "CMTE_ID").agg(F.count(F.lit(1)).cast("bigint").alias("n_links"))


CONTRIB_COLUMNS = ["cycle", "SUB_ID", "CMTE_ID", "CAND_ID", "OTHER_ID", "TRANSACTION_TP", "ENTITY_TP",
                   "STATE", "ZIP_CODE", "TRANSACTION_DT", "TRANSACTION_AMT", "FILE_NUM"]


def fact_contributions(indiv: DataFrame, pas2: DataFrame) -> DataFrame:
    """K8: individual contributions and committee->candidate contributions."""
    a = indiv.select(*[c for c in CONTRIB_COLUMNS if c in indiv.columns]).withColumn("source_table", F.lit("indiv"))
    b = pas2.select(*CONTRIB_COLUMNS).withColumn("source_table", F.lit("pas2"))
    return a.unionByName(b, allowMissingColumns=True)


def fact_disbursements(oppexp: DataFrame) -> DataFrame:
    """K9: operating expenditures."""
    return oppexp.select("cycle", "SUB_ID", "CMTE_ID", "RPT_YR", "TRANSACTION_DT", "TRANSACTION_AMT",
                         "PURPOSE", "CATEGORY", "ENTITY_TP", "STATE", "FILE_NUM")


def fact_transfers(oth: DataFrame, cm: DataFrame) -> DataFrame:
    """Committee-to-committee transfers with source and destination names.

    The committee master plays two roles, reduced to one row per
    (cycle, CMTE_ID) first, so the two left joins cannot multiply rows.
    """
    names = committee_names(cm, "CMTE_NM")
    src = names.select(F.col("cycle").alias("_sc"), F.col("CMTE_ID").alias("_sk"),
                       F.col("CMTE_NM").alias("source_committee_name"))
    dst = names.select(F.col("cycle").alias("_dc"), F.col("CMTE_ID").alias("_dk"),
                       F.col("CMTE_NM").alias("destination_committee_name"))
    t = oth.select("cycle", "SUB_ID", "CMTE_ID", "OTHER_ID", "TRANSACTION_DT", "TRANSACTION_AMT")
    t = t.join(src, (F.col("cycle") == F.col("_sc")) & (F.col("CMTE_ID") == F.col("_sk")), "left")
    t = t.join(dst, (F.col("cycle") == F.col("_dc")) & (F.col("OTHER_ID") == F.col("_dk")), "left")
    return t.select("cycle", "SUB_ID", F.col("CMTE_ID").alias("source_committee_id"), "source_committee_name",
                    F.col("OTHER_ID").alias("destination_committee_id"), "destination_committee_name",
                    "TRANSACTION_DT", "TRANSACTION_AMT")


def fact_filings(facts: dict[str, DataFrame]) -> DataFrame:
    """One row per (cycle, filing, source table)."""
    parts = [f.select("cycle", "FILE_NUM", "CMTE_ID", "TRANSACTION_DT", "TRANSACTION_AMT")
             .withColumn("source_table", F.lit(name)) for name, f in facts.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.where(F.col("FILE_NUM").isNotNull()).groupBy("cycle", "FILE_NUM", "source_table").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_transactions"),
        F.sum("TRANSACTION_AMT").cast(MONEY).alias("total_amount"),
        F.min("TRANSACTION_DT").alias("first_date"),
        F.max("TRANSACTION_DT").alias("last_date"),
        F.count_distinct("CMTE_ID").cast("bigint").alias("n_committees"))


def fact_candidate_finance(weball: DataFrame) -> DataFrame:
    """Candidate totals unpivoted to (candidate, group, measure, amount); NULLs dropped."""
    measures = [m for ms in FINANCE_MEASURES.values() for m in ms]
    long = weball.unpivot(["cycle", "CAND_ID"], measures, "measure", "amount")
    group = None
    for g, ms in FINANCE_MEASURES.items():
        cond = F.col("measure").isin(*ms)
        group = F.when(cond, g) if group is None else group.when(cond, g)
    return long.where(F.col("amount").isNotNull()).select(
        "cycle", "CAND_ID", group.alias("measure_group"), "measure", "amount")


def money_by_party(contributions: DataFrame, disbursements: DataFrame, cm: DataFrame) -> DataFrame:
    """Receipts and spending per cycle x committee party.

    Facts are tagged with a flow, unioned, counted per committee, and only then
    joined to the committee master of their cycle, so a committee with a third
    of all rows is one row at the join.  Unknown committees land in a NULL-party
    group rather than being dropped.
    """
    flows = contributions.select("cycle", "CMTE_ID", "TRANSACTION_AMT", F.lit("receipts").alias("flow")) \
        .unionByName(disbursements.select("cycle", "CMTE_ID", "TRANSACTION_AMT", F.lit("spending").alias("flow")))
    per = flows.groupBy("cycle", "CMTE_ID", "flow").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TRANSACTION_AMT").alias("amount"))
    party = committee_names(cm, "CMTE_PTY_AFFILIATION").select(
        F.col("cycle").alias("_c"), F.col("CMTE_ID").alias("_k"), F.col("CMTE_PTY_AFFILIATION").alias("party"))
    j = per.join(party, (F.col("cycle") == F.col("_c")) & (F.col("CMTE_ID") == F.col("_k")), "left")
    # One row per committee is left in each group, so counting the non-null ids counts distinct ones.
    return j.groupBy("cycle", "party", "flow").agg(
        F.sum("n").cast("bigint").alias("n_transactions"),
        F.sum("amount").cast(MONEY).alias("total_amount"),
        F.count("CMTE_ID").cast("bigint").alias("n_committees"))
