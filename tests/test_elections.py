"""Election, type and office dimensions: every key resolves, every transaction has one row, odd keys."""
from pyspark.sql import functions as F

from ledgerline.operators import model as M
from ledgerline.plans.tables import Tables
from ledgerline.sources.layouts import FACTS


def test_every_code_resolves(spark, sf):
    t = Tables(spark, sf)
    facts = {f: t.get(f) for f in FACTS}
    contest = M.dim_contest(facts, t.cm, t.cn).cache()
    types, offices = M.dim_election_type(list(facts.values())), M.dim_office(t.cn)
    coded = sum(f.where(F.col("TRANSACTION_PGI").isNotNull()).count() for f in facts.values())
    assert contest.agg(F.sum("n_rows")).first()[0] == coded > 0
    assert contest.count() == contest.select("contest_key").distinct().count()
    assert contest.join(types, "election_type", "left_anti").count() == 0
    assert contest.where(F.col("office_key").isNotNull()).join(offices, "office_key", "left_anti").count() == 0
    assert contest.where(F.col("office_key").isNotNull()).count() > 0


def test_odd_keys(spark):
    """Repeated masters do not multiply rows; unknown, missing and NULL keys have no office; other letters no name."""
    schema = "cycle int, CMTE_ID string, TRANSACTION_PGI string"
    plain = spark.createDataFrame([(1996, "C1", "P1996"), (1996, "C1", "P1996"), (1996, "C9", "P1996"), (1996, None, "Z19"),
                                   (1996, "C1", None)], schema)
    named = spark.createDataFrame([(1996, "C1", "G1996", "H2"), (1996, "C1", "G1996", None), (1996, "C1", "G1996", "H9")],
                                  schema + ", CAND_ID string")
    cm = spark.createDataFrame([(1996, "C1", "H1")] * 2 + [(1996, None, "H1"), (1998, "C9", "H1")], "cycle int, CMTE_ID string, CAND_ID string")
    cn = spark.createDataFrame([(1996, "H1", "H", "CA")] * 2 + [(1996, "H2", "P", None), (1996, None, "S", "NY")],
                               "cycle int, CAND_ID string, CAND_OFFICE string, CAND_OFFICE_ST string")
    got = {r.contest_key: r.n_rows for r in M.dim_contest({"a": plain, "b": named}, cm, cn).collect()}
    assert got == {"P1996/H-CA": 2, "P1996/-": 1, "Z19/-": 1, "G1996/P": 1, "G1996/H-CA": 1, "G1996/-": 1}
    types = {r.election_type: (r.type_name, r.n_rows) for r in M.dim_election_type([plain]).collect()}
    assert types["P"] == ("Primary", 3) and types["Z"] == (None, 1) and types["R"] == ("Runoff", 0)
    assert {r.office_key: r.n_candidates for r in M.dim_office(cn).collect()} == {"H-CA": 1, "P": 1, "S-NY": 0}
