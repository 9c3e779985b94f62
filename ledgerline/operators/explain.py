"""Which rows of an issue its explanations cover, without counting a row twice.

Issues are sets of rows, an issue may explain a part of several others, the parts overlap and
explanations may run in circles.  So counts cannot be added up along the graph; the row sets
themselves are united.  Rows of all issues get consecutive numbers, ordered so that the rows of
a committee lie together, and a set is one 4 KB bitmap per 32,768 numbers that it touches
(``bitmap_construct_agg``).  ``bitmap_or_agg`` unites the sets of all descendants of an issue,
``bitmap_and_agg`` keeps what lies in the issue itself.  An issue that holds a third of all
rows is spread over its bitmaps' numbers, and unions merge before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.review import closure_pairs, linkage_candidates
from ledgerline.plans.joins import materialize

#: Relationship between issues that share a row: (from, to), by the position of their kinds in ``_kinds``.
EDGES = ((3, 2), (2, 1), (1, 0), (4, 0), (4, 2), (5, 0), (1, 5), (5, 1))


def _kinds() -> list:
    """Keys of the issues a row without a candidate belongs to; null where it does not."""
    cycle, committee = F.col("cycle").cast("string"), F.col("OTHER_ID")
    unsolved, split = F.col("n_candidates") != 1, F.col("n_candidates") > 1
    return [
        F.concat(cycle, F.lit("_null_candidate")),
        F.when(unsolved, F.concat(cycle, F.lit("_unresolved"))),
        F.when(split, F.concat_ws("_", cycle, committee)),
        F.when(split & F.col("RPT_TP").isNotNull(), F.concat_ws("_", cycle, committee, "RPT_TP")),
        F.when(F.col("STATE").isNotNull(), F.concat(cycle, F.lit("_state_"), F.col("STATE"))),
        F.when(F.col("AMNDT_IND") == "A", F.concat(cycle, F.lit("_amended"))),
    ]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``row_id`` 1, 2, ... in ``order``: a range shuffle and a prefix sum over its partitions."""
    tied = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()))
    keys = [*order, "_tie"]
    placed = materialize(tied.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()))
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    own = F.row_number().over(Window.partitionBy("_pid").orderBy(*keys))
    return placed.withColumn("_own", own).join(before, "_pid").withColumn("row_id", F.col("_own") + F.col("_off")).drop("_tie", "_pid", "_own", "_off")


def issue_rows(pas2: DataFrame, ccl: DataFrame) -> DataFrame:
    """(row_id, keys): the issues of every row whose candidate is missing, as an array by kind."""
    missing = pas2.where(F.col("CAND_ID").isNull()).select("cycle", "OTHER_ID", "RPT_TP", "STATE", "AMNDT_IND")
    linked = linkage_candidates(ccl).select("cycle", F.col("CMTE_ID").alias("OTHER_ID"), F.col("n_candidates").alias("_n"))
    known = missing.join(linked, ["cycle", "OTHER_ID"], "left").withColumn("n_candidates", F.coalesce("_n", F.lit(0))).drop("_n")
    return numbered(known, ["cycle", "OTHER_ID"]).select("row_id", F.array(*_kinds()).alias("keys"))


def issue_edges(rows: DataFrame) -> DataFrame:
    """(from_issue_key, to_issue_key, relationship_type) between issues that share a row."""
    pairs = F.array(*[F.struct(F.get("keys", a).alias("f"), F.get("keys", b).alias("t")) for a, b in EDGES])
    return (rows.select(F.explode(pairs).alias("p")).where("p.f is not null and p.t is not null").distinct()
            .select(F.col("p.f").alias("from_issue_key"), F.col("p.t").alias("to_issue_key"), F.lit("explains_part_of").alias("relationship_type")))


def row_sets(members: DataFrame) -> DataFrame:
    """(issue_key, bucket, bits) from (issue_key, row_id)."""
    return (members.groupBy("issue_key", F.bitmap_bucket_number("row_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("row_id")).alias("bits")))


def explained(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per issue and issue that explains a part of it, directly or through others.

    ``explained_rows`` are the descendant's rows that are the ancestor's too; ``union_rows`` are the
    ancestor's rows in any of its descendants, so ``union_share`` never exceeds 1.  ``depth`` is the least
    number of hops.  An issue is not its own descendant.  Pairs without a common row have 0.
    """
    pairs = materialize(closure_pairs(edges))
    rows = sets.groupBy(F.col("issue_key").alias("ancestor_key")).agg(F.sum(F.bitmap_count("bits")).alias("ancestor_rows"))
    above = sets.select(F.col("issue_key").alias("ancestor_key"), "bucket", F.col("bits").alias("_above"))
    below = sets.select(F.col("issue_key").alias("descendant_key"), "bucket", "bits")
    # keys first: 4 KB bitmaps meet only where both sets touch a bucket
    met = pairs.select("ancestor_key", "descendant_key").join(above.select("ancestor_key", "bucket"), "ancestor_key").join(below, ["descendant_key", "bucket"])
    met = materialize(met.select("ancestor_key", "descendant_key", "bucket", "bits"))
    own = met.select("ancestor_key", "descendant_key", "bucket").join(above, ["ancestor_key", "bucket"])
    both = met.union(own.select("ancestor_key", "descendant_key", "bucket", F.col("_above").alias("bits")))
    common = (both.groupBy("ancestor_key", "descendant_key", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
              .groupBy("ancestor_key", "descendant_key").agg(F.sum("n").alias("explained_rows")))
    united = met.groupBy("ancestor_key", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    united = united.union(united.select("ancestor_key", "bucket").join(above, ["ancestor_key", "bucket"]).select("ancestor_key", "bucket", "_above"))
    union = (united.groupBy("ancestor_key", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
             .groupBy("ancestor_key").agg(F.sum("n").alias("union_rows")))
    out = pairs.join(rows, "ancestor_key").join(common, ["ancestor_key", "descendant_key"], "left").join(union, "ancestor_key", "left")
    part = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("explained_rows", "union_rows")}
    return out.select(
        "ancestor_key", "descendant_key", F.col("depth").cast("int").alias("depth"), F.col("ancestor_rows").cast("bigint").alias("ancestor_rows"),
        *[e.alias(c) for c, e in part.items()],
        (part["explained_rows"] / F.col("ancestor_rows")).alias("explained_share"), (part["union_rows"] / F.col("ancestor_rows")).alias("union_share"))


def explain_missing_candidates(pas2: DataFrame, ccl: DataFrame) -> DataFrame:
    """The explanations of missing candidates, from the cycle's finding down to committee and report."""
    rows = materialize(issue_rows(pas2, ccl))
    members = rows.select(F.explode("keys").alias("issue_key"), "row_id").where("issue_key is not null")
    return explained(materialize(row_sets(members)), issue_edges(rows))
