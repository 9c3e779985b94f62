"""As-of lookup: what a log had said up to a point in time.

Points and log entries of one key are ordered by time together, and each point reads the running
values in front of it.  A key may hold a third of all entries, so no window runs over a whole
key: time is cut into cells, windows run within (key, cell), and the state at the start of each
cell is a prefix over one row per (key, cell), which grows with the span of time alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(points: DataFrame, log: DataFrame, by: list[str], point_at: str, log_at: str, log_id: str,
          counts: dict[str, Column], lasts: dict[str, Column], cell: str = "day") -> DataFrame:
    """``points`` with, from all log entries of the same ``by`` at or before each point's time,
    a count per condition in ``counts`` and the latest non-null value per expression in ``lasts``.

    Entries at the same time go by ``log_id``.  A point whose key has no entry, whose time is null or
    lies before all entries has counts of 0 and null values; each point comes back once, repeated
    ones too.  Keys that are null match each other.  Entries without a time never count.
    """
    kept = points.columns
    dated = log.where(F.col(log_at).isNotNull())
    entries = dated.select(
        *by, F.col(log_at).alias("_at"), F.lit(0).alias("_point"), F.col(log_id).alias("_id"), F.lit(None).cast(points.schema).alias("_row"),
        *[F.when(c, 1).otherwise(0).cast("bigint").alias(f"_n_{n}") for n, c in counts.items()],
        *[F.when(c.isNotNull(), F.struct(F.col(log_at).alias("at"), F.col(log_id).alias("id"), c.alias("value"))).alias(f"_l_{n}") for n, c in lasts.items()])
    types = dict(entries.dtypes)
    asked = points.select(
        *by, F.col(point_at).cast(types["_at"]).alias("_at"), F.lit(1).alias("_point"), F.lit(None).cast(types["_id"]).alias("_id"), F.struct(*kept).alias("_row"),
        *[F.lit(0).cast("bigint").alias(f"_n_{n}") for n in counts], *[F.lit(None).cast(types[f"_l_{n}"]).alias(f"_l_{n}") for n in lasts])
    both = entries.unionByName(asked).withColumn("_cell", F.date_trunc(cell, "_at"))
    ns, ls = [f"_n_{n}" for n in counts], [f"_l_{n}" for n in lasts]

    cells = both.groupBy(*by, "_cell").agg(*[F.sum(c).alias(c) for c in ns], *[F.max(c).alias(c) for c in ls])
    earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_cell").alias("_k_cell"),
                           *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ns],
                           *[F.max(c).over(earlier).alias(f"{c}_before") for c in ls])
    so_far = Window.partitionBy(*by, "_cell").orderBy("_at", "_point", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.select(*by, "_cell", "_point", "_row", *[F.sum(c).over(so_far).alias(c) for c in ns], *[F.max(c).over(so_far).alias(c) for c in ls])
    same = F.col("_cell").eqNullSafe(F.col("_k_cell"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    found = local.where("_point = 1").join(carried, same)
    return found.select(
        "_row.*", *[(F.col(f"_n_{n}") + F.col(f"_n_{n}_before")).alias(n) for n in counts],
        *[F.coalesce(F.col(f"_l_{n}"), F.col(f"_l_{n}_before"))["value"].alias(n) for n in lasts])
