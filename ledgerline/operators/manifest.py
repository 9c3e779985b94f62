"""Coverage manifest, coverage gap, load history and source freshness (I1..I6).

* cycle expansion: an inclusive year range becomes its even election cycles
  (odd start rounded up) -- ``explode(sequence(first, end, 2))``;
* manifest: every covered cycle gets the dimension tables; cycles inside the
  ``facts`` range (which must lie within ``coverage``) also get the fact
  tables; de-duplicated keeping first position; cycles outside coverage get
  nothing.  Adds archive path, member name and download URL per row;
* gap: expected (manifest) minus present tables, status ``missing``;
* load history: one row per loaded (table, cycle) with row and reject counts; per archive also digest and duration;
* freshness: latest vs previous fetch of each (cycle, table) -> ``new`` /
  ``changed`` / ``unchanged`` / ``error`` (top-2 per key with two partial
  aggregations, never a per-key sort of the whole log).

Tables x cycles is a small frame; it is produced by generators (``explode``)
rather than a cross join.

Row counts (``present``) are one row per (table, cycle) group: a final
aggregate, so its size is measured when its shuffle stage finishes and AQE
turns the join into a broadcast from that measurement.  An eager row-count
check here would run the scan of every table twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.layouts import DIMENSIONS, FACTS, LAYOUTS

BASE_URL = "https://www.fec.gov/files/bulk-downloads"


@dataclass(frozen=True)
class Coverage:
    coverage: tuple[int, int]
    facts: tuple[int, int]
    dimensions: tuple[str, ...] = DIMENSIONS
    fact_tables: tuple[str, ...] = FACTS

    def __post_init__(self):
        if self.coverage[0] > self.coverage[1] or self.facts[0] > self.facts[1]:
            raise ValueError("a year range ends before it starts")
        if self.facts[0] < self.coverage[0] or self.facts[1] > self.coverage[1]:
            raise ValueError("fact years lie outside the covered years")
        unknown = sorted(set(self.dimensions + self.fact_tables) - set(LAYOUTS))
        if unknown:
            raise ValueError(f"no layout for {', '.join(unknown)}")


def even_cycles(first_year: Column, last_year: Column) -> Column:
    """Array of even cycles in ``[first, last]``; an odd start is rounded up."""
    start = first_year + F.pmod(first_year, F.lit(2))
    return F.when(start <= last_year, F.sequence(start, last_year, F.lit(2))).otherwise(
        F.array().cast("array<int>"))


def coverage_manifest(cycles: DataFrame, cfg: Coverage, base_url: str = BASE_URL) -> DataFrame:
    """I2 (+A3): ``cycles(cycle)`` -> one row per (cycle, table) to fetch and load."""
    entries = [(t, "dimension", i) for i, t in enumerate(cfg.dimensions)]
    entries += [(t, "fact", len(cfg.dimensions) + i) for i, t in enumerate(cfg.fact_tables)]
    arr = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(g).alias("table_group"),
                             F.lit(p).alias("position")) for t, g, p in entries])
    c = F.col("cycle")
    in_cov = (c >= cfg.coverage[0]) & (c <= cfg.coverage[1])
    in_facts = (c >= cfg.facts[0]) & (c <= cfg.facts[1])
    rows = (cycles.where((F.pmod(c, F.lit(2)) == 0) & in_cov)
            .select("cycle", F.explode(arr).alias("e"))
            .where((F.col("e.table_group") == "dimension") | in_facts)
            .select("cycle", "e.table_name", "e.table_group", "e.position"))
    # order-preserving de-dup: first position of each (cycle, table)
    rows = rows.groupBy("cycle", "table_name").agg(F.min("position").alias("position"),
                                                   F.min_by("table_group", "position").alias("table_group"))
    yy = F.substring(c.cast("string"), -2, 2)
    stem = F.concat(F.col("table_name"), yy)
    member = F.lit(None).cast("string")
    for t in LAYOUTS.values():
        lit_member = F.concat(F.lit(t.member.split("{yy}")[0]), yy, F.lit(t.member.split("{yy}")[1])) \
            if "{yy}" in t.member else F.lit(t.member)
        member = F.when(F.col("table_name") == t.name, lit_member).otherwise(member)
    return rows.select(
        c.cast("int").alias("cycle"), "table_name", "table_group", F.col("position").cast("int").alias("position"),
        F.concat_ws("/", F.lit(base_url), c.cast("string"), F.concat(stem, F.lit(".zip"))).alias("url"),
        F.concat_ws("/", F.lit("data"), c.cast("string"), F.concat(stem, F.lit(".zip"))).alias("zip_path"),
        member.alias("source_entry"),
        F.concat(F.col("table_name"), F.lit("_"), c.cast("string")).alias("target_table"))


def present_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, cycle, row_count)`` of every loaded table, one pass each."""
    parts = [df.groupBy("cycle").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(n))
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", F.col("cycle").cast("int").alias("cycle"),
                      F.col("row_count").cast("bigint").alias("row_count"))


def target_row_counts(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Expected targets with their row count (NULL when absent)."""
    j = manifest.join(present, ["table_name", "cycle"], "left")
    return j.select("cycle", "table_name", "target_table", "row_count",
                    F.when(F.col("row_count").isNotNull(), "success").otherwise("missing").alias("status"))


def coverage_gap(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Expected minus present, status ``missing``."""
    return manifest.join(present.select("table_name", "cycle"), ["table_name", "cycle"],
                         "left_anti").select("cycle", "table_name", "target_table", F.lit("missing").alias("status"))


def load_history(manifest: DataFrame, present: DataFrame, rejects: DataFrame, loaded_at: str) -> DataFrame:
    """I4: one row per loaded target (manifest row that has data)."""
    j = manifest.join(present, ["table_name", "cycle"]).join(rejects, ["table_name", "cycle"], "left")
    w = Window.orderBy("cycle", "position")  # over loaded targets only: tables x cycles rows
    return j.select(
        F.row_number().over(w).cast("bigint").alias("load_id"), F.col("cycle").cast("bigint").alias("cycle"),
        "table_name", F.col("zip_path").alias("source_zip_path"), F.col("source_entry").alias("source_entry_name"),
        F.col("target_table").alias("target_table_name"), "row_count",
        F.coalesce("rejected_rows", F.lit(0)).cast("bigint").alias("rejected_rows"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"))


def archive_history(stats: DataFrame, loaded_at: str) -> DataFrame:
    """I4 for tables published as several archives: one row per loaded archive with its digest and duration.

    ``stats``: table_name, cycle, zip_path, source_entry, row_count, rejected_rows, source_file_hash, duration_ms.
    """
    order = F.array_position(F.array(*[F.lit(t) for t in LAYOUTS]), F.col("table_name"))
    w = Window.orderBy("cycle", order, "zip_path")  # one row per archive: bounded
    return stats.select(
        F.row_number().over(w).cast("bigint").alias("load_id"), F.col("cycle").cast("bigint").alias("cycle"),
        "table_name", F.col("zip_path").alias("source_zip_path"), F.col("source_entry").alias("source_entry_name"),
        "source_file_hash", F.concat(F.col("table_name"), F.lit("_"), F.col("cycle").cast("string")).alias("target_table_name"),
        F.col("row_count").cast("bigint").alias("row_count"), F.col("rejected_rows").cast("bigint").alias("rejected_rows"),
        F.col("duration_ms").cast("bigint").alias("duration_ms"), F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"))


def http_date(c: Column) -> Column:
    """An HTTP date (``Tue, 02 Jan 2024 10:00:00 GMT``) as a time; anything else is NULL."""
    day = F.regexp_extract(c, r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), (\d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1)
    return F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("dd MMM yyyy HH:mm:ss")).cast("timestamp_ntz")


def fetch_change_status(fetches: DataFrame) -> DataFrame:
    """Compare the latest two fetches of each (cycle, table_name).

    ``fetches``: cycle, table_name, fetch_id, fetched_at, fetch_status, etag and perhaps last_modified.  A
    not-modified answer is ``unchanged``.  Otherwise entity tags decide where both fetches have one, compared
    weakly (a leading ``W/`` is not part of the tag); else the times of last modification where both are valid:
    the file is unchanged unless the newer one is later.  Without such a pair it counts as changed.
    """
    if "last_modified" not in fetches.columns:
        fetches = fetches.withColumn("last_modified", F.lit(None).cast("string"))
    tag = F.nullif(F.regexp_replace(F.trim("etag"), "^W/", ""), F.lit(""))
    answer = F.struct("fetched_at", "fetch_id", "fetch_status", "etag", tag.alias("tag"), http_date(F.col("last_modified")).alias("modified"))
    # The two newest answers by two partial aggregations: a key's whole log is never sorted.
    key = ["cycle", "table_name"]
    newest = fetches.groupBy(*key).agg(F.max(answer).alias("now"), F.count(F.lit(1)).alias("n_fetches"))
    earlier = (fetches.select(*key, answer.alias("_a")).join(newest.select(*key, "now"), key).where(F.col("_a") < F.col("now"))
               .groupBy(*key).agg(F.max("_a").alias("before")))
    both = newest.join(earlier, key, "left")
    status = (F.when(F.col("now.fetch_status") == "error", "error")
              .when(F.col("before").isNull(), "new")
              .when(F.col("now.fetch_status") == "not_modified", "unchanged")
              .when(F.col("now.tag").isNotNull() & F.col("before.tag").isNotNull(),
                    F.when(F.col("now.tag") == F.col("before.tag"), "unchanged").otherwise("changed"))
              .when(F.col("now.modified") <= F.col("before.modified"), "unchanged").otherwise("changed"))
    return both.select(*key, F.col("now.fetched_at").alias("last_fetched_at"), F.col("n_fetches").cast("bigint").alias("n_fetches"),
                       F.col("now.etag").alias("etag"), F.col("before.etag").alias("previous_etag"),
                       F.col("now.modified").alias("modified_at"), F.col("before.modified").alias("previous_modified_at"), status.alias("change_status"))
