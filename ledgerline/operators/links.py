"""Link audit over a page table (M1..M4), re-aimed from a file lint.

* extraction: ``href`` with double or single quotes (case-sensitive pattern),
  trimmed; blank hrefs are skipped;
* kind: ``anchor`` (``#...``, ``.``, ``..``), ``skip`` (mailto/tel/javascript/
  data, case-insensitive), ``remote`` (http/https, case-insensitive; not
  probed -> ok), ``local`` otherwise;
* local check: path before ``?``/``#`` with dot segments resolved, relative to
  the source page's directory unless site-absolute (no path at all is the page
  itself), must be the path of a known page of the same host;
* totals per source page.

The known-path set grows with the page table, so it is joined with a
join that AQE sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



# The href pattern (double-quoted | single-quoted alternative).
HREF_PATTERN = r"""href\s*=\s*"([^"]+)"|href\s*=\s*'([^']+)'"""
SKIP_PATTERN = r"(?i)^(mailto:|tel:|javascript:|data:)"
REMOTE_PATTERN = r"(?i)^(https?://)"  # fixed value, as is the pattern above


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path_of(url: Column) -> Column:
    p = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(p == "", "/").otherwise(p)


def resolve_dots(path: Column) -> Column:
    """Absolute path without ``.`` and ``..`` segments; ``..`` at the root stays at the root."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    tail = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def extract_links(pages: DataFrame) -> DataFrame:
    """M1: ``pages(page_id, url, html)`` -> ``(page_id, source_url, position, href)``."""
    g1 = F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1)
    g2 = F.regexp_extract_all("html", F.lit(HREF_PATTERN), 2)
    z = pages.select("page_id", F.col("url").alias("source_url"),
                     F.posexplode(F.arrays_zip(g1.alias("a"), g2.alias("b"))).alias("position", "m"))
    href = F.when(F.col("m.a") != "", F.col("m.a")).otherwise(F.col("m.b"))
    return z.select("page_id", "source_url", (F.col("position") + 1).cast("bigint").alias("position"),
                    _strip_ws(href).alias("href")).where(F.col("href") != "")


def classify(links: DataFrame) -> DataFrame:
    """M2: add ``kind``."""
    h = F.col("href")
    kind = (F.when(h.startswith("#") | h.isin(".", ".."), "anchor")
            .when(h.rlike(SKIP_PATTERN), "skip")
            .when(h.rlike(REMOTE_PATTERN), "remote")
            .otherwise("local"))
    return links.withColumn("kind", kind)


def check_local(links: DataFrame, pages: DataFrame) -> DataFrame:
    """M3: ``ok`` / ``error`` for every link (only local links can fail)."""
    known = (pages.select(host_of(F.col("url")).alias("_h"), path_of(F.col("url")).alias("_p")).distinct()
             .withColumn("_hit", F.lit(True)))
    path_only = F.split(F.col("href"), "[?#]", 2).getItem(0)
    src_path = path_of(F.col("source_url"))
    base_dir = F.regexp_replace(src_path, "/[^/]*$", "")
    joined = F.when(path_only.startswith("/"), path_only).otherwise(F.concat(base_dir, F.lit("/"), path_only))
    target = (F.when(path_only == "", src_path)
              .when(joined.contains("/."), resolve_dots(joined)).otherwise(joined))
    df = links.withColumn("target_path", F.when(F.col("kind") == "local", target)) \
        .withColumn("_host", host_of(F.col("source_url")))
    j = df.join(known, (F.col("_host") == F.col("_h")) & (F.col("target_path") == F.col("_p")), "left")
    ok = (F.col("kind") != "local") | F.col("_hit").isNotNull()
    return j.select(
        "page_id", "source_url", "position", "href", "kind", "target_path", ok.alias("ok"),
        F.when(~ok, F.concat(F.lit("Missing: "), F.col("target_path")))
        .when(F.col("kind") == "remote", "skipped").otherwise("").alias("error"))


def link_summary(checked: DataFrame) -> DataFrame:
    """M4: totals per source page."""
    k = F.col("kind")
    return checked.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("ok")).alias("broken"),
        F.count_if(k == "anchor").alias("anchors"), F.count_if(k == "skip").alias("skipped"),
        F.count_if(k == "remote").alias("remote"), F.count_if(k == "local").alias("local"))
