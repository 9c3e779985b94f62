"""Benchmark decontamination by template windows, in DataFrame operations only.

Words lose their outer punctuation and case; numbers, units and names become typed
placeholders.  Each run of ``k`` template words is hashed together with the pattern of
equal values among its slots, and documents meet benchmark items in a hash join on it.
Matches are lined up by item and offset.  The templates of a line-up count only if their slots
agree: one value of the item stands for one value of the document wherever it occurs.  So a question
asked again with other numbers or names is found, and unrelated text that merely has
numbers in the same places is not.  Each run is also hashed by its plain words, so windows
of mostly placeholders, and texts in other capitals, are found where they stand word for word;
such matches count whatever the slots of other windows say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.native_words import cut_edges, grams, held, plain, raw_words
from ledgerline.llm.stage import cut, free_name

#: Fixed value: words that name a unit.
UNITS = ["mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "inch", "inches", "foot", "feet", "mile", "miles", "pound", "pounds",
         "ounce", "ounces", "gram", "grams", "kilogram", "kilograms", "meter", "meters", "kilometer", "kilometers", "liter", "liters",
         "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "°c", "°f", "kwh", "mph", "km/h"]


def _placeholder(low: Column, i: Column) -> Column:
    """The placeholder of a lower-case word, or null; a name is a capital word that does not begin a sentence."""
    first = F.substring(F.get("cut", i), 1, 1)
    name = (F.get("cut", i) != low) & (i > 0) & (first != F.lower(first)) & ~F.substring(F.get("raw", i - 1), -1, 1).isin(".", "!", "?", ":", "|")
    return F.when((low >= "0") & (low < ":"), F.lit("<number>")).when(low.isin(UNITS), F.lit("<unit>")).when(name, F.lit("<name>"))


def _windows(table: DataFrame, key: str, text_col: str, k: int, most: int, whole: int, prefix: str, sought: list[int] | None = None) -> DataFrame:
    """(key, h, plain, pos, slots, windows): every window of ``k`` words, by its plain words and by its template.

    ``h`` hashes the template and the pattern of its slots, ``plain`` the template alone.  Templates of more
    than ``most`` slots (``whole`` if the window is the whole text) are left out.  A window goes by its plain
    words as a template without slots.  With ``sought``, only texts that hold one of these plain hashes go
    through the dearer steps.
    """
    words = held(table.select(key, text_col), raw=raw_words(F.col(text_col))).where(F.size("raw") >= k)
    words = held(words.select(key, "raw"), cut=cut_edges(F.col("raw")))
    words = held(words, low=F.transform("cut", F.lower))
    words = held(words, t=F.transform("low", lambda w, i: F.xxhash64(F.coalesce(_placeholder(w, i), plain(w, F.col("raw"), i)))),
                 e=F.transform("low", lambda w, i: F.xxhash64(plain(w, F.col("raw"), i))))
    words = grams(grams(words, "t", k, "template"), "e", k, "exact")
    if sought is not None:
        known = ", ".join(f"{x}L" for x in sought) or "null"
        words = words.where(F.expr(" or ".join(f"exists({c}, x -> x in ({known}))" for c in ("template", "exact"))))
    words = held(words, v=F.transform("low", lambda w, i: F.when(_placeholder(w, i).isNotNull(), w))).select(key, "template", "exact", "v")
    words = words.withColumn("n", F.size("exact"))

    def window(i: Column) -> Column:
        slots = F.filter(F.slice("v", i, F.lit(k)), lambda x: x.isNotNull())
        return F.struct(i.alias("pos"), F.get("template", i - 1).alias("template"), F.get("exact", i - 1).alias("exact"), slots.alias("slots"))

    out = words.select(key, "n", F.inline(F.transform(F.sequence(F.lit(1), F.col("n")), window)))
    same = F.transform("slots", lambda x: F.array_position("slots", x))
    slots = F.size("slots")
    few = (slots > 0) & (slots <= F.when(F.col("n") == 1, whole).otherwise(most))
    none = F.slice("slots", 1, 0)
    by = lambda own, same, slots: F.struct(F.xxhash64(own, same, F.lit(k)).alias("h"), F.col(own).alias("plain"), slots.alias("slots"))
    exact = by("exact", F.slice(same, 1, 0), none)
    return out.select(F.col(key), F.col("n").alias(f"{prefix}windows"), F.col("pos").alias(f"{prefix}pos"),
                      F.inline(F.when(few, F.array(exact, by("template", same, F.col("slots")))).otherwise(F.array(exact)))).withColumnRenamed("slots", f"{prefix}slots")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", k: int = 8, literal: int = 4, share: float = 0.3, broadcast_rows: int = 500_000,
                 inline_rows: int = 50_000) -> DataFrame:
    """(doc_id, item_id, n_matched, n_windows, share): documents that hold at least ``share`` of an item's windows,
    word for word or as templates whose slots agree along the line-up.

    An item of fewer than ``k`` words is one window, sought among the windows of its own length.  Windows
    with fewer than ``literal`` words that are not placeholders are found only word for word, in any
    capitals; a whole text shorter than ``k`` may have ``k - literal`` placeholders.  Null and empty texts match nothing; rows that share an id are judged
    together, as are repeated rows; null ids are not judged.  The benchmark windows are broadcast if
    there are at most ``broadcast_rows``, else both sides are shuffled; at most ``inline_rows`` of them
    also serve as a first filter of whole documents, which saves time and drops no match.
    """
    items = held(benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null"),
                 k=F.least(F.size(raw_words(F.col("text"))), F.lit(k)))
    lengths = sorted({r.k for r in items.select("k").distinct().collect()} - {0} | {k})
    item = None
    for n in lengths:
        own = _windows(items.where(F.col("k") == n), "item_id", "text", n, n - literal, k - literal, "i_").withColumn("k", F.lit(n))
        item = own if item is None else item.union(own)
    item = cut(item)
    n_item = item.count()
    sought: dict[int, list[int]] | None = None
    if n_item <= inline_rows:
        sought = {n: [] for n in lengths}
        for r in item.select("k", "plain").distinct().collect():
            sought[r.k].append(r.plain)
    item = item.drop("k", "plain")
    if n_item <= broadcast_rows:
        item = F.broadcast(item)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    doc = None
    for n in lengths:
        own = _windows(texts, "doc_id", "text", n, n - literal, k - literal, "d_", sought and sought[n]).drop("plain")
        doc = own if doc is None else doc.union(own)
    hits = doc.join(item, "h").select("doc_id", "item_id", (F.col("d_pos") - F.col("i_pos")).alias("offset"), "i_pos", "i_windows",
                                      F.explode_outer(F.arrays_zip(F.col("i_slots").alias("i"), F.col("d_slots").alias("d"))).alias("slot"))
    values = hits.groupBy("doc_id", "item_id", "offset", "i_pos", "i_windows", F.col("slot.i").alias("i")).agg(
        F.min("slot.d").alias("lo"), F.max("slot.d").alias("hi"))
    lined = values.groupBy("doc_id", "item_id", "offset", "i").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set("i_pos").alias("at"), F.first("i_windows").alias("i_windows"))
    # rows without a slot value are windows found word for word
    agreed = (lined.groupBy("doc_id", "item_id", "offset").agg(
        F.bool_and(F.col("i").isNull() | (F.col("lo") == F.col("hi"))).alias("agree"),
        F.flatten(F.collect_list(F.when(F.col("i").isNull(), F.col("at")))).alias("exact"),
        F.flatten(F.collect_list(F.when(F.col("i").isNotNull(), F.col("at")))).alias("template"), F.first("i_windows").alias("n_windows"))
        .withColumn("at", F.array_distinct(F.when(F.col("agree"), F.concat("exact", "template")).otherwise(F.col("exact")))))
    found = agreed.select("doc_id", "item_id", "n_windows", F.explode("at").alias("at")).groupBy("doc_id", "item_id", "n_windows").agg(
        F.count_distinct("at").alias("n_matched"))
    part = F.col("n_matched") / F.col("n_windows")
    return found.where(part >= share).select("doc_id", "item_id", "n_matched", F.col("n_windows").cast("bigint").alias("n_windows"), part.alias("share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 500_000, **options) -> DataFrame:
    """``docs`` without the documents that hold benchmark items; rows with a null id stay.

    The ids to drop are broadcast if there are at most ``broadcast_rows``, else both sides are shuffled.
    """
    name = free_name(docs, "contaminated")
    bad = cut(contaminated(docs, benchmark, id_col, broadcast_rows=broadcast_rows, **options).select(F.col("doc_id").alias(name)).distinct())
    if bad.count() <= broadcast_rows:
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(id_col).cast("bigint") == F.col(name), "left_anti")
