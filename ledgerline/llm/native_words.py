"""Word arrays by column expressions only (for the operators that stay inside the JVM)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: characters taken off the ends of a word.
EDGES = ".,;:!?*#$%&|()[]{}<>\"'`~^_=+-/\\"


def raw_words(text: Column) -> Column:
    """Words of a text as they stand; null: none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def cut_edges(words: Column) -> Column:
    """Words without the punctuation at their ends; perhaps empty."""
    return F.transform(words, lambda w: F.btrim(w, F.lit(EDGES)))


def plain(low: Column, raw: Column, i: Column) -> Column:
    """A lower-case word, or the word as it stands if it is punctuation only."""
    return F.when(low == "", F.get(raw, i)).otherwise(low)


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row.

    The optimiser may copy a projected expression into a filter or a lambda above it, where it would
    run again for every element; it does not move expressions out of a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def grams(df: DataFrame, source: str, k: int, name: str) -> DataFrame:
    """``df`` with the hash of each run of ``k`` elements of an array of hashes; one hash for a shorter array, none for an empty one.

    Runs are doubled (1, 2, 4, ...) and joined, so an element costs about log2(k) small hashes.
    """
    width, have, step = 1, source, 0
    joined: list[str] = []
    while width < k:
        grow = min(width, k - width)
        step += 1
        new = f"_{name}{step}"
        ahead = lambda x, i: F.xxhash64(x, F.get(have, i + grow))  # noqa: B023,E731  called at once
        df = held(df, **{new: F.transform(have, ahead)})
        joined.append(new)
        width, have = width + grow, new
    n = F.size(source)
    return held(df, **{name: F.slice(have, 1, F.greatest(n - k + 1, F.lit(1)))}).drop(*joined)
