"""Typed raw tables as the registered queries see them.

``typed(spark, sf_dir, "pas2")`` = landing lines rendered from the driver
tables (``sources.render``) -> layout scan (``sources.delimited``).  In a real
deployment the same ``parse_lines`` runs over text or ZIP members and the
result is written once, partitioned by ``cycle`` (``sources.sinks``); the
operators downstream take any DataFrame with the layout's columns.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.manifest import even_cycles
from ledgerline.sources.delimited import parse_lines
from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.render import render_lines


def lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return render_lines(spark, sf_dir, table)


def typed(spark: SparkSession, sf_dir: str, table: str, keep_raw: Iterable[str] = (),
          filtered: bool = False) -> DataFrame:
    return parse_lines(lines(spark, sf_dir, table), LAYOUTS[table], keep_raw=keep_raw, filtered=filtered)


def expected_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles asked for: the even cycles from two years before the first ship year to the last."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    yrs = li.agg((F.min(F.year("l_shipdate")) - 2).alias("lo"), F.max(F.year("l_shipdate")).alias("hi"))
    return yrs.select(F.explode(even_cycles(F.col("lo"), F.col("hi"))).alias("cycle")) \
        .select(F.col("cycle").cast("int").alias("cycle"))


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).pas2`` is the typed pas2 frame.

    One accessor per (session, ``sf_dir``): the typed-table plans and the
    plans of the parent key sets are built once per session and shared by every
    query built on it.  A DataFrame is an immutable lazy plan, so sharing it
    only saves plan construction; each query still scans and computes its data.
    """

    _shared: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

    def __new__(cls, spark: SparkSession, sf_dir: str):
        per_session = cls._shared.setdefault(spark, {})
        inst = per_session.get(sf_dir)
        if inst is None:
            inst = super().__new__(cls)
            inst.spark = spark
            inst.sf_dir = sf_dir
            inst._memo = {}
            inst.parents = {}  # (parent table, column) -> key set plan, see operators.checks
            inst.cycles = expected_cycles(spark, sf_dir)
            per_session[sf_dir] = inst
        return inst

    def __getattr__(self, name: str) -> DataFrame:
        if name in LAYOUTS:
            return self.get(name)
        raise AttributeError(name)

    def get(self, name: str, keep_raw: Iterable[str] = (), filtered: bool = False) -> DataFrame:
        """Typed table; the same (lazy) DataFrame object is reused for the session.  ``filtered``: see ``parse_lines``."""
        key = (name, tuple(keep_raw), filtered)
        if key not in self._memo:
            self._memo[key] = typed(self.spark, self.sf_dir, name, *key[1:])
        return self._memo[key]
