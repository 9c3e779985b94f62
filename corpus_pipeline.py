"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  Rows with nulls, empty texts and repeated rows are handled as the operators'
docstrings say; a row that no stage rejects is kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import quality
from ledgerline.llm.decontaminate import decontaminate
from ledgerline.llm.jaccard_join import keep_one
from ledgerline.llm.pii import find_pii
from ledgerline.llm.queries import QUALITY_BAR, pack, table
from ledgerline.llm.stage import ensure_checkpoint_dir, free_name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score, held = free_name(docs, "score"), free_name(docs, "held_out")
    scored = quality.score(docs, model, score_col=score, held_col=held)
    return scored.where(F.col(score) >= QUALITY_BAR).drop(score, held)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked documents."""
    return keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    spans, masked = free_name(docs, "spans"), free_name(docs, "masked")
    found = find_pii(docs, spans_col=spans, masked_col=masked)
    new = {"text": F.col(masked)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size(spans) > 0, F.length(masked).cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in the sequences."""
    return pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", mask_pii),
    ("packing", pack_sequences),
]

#: Latent vectors and byte-pair ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
