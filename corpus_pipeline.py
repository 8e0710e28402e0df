"""The corpus pipeline: stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import exact_dedup, jaccard, langid, mixing, packing, simhash
from sensorloom.llm.common import located, set_aside, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell; it learns from the labels outside the held-out fold."""
    net = langid.fit(docs.filter(~langid.held_out()))
    return langid.keep_identified(docs, net)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near fingerprints, then of those that stay one of every component of similar shingle sets."""
    mine, back = set_aside(docs, doc_id="doc_id", text="text")
    whole = located(mine)
    first = stored(simhash.near_places(whole), "near-fingerprints")
    kept = jaccard.near_places(whole, first)
    return back(whole.join(kept, ["_file", "_row"], "left_semi"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in packed sequences."""
    placed = packing.pack(docs)
    return placed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing", mix), ("packing", sequences)]

# Learnt models, fingerprints and draws can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
