"""A corpus pipeline of five stages: language, near copies, benchmark leaks, mix, shards.

Each stage is ``function(spark, docs, sf_dir) -> DataFrame`` over ``docs``, what the stage before it
kept, written as Parquet and read again as the next one's ``docs``.  All but the last return the
columns they were given; the mix returns a document as often as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.config import materialize
from orderlake.llm import decontamination, jaccard_join, langid, mixing, sharding
from orderlake.llm.common import ship_package
from orderlake.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language isn't recognised.  Learns from their ``lang`` (not the held-out ones')."""
    ship_package(spark)
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle links connect: the one with the smallest id."""
    ship_package(spark)
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    ship_package(spark)
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), mode="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights, a row per copy, in order of training."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the shard and the place in it."""
    return sharding.sharded(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# A trained language model decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
