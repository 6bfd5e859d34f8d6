"""The corpus pipeline: documents in, encoded documents out.

Each stage takes (spark, docs, sf_dir) and keeps the columns of the documents, but for the last, which returns the pieces.  The result of a stage
is written as Parquet in the shared folder and read again as the next one's documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strollgraph.llm import langid, mixing, pieces, quality_rules, simhash
from strollgraph.session import cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that holds enough of their letters go."""
    return langid.kept_rows(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their group go."""
    return quality_rules.kept_rows(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the least id.  SimHash classes and the similar pairs outside them form the groups."""
    return simhash.first_of_groups(docs, by_fingerprint=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document."""
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and its best segmentations, and the digest of the text that the pieces decode to."""
    return pieces.round_trip_rows(docs)


STAGES = [
    ("language identification", identify_language),
    ("quality rules", apply_quality_rules),
    ("near duplicates", remove_near_duplicates),
    ("source mix", mix_sources),
    ("pieces", encode_pieces),
]

#: The models of the first two stages and the lattice search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
