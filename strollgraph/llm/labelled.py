"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.llm.text import fold
from strollgraph.session import cut


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` labelled ids, the first in hash order, outside fold 0 of five.

    Of several labels for an id the largest counts.  The ids are bounded by ``most``, so they are broadcast.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", 5) != 0))
    ids = (
        known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id"))
