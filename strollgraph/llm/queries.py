"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strollgraph.llm import (
    divergence, langid, licenses, lloyd, logbilinear, mixing, pieces, quality_classifier, quality_rules, ring, simhash, spotsigs, toxicity,
)
from strollgraph.llm.text import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: how many units match, and the best."""
    best = licenses.best_match(F.col("matches"))
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "matches", best.alias("best")).select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"), "best.licence", F.round(-F.col("best.dice"), 6).alias("dice"),
        "best.kind", "best.number",
    )


@query
def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 6).alias("distance"),
    )


@query
def op3_nearest_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )


@query
def op4_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scored = quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op5_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    rows = spotsigs.fingerprint_rows(table(spark, sf_dir, "documents"))
    mine = F.col("signatures")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.as_text(mine).alias("fingerprint"), spotsigs.as_text(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(mine, F.col("edited_signatures")).alias("near_edited"),
        F.coalesce(spotsigs.likeness(mine, F.col("next_signatures")), F.lit(0.0)).alias("near_next"),
    )


@query
def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 24 shards; counts differ by one at most."""
    return ring.shard_rows(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("owner").alias("ring_owner"),
    )


@query
def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, out="_found").select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("_found.lang").alias("lang_pred"), "_found.score",
        F.size("_found.spans").alias("n_spans"),
    )


@query
def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces and the best segmentations of every document, and the digest of the text that its pieces decode to."""
    return pieces.round_trip_rows(table(spark, sf_dir, "documents"))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op11_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learned from six sevenths of them."""
    held_out = fold("doc_id", 7) == 2
    return logbilinear.score_texts(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", held_out)


@query
def op12_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every usable vector."""
    return lloyd.cluster(table(spark, sf_dir, "embeddings"))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms that set it apart."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES["op1_license_scan"] = licenses.scan_sql()
ORACLES["op10_source_mix"] = mixing.MIX_SQL
ORACLES["op12_sharded_lloyd"] = lloyd.cluster_sql()
ORACLES["op13_source_divergence"] = divergence.divergence_sql()
