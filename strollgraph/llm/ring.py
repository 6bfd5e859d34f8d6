"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 65,536 places.  A key belongs to the first virtual node at or after its place; a shard that is full passes the
keys above its bound clockwise to the next shard with room.  The bounds add up to the number of rows, so counts differ by one at most.

Only counts decide: rows per place (at most 65,536 numbers, whatever the input) give every shard's own ranks, and
the counts of the arcs (shards times virtual nodes) say how many ranks of an arc go to which shard.  Rows
are then numbered within their place and look their span up.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strollgraph.llm.text import row_key
from strollgraph.session import cut

PLACES = 65536


def ring_places(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """``place, arc, owner`` for all places.  An arc ends at its virtual node; the places after the last node form
    one more arc of the first node's shard.  Of nodes on one place the least shard counts."""
    node = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.conv(F.substring(F.md5(F.concat_ws("/", F.col("id") % shards, F.expr(f"id div {shards}")).cast("binary")), 1, 4), 16, 10)
        .cast("int").alias("arc"),
    )
    ends = node.groupBy("arc").agg(F.min("shard").alias("owner"))
    bounded = ends.unionByName(
        ends.agg(F.min_by("owner", "arc").alias("owner"), F.max("arc").alias("_last"))
        .where(F.col("_last") < PLACES - 1).select(F.lit(PLACES - 1).alias("arc"), "owner")
    )
    start = F.coalesce(F.lag("arc").over(Window.orderBy("arc")) + 1, F.lit(0))
    return bounded.withColumn("_start", start).select(
        F.explode(F.sequence("_start", "arc")).alias("place"), "arc", "owner"
    )


def spans(arcs: list[tuple[int, int, int]], shards: int) -> list[dict]:
    """Where the ranks of each owner go, from ``(arc, owner, rows)``: a few numbers per virtual node.

    A shard first keeps its own keys up to its bound.  What is above goes on clockwise, arc by arc.
    """
    rows = sum(n for _, _, n in arcs)
    bound = [rows // shards + (s < rows % shards) for s in range(shards)]
    own = [0] * shards
    waiting = []
    for at, (_, owner, n) in enumerate(sorted(arcs)):
        low, high = max(own[owner], bound[owner]), own[owner] + n
        own[owner] = high
        if low < high:
            waiting.append((at, owner, low, high))
    filled = [min(n, b) for n, b in zip(own, bound)]
    out = [{"owner": s, "low": 0, "high": filled[s], "shard": s, "slot": 0} for s in range(shards) if filled[s]]
    owners = [owner for _, owner, _ in sorted(arcs)]
    for at, owner, low, high in waiting:
        for step in range(1, len(owners) + 1):
            t = owners[(at + step) % len(owners)]
            n = min(high - low, bound[t] - filled[t])
            if n > 0:
                out.append({"owner": owner, "low": low, "high": low + n, "shard": t, "slot": filled[t]})
                filled[t] += n
                low += n
            if low == high:
                break
    return out


def shard_rows(docs: DataFrame, shards: int = 24, nodes: int = 64) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, owner`` for every row of ``docs`` (doc_id, text).

    ``size`` is the UTF-8 bytes of the text plus 8; ``slot`` numbers the rows of a shard from 0.  ``owner`` is the shard that the ring
    names before bounds.  A null text has size 8 and a null checksum; a null id hashes like a value; repeated rows are ranked side by
    side, so they may part where a shard is full; an empty table gives an empty result.  Every shard
    needs a virtual node of its own on the ring.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    keyed = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), row_key("doc_id", "text").alias("key"),
    ).withColumn("place", F.conv(F.substring("key", 1, 4), 16, 10).cast("int"))
    keyed = cut(keyed)
    counts = keyed.groupBy("place").agg(F.count("*").alias("rows"))
    places = cut(
        ring_places(spark, shards, nodes).join(counts, "place", "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .withColumn("_upto", F.sum("rows").over(Window.partitionBy("owner").orderBy("place")))
        .select("place", "arc", "owner", "rows", (F.col("_upto") - F.col("rows")).alias("before"))
    )
    arcs = [tuple(r) for r in places.groupBy("arc", "owner").agg(F.sum("rows")).collect()]
    if {owner for _, owner, _ in arcs} != set(range(shards)):
        raise ValueError("A shard has no place on the ring; use more virtual nodes")
    span = "struct<owner:int,low:bigint,high:bigint,shard:int,slot:bigint>"
    listed = (
        spark.range(1)
        .select(F.explode(F.from_json(F.lit(json.dumps(spans(arcs, shards))), f"array<{span}>")).alias("span"))
        .select("span", F.col("span.owner").alias("owner"))
    )
    meets = (F.col("span.low") < F.col("before") + F.col("rows")) & (F.col("span.high") > F.col("before"))
    routed = cut(
        places.where("rows > 0").join(listed, "owner").where(meets)
        .groupBy("place", "owner", "before").agg(F.collect_list("span").alias("spans"))
    )
    rank = F.row_number().over(Window.partitionBy("place").orderBy("key")) - 1
    ranked = keyed.withColumn("_rank", rank).join(routed, "place").withColumn("_rank", F.col("_rank") + F.col("before"))
    mine = F.filter("spans", lambda s: (s["low"] <= F.col("_rank")) & (F.col("_rank") < s["high"]))[0]
    return ranked.withColumn("_span", mine).select(
        "doc_id", "size", "text_crc32", F.col("_span.shard").alias("shard"),
        (F.col("_span.slot") + F.col("_rank") - F.col("_span.low")).alias("slot"), "owner",
    )
