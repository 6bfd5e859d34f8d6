"""Centroid clustering by Lloyd's rounds over column blocks.

Vectors are packed into chunks of rows, chunks are cut into blocks of ``WIDTH`` columns, and a row of the block table is one block of one chunk.
In a round every block meets only its own slice of the centroids: a task computes exact integer partial distances, ``reduceByKey`` adds the
blocks of a chunk and takes the nearest centroid.  The labels return to the blocks, whose shards add up their own columns and
move their own slice.  Chunks have a bounded number of rows and unique numbers, so neither a hot cluster nor a vector with many
copies gathers anywhere; the driver holds centroids only (``k`` times the dimensions).

All arithmetic is in integers: components are floor(``SCALE`` * x).  A component beyond ``LARGEST`` after scaling stops the run with a message,
since its squared distances need not fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.session import cut

SCALE = 256
#: Columns of a block, rows of a chunk.
WIDTH, CHUNK = 16, 1024
#: Largest component after scaling: 4096 squared differences of twice as much still fit 64 bits.
LARGEST = 1 << 24


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def scaled(vector: Column) -> Column:
    """The integer components of a usable vector."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * SCALE)
        return F.when(F.abs(y) <= LARGEST, y.cast("int")).otherwise(
            F.raise_error(F.lit(f"A component is beyond {LARGEST} after scaling")).cast("int")
        )

    return F.transform(vector, one)


def _packed(dims: int):
    """Chunks of (id, q) rows; their numbers join the partition and a counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            q = batch.column("_q")
            values, at = q.values.to_numpy(zero_copy_only=False).astype("<i4"), q.offsets.to_numpy()
            for low in range(0, len(q), CHUNK):
                high = min(low + CHUNK, len(q))
                part = values[at[low] : at[high]].reshape(high - low, dims)
                ids = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), batch.column("_id")[low:high])
                columns = [np.ascontiguousarray(part[:, c : c + WIDTH]).tobytes() for c in range(0, dims, WIDTH)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), ids, pa.array([columns], pa.list_(pa.binary()))], names=["chunk", "ids", "columns"]
                )
                number += 1

    return run


def partial_distances(block: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Squared distances of every row of the block to every centroid over the block's columns, as exact integers."""
    out = np.zeros((len(block), len(slices)), dtype=np.int64)
    for column in range(block.shape[1]):
        apart = block[:, column, None].astype(np.int64) - slices[None, :, column]
        out += apart * apart
    return out


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``chunk, labels, distances`` (int32 and int64 arrays as bytes): the nearest centroid of each row of a chunk, ties to the smaller number."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(centroids)

    def part(row) -> tuple[int, np.ndarray]:
        at = row["block"] * WIDTH
        slices = shared.value[:, at : at + WIDTH]
        return row["chunk"], partial_distances(np.frombuffer(row["data"], "<i4").reshape(-1, slices.shape[1]), slices)

    def nearest(total: np.ndarray) -> tuple[bytearray, bytearray]:
        best = total.argmin(axis=1)
        return bytearray(best.astype("<i4").tobytes()), bytearray(total[np.arange(len(total)), best].tobytes())

    found = blocks.select("chunk", "block", "data").rdd.map(part).reduceByKey(np.add).map(lambda kv: (kv[0], *nearest(kv[1])))
    return cut(spark.createDataFrame(found, "chunk bigint, labels binary, distances binary"))


def _slice_sums(k: int):
    """Rows and sums of columns for every centroid, added up within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data, labels in zip(*(batch.column(c).to_pylist() for c in ("block", "data", "labels"))):
                labels = np.frombuffer(labels, "<i4")
                rows = np.frombuffer(data, "<i4").reshape(len(labels), -1)
                order = np.argsort(labels, kind="stable")
                starts = np.flatnonzero(np.diff(labels[order], prepend=-1))
                own = np.column_stack([np.ones(len(rows), dtype=np.int64), rows.astype(np.int64)])[order]
                total = sums.setdefault(block, np.zeros((k, own.shape[1]), dtype=np.int64))
                total[labels[order][starts]] += np.add.reduceat(own, starts, axis=0)
        for block, total in sums.items():
            centroid = np.repeat(np.arange(k), total.shape[1] - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(total.shape[1] - 1) + block * WIDTH, k), pa.int32()), pa.array(centroid, pa.int32()),
                 pa.array(total[:, 1:].ravel()), pa.array(np.repeat(total[:, 0], total.shape[1] - 1))],
                names=["dim", "centroid", "total", "n"],
            )

    return run


def _moved(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: every slice moves to floor(sum / count) of its rows, empty centroids stay."""
    held = blocks.join(assigned.select("chunk", "labels"), "chunk").select("block", "data", "labels")
    sums = held.mapInArrow(_slice_sums(len(centroids)), "dim int, centroid int, total bigint, n bigint").groupBy("dim", "centroid").agg(
        F.sum("total").alias("s"), F.sum("n").alias("n")
    )
    # Integer division cuts towards zero; taking the remainder away first makes it a floor.
    slices = sums.where("n > 0").select("dim", "centroid", F.expr("(s - pmod(s, n)) div n").alias("value"))
    out = centroids.copy()
    for r in slices.collect():  # one row for each component of a centroid
        out[r["centroid"], r["dim"]] = r["value"]
    return out


def _results(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, distances = (
                pa.array(np.frombuffer(b"".join(batch.column(c).to_pylist()), t)) for c, t in (("labels", "<i4"), ("distances", "<i8"))
            )
            yield pa.RecordBatch.from_arrays([batch.column("ids").flatten(), labels, distances], names=[kind, "cluster", "distance"])

    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5, salt: str = "2:"
) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every usable row of ``vectors``.

    The first centroids are the ``k`` usable rows with the least SHA-256 of ``salt`` and their key; rows without a key come last, equal ones in the
    order of their components, and with fewer rows than ``k`` there are fewer centroids.  Each of ``rounds`` rounds assigns all rows and moves
    the centroids; a last pass assigns again.  Rows of another length or with null or non-finite components are left
    out, repeated rows all count and are all returned, and an empty table gives an empty result.
    """
    picked = vectors.where(usable(F.col(vector), dims)).select(F.col(key).alias("_id"), scaled(F.col(vector)).alias("_q"))
    chunks = cut(picked.mapInArrow(_packed(dims), f"chunk bigint, ids array<{picked.schema['_id'].dataType.simpleString()}>, columns array<binary>"))
    # Each task holds blocks of the same columns, so a centroid slice is all it uses.
    blocks = cut(chunks.select("chunk", F.posexplode("columns").alias("block", "data")).repartition("block", F.pmod(F.xxhash64("chunk"), F.lit(64))))
    first = F.sha2(F.concat(F.lit(salt), F.col("_id").cast("string")).cast("binary"), 256)
    starts = picked.withColumn("_h", first).orderBy(F.col("_h").asc_nulls_last(), "_q").limit(k).collect()
    centroids = np.array([r["_q"] for r in starts], dtype=np.int64).reshape(len(starts), dims)
    if not len(centroids):
        return picked.select(
            F.col("_id").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"),
            F.lit(0).cast("bigint").alias("cluster_inertia"), F.lit(0).cast("bigint").alias("inertia"), F.lit("").alias("centroid_sha256"),
        )
    assigned = _assigned(blocks, centroids)
    for _ in range(rounds):
        centroids = _moved(blocks, assigned, centroids)
        assigned = _assigned(blocks, centroids)
    kind = picked.schema["_id"].dataType.simpleString()
    rows = cut(chunks.select("chunk", "ids").join(assigned, "chunk").drop("chunk").mapInArrow(
        _results("_id"), f"_id {kind}, cluster int, distance bigint"
    ))
    inertia = rows.groupBy("cluster").agg(F.sum("distance").alias("i")).collect()  # at most k rows
    total = sum(r["i"] for r in inertia)
    table = rows.sparkSession.createDataFrame(
        [(r["cluster"], r["i"], total, digest(centroids[r["cluster"]])) for r in inertia],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return rows.join(F.broadcast(table), "cluster").select(
        F.col("_id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def cluster_sql(dims: int = 64, k: int = 40, rounds: int = 5, salt: str = "2:") -> str:
    """The same in SQL, one pair of common tables a round."""
    apart = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q "
        f"FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, q) - 1 AS c, q FROM v "
        f"QUALIFY row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, q) <= {k})",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"a{r} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (SELECT v.r, c.c, {apart} AS d FROM v, c{r} AS c) GROUP BY r)"
        )
        if r < rounds:
            parts.append(
                f"u{r} AS (SELECT best.c AS c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM "
                f"(SELECT best, unnest(range(1, {dims} + 1)) AS i, unnest(q) AS x FROM v JOIN a{r} USING (r)) GROUP BY 1, 2), "
                f"c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(u.q, c.q) AS q FROM c{r} AS c LEFT JOIN (SELECT c, list(x ORDER BY i) AS q FROM u{r} GROUP BY c) AS u USING (c))"
            )
    return (
        "WITH " + ", ".join(parts)
        + f" SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, "
        f"CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia, "
        f"sha256(array_to_string(f.q, ',')) AS centroid_sha256 FROM v JOIN a{rounds} USING (r) JOIN c{rounds} AS f ON f.c = best.c"
    )
