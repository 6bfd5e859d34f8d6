import hashlib
import random

import pytest
from pyspark.sql import types as T

from strollgraph.llm import lloyd
from strollgraph.llm.queries import QUERIES

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType()),
])


def brute(rows, dims, k, rounds, salt="2:"):
    kept = [(i, [int((256 * x) // 1) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and abs(x) < float("inf") for x in v)]
    first = sorted((i is None, hashlib.sha256(f"{salt}{i}".encode()).hexdigest() if i is not None else "", q) for i, q in kept)
    centroids = [q for *_, q in first[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((apart(q, c), n) for n, c in enumerate(centroids)) for _, q in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            own = [q for (_, q), (_, m) in zip(kept, near) if m == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = sum(d for d, _ in near)
    return sorted(
        [(i, n, d, sum(e for e, m in near if m == n), inertia, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
         for (i, _), (d, n) in zip(kept, near)], key=str)


def test_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(i % 4, 0.7) for _ in range(20)]) for i in range(300)]
    rows = [(i, [float.fromhex(float(int(x * 4096)).hex()) / 4096 for x in v]) for i, v in rows]
    rows += [(500 + i, rows[0][1]) for i in range(200)]  # one vector with many copies
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1])]  # repeated rows and no key
    odd = [(900, None), (901, []), (902, [1.0] * 19), (903, [1.0] * 21), (904, [None] + [0.0] * 19), (905, [float("nan")] + [0.0] * 19),
           (906, [float("inf")] + [0.0] * 19), (None, None)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], SCHEMA).repartition(4)
    monkeypatch.setattr(lloyd, "CHUNK", 37)
    monkeypatch.setattr(lloyd, "WIDTH", 7)  # the last block is narrower
    got = lloyd.cluster(df, dims=20, k=9, rounds=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20, 9, 3)


def test_few_rows_ties_and_empty_tables(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, -1.0])]
    make = lambda rows: spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    got = sorted((tuple(r) for r in lloyd.cluster(make(rows), dims=2, k=40).collect()), key=str)
    assert got == brute(rows, 2, 40, 5)  # equal centroids: the smaller number wins, the other stays empty
    empty = lloyd.cluster(make([]), dims=2)
    assert empty.collect() == [] and empty.dtypes == lloyd.cluster(make(rows), dims=2).dtypes
    assert lloyd.cluster(make([(1, [1.0]), (2, None)]), dims=2).count() == 0


def test_too_large_components_stop_the_run(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], None)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        lloyd.cluster(df, dims=2).collect()


def test_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()][:150]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    df.drop("cluster").write.parquet(path := f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/lloyd-{random.getrandbits(60)}/embeddings.parquet")
    got = QUERIES["op12_sharded_lloyd"](spark, path.rpartition("/")[0])
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 64, 40, 5)
