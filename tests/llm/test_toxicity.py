from collections import Counter
import math
import random

import numpy as np

from strollgraph.llm import toxicity as T
from strollgraph.llm.queries import QUERIES


def test_search_equals_brute_force():
    rnd = random.Random(4)
    vocabulary = [(f"t{i}", rnd.randrange(1, 50)) for i in range(12)]
    seen = {}
    for _ in range(700):
        terms = tuple(sorted(rnd.sample(range(12), rnd.randrange(0, 4))))
        seen[(terms, tuple(rnd.randrange(1, 4) for _ in terms))] = rnd.randrange(1, 5)
    examples = [(t, c, n, rnd.randrange(n + 1), i) for i, ((t, c), n) in enumerate(seen.items())]
    index = T.build_index(vocabulary, 200, examples)
    filled = sorted(e for e in examples if e[0])
    for _ in range(200):
        query = {t: rnd.randrange(1, 4) for t in rnd.sample(range(12), rnd.randrange(1, 5))}
        k = rnd.choice([1, 5, 25, 4000])
        q = index.weights(query)
        sims = [round(sum(q.get(t, 0) * w for t, w in index.weights(dict(zip(e[0], e[1]))).items()), 9) for e in filled]
        order = sorted((i for i, s in enumerate(sims) if s > 0), key=lambda i: (-sims[i], i))
        held, expected, last = 0, [], None
        for i in order:
            if held >= k and sims[i] < last:
                break
            expected.append(i)
            held += filled[i][2]
            if held >= k and last is None:
                last = sims[i]
        got, cosines = index.search(query, k)
        assert sorted(got.tolist()) == sorted(expected)
        assert np.allclose(cosines, [sims[i] for i in got])


def test_held_out_accuracy(spark, small):
    sf = small.replace("0.001", "0.01")
    got = {r.doc_id: r for r in QUERIES["op3_nearest_toxic"](spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [d for d in labels if got[d].held_out]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert sum(got[d].predicted == labels[d] for d in held) >= 0.9 * len(held)


def world(make_docs, spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice("river stone house light people and the".split()) for _ in range(20)]
        if i % 4 == 0:
            words[3] = rnd.choice(["vile", "foul"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, "you are Vile!"), (903, "a calm river"), (None, "foul"), (904, "stone " * 40000 + "vile foul vile"), (902, "you are Vile!")]
    labels += [(5, None, None), (None, 1, 1), (4, 1, 1), (99999, 1, 1)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_edge_cases(make_docs, spark):
    docs, labels, rows = world(make_docs, spark)
    docs = docs.selectExpr("*", "1 as label", "2 as score", "'t' as terms")
    got = T.toxicity(docs, labels.selectExpr("*", "'x' as text")).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r for r in got}
    assert score[902].score > 0.8 and score[904].score > 0.8 and score[None].score > 0.8
    assert score[902].evidence and all(e.toxic > 0.5 for e in score[902].evidence)
    assert score[900].score == score[901].score < 0.2 and score[903].score < 0.2


def test_no_labels(make_docs, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in T.toxicity(make_docs([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert T.toxicity(make_docs([]), none).count() == 0
    one = spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id bigint, quality int, toxic int")
    assert T.toxicity(make_docs([(i, "same text") for i in range(9)]), one).first().score > 0.5
