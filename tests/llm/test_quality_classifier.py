import random

import numpy as np

from strollgraph.llm import quality_classifier as Q
from strollgraph.llm.queries import QUERIES


def test_features_equal_brute_force(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abé日 ") for _ in range(rnd.randrange(60))).encode() for _ in range(40)] + [b"", b"a", b"ab", b"abc"]
    whole = Q.features(texts)
    assert np.array_equal(whole[:, : Q.TRIGRAMS].sum(axis=1), [max(0, len(t) - 2) for t in texts])
    monkeypatch.setattr(Q, "CHUNK_BYTES", 7)  # many chunks and pieces count the same
    monkeypatch.setattr(Q, "CHUNK_DOCS", 3)
    assert np.array_equal(whole, Q.features(texts))
    for t, row in zip(texts, whole):
        words, last, gaps = t.split(), {}, [0] * Q.GAPS
        for i, w in enumerate(words):
            gaps[Q.GAPS - 1 if w not in last else min(Q.GAPS - 2, (i - last[w]).bit_length() - 1)] += 1
            last[w] = i
        assert row[Q.TRIGRAMS :].tolist() == gaps


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.4, (300, Q.FEATURES)).astype(np.float32)
    labels = rng.integers(0, 2, 300)
    model = Q.fit(counts, labels)
    queries = rng.poisson(0.4, (20, Q.FEATURES)).astype(np.float32)
    got = Q.votes(model, queries)
    z = Q._projected(queries, model.idf, model.basis)
    for i in range(20):
        sims = model.vectors @ z[i]
        near = sorted(range(300), key=lambda j: -sims[j])[: Q.NEIGHBOURS]
        w = np.maximum(0, sims[near]).astype(float) ** Q.SHARPNESS
        assert abs(got[i] - (w * labels[near]).sum() / w.sum()) < 1e-4


def test_held_out_accuracy(spark, small):
    sf = small.replace("0.001", "0.01")
    got = {r.doc_id: r for r in QUERIES["op4_latent_neighbours"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [d for d in labels if got[d].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(got[d].predicted == labels[d] for d in held) >= 0.93 * len(held)


def test_edge_cases(make_docs, spark):
    rnd = random.Random(2)
    good = lambda: " ".join(rnd.choice("river stone house light people and the".split()) for _ in range(40))
    rows = [(i, good() if i % 3 else "%%% " + good().replace(" ", "$$$ ")) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "a"), (903, good()), (904, good().replace(" ", "$$$ ")), (None, good()), (905, good() * 2000), (903, rows[1][1])]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 1), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    docs = make_docs(rows).selectExpr("*", "1 as label", "2 as score", "'f' as features")
    got = Q.quality(docs, labels).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got}
    assert score[903] > 0.9 and score[904] < 0.1 and score[None] > 0.9 and score[905] > 0.5
    assert score[900] == score[901] == score[902] and 0.5 < score[900] < 0.8
    none = labels.where("false")
    assert [r.score for r in Q.quality(make_docs([(1, "abc"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert Q.quality(make_docs([]), none).count() == 0
