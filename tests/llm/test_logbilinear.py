import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strollgraph.llm import logbilinear as L
from strollgraph.llm.queries import QUERIES



def base(rows):
    """From (text, trains): tokens, known tokens, training tokens and base score of each."""
    counts = Counter()
    for text, trains in rows:
        if trains:
            counts.update([*L.tokens(text), b""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for text, _ in rows:
        own = [*L.tokens(text), b""]
        out.append((len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)))
    return out


def small_sizes(monkeypatch):
    """A list so short that most words go through the join."""
    monkeypatch.setattr(L, "LISTED", 50)


def test_base_and_counts_equal_brute_force(make_docs, monkeypatch):
    small_sizes(monkeypatch)
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(200)] + ["É", "é", "A", "a", "x" * 300]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(60))) for _ in range(80)]
    texts += [None, "", " \n\t", "never seen", "a a a a", "word\x0bword\x1cword", "Ａ ａ", "long " * 50000, texts[0], texts[0]]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    docs = make_docs(rows).selectExpr("*", "1 as word", "'x' as _key", "2 as n_tokens")
    trains = F.coalesce(F.length("text"), F.lit(0)) % 7 != 2
    got = L.score_texts(docs, trains).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    want = base([(t, len(t or "") % 7 != 2) for t in texts])
    key = lambda r: (str(r[0]), r[1], r[4])
    for g, (d, w) in zip(sorted(map(tuple, got), key=key), sorted(((d, w) for (d, _), w in zip(rows, want)), key=lambda x: key((x[0], *x[1])))):
        assert g[:4] == (d, *w[:3]) and g[4] == pytest.approx(w[3], rel=1e-9)
        assert g[5] < 0 and math.isfinite(g[5])
    twice = [r.score for r in got if r.base_score == got[0].base_score and r.n_tokens == got[0].n_tokens]
    assert len(set(twice)) == 1


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    got = sorted(tuple(r) for r in L.score_texts(docs, F.lit(False)).collect())
    assert [g[:4] for g in got] == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert [g[4] for g in got] == [0.0, 0.0] and got[1][5] == pytest.approx(-math.log10(L.CLASSES), rel=1e-3)
    assert L.score_texts(make_docs([]), F.lit(True)).collect() == []


def fake_lexicon():
    words = [f"w{i}".encode() for i in range(3000)]
    counts = np.array([3000 // (i + 1) + 1 for i in range(3000)])
    classes = np.array([i if i < L.WORDS else L.bin_of(w) for i, w in enumerate(words)])
    tokens_of, words_of = np.bincount(classes, counts, L.CLASSES).astype(np.int64), np.bincount(classes, minlength=L.CLASSES)
    tokens_of[L.END], words_of[L.END] = 100, 1
    return L.Lexicon(int(counts.sum()) + 100, 3001, {w: i for i, w in enumerate(words)}, counts, classes, tokens_of, words_of)


def test_probabilities_sum_to_one():
    rnd = np.random.default_rng(3)
    model = L.Model(*(rnd.normal(0, 0.8, s).astype(np.float32) for s in ((L.CLASSES, L.DIMS), (L.CLASSES, L.DIMS), (L.CLASSES,), (2, L.DIMS))))
    tables = L.tables(model)
    for a, b in ((0, 0), (5, L.END), (L.END, L.END), (L.WORDS + 3, 17)):
        x = np.arange(L.CLASSES)
        logs = tables.of(x, np.full(L.CLASSES, a), np.full(L.CLASSES, b))
        assert (10**logs).sum() == pytest.approx(1, abs=1e-3)
        plain = (model.r[a] * model.c[0] + model.r[b] * model.c[1]) @ model.w.T + model.bias
        assert logs == pytest.approx((plain - np.log(np.exp(plain - plain.max()).sum()) - plain.max()) / math.log(10), abs=1e-3)


def test_shares_of_a_class_sum_to_one():
    known = fake_lexicon()
    for c in (L.WORDS, L.WORDS + 100, L.CLASSES - 2):
        members = known.counts[known.classes == c]
        whole = known.tokens_of[c] + known.words_of[c] + 1
        assert (members + 1).sum() / whole + 1 / whole == pytest.approx(1)


def test_training_learns_what_follows():
    known = fake_lexicon()
    rnd = np.random.default_rng(1)
    stream = []
    for _ in range(4000):  # word 2 k is followed by 2 k + 1
        k = int(rnd.integers(0, 20))
        stream += [2 * k, 2 * k + 1]
    stream = np.array(stream)
    trainer = L.Trainer(L.start(known), L.noise(known), (1,))
    for _ in range(6):
        trainer.learn(stream)
    score = lambda m: L.tables(m).of(stream, *L.contexts(stream))[1::2].mean()
    assert score(trainer.m) > score(L.start(known)) + 0.5


def test_contexts_stop_at_ends():
    one, two = L.contexts(np.array([3, 4, L.END, 5, 6, 7]))
    assert one.tolist() == [L.END, 3, 4, L.END, 5, 6] and two.tolist() == [L.END, L.END, 3, L.END, L.END, 5]


def test_query_beats_the_base_and_is_repeatable(spark, small):
    rows = QUERIES["op11_log_bilinear"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    want = dict(zip(texts, base([(t, not held) for t, held in ((texts[d], next(r.held_out for r in rows if r.doc_id == d)) for d in texts)])))
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = QUERIES["op11_log_bilinear"](spark, small).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in rows)
