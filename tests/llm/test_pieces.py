import hashlib
import itertools
import random
import time

import numpy as np
import pytest

from strollgraph.llm import pieces as P

S = P.SPACE


@pytest.fixture(scope="module")
def tiny():
    listed = ["a", "b", "c", "ab", "bc", "abc", "ca", S, S + "a", S + "ab", S + S, "é", S + "bca"]
    rnd = random.Random(2)
    named = [(i + 256, p, -float(rnd.randrange(1, 40)) / 4) for i, p in enumerate(listed)]
    return P.vocabulary(named, list(range(256)), 256 + len(listed))


def all_paths(chunk, vocab):
    """Every segmentation of a chunk with its score."""
    arrive = P.lattice(chunk, vocab)

    def upto(end):
        if end == 0:
            yield 0.0, ()
        for start, score, ids in arrive[end]:
            for s, path in upto(start):
                yield s + score, path + ids

    return sorted(upto(len(arrive) - 1), key=lambda x: -x[0])


def words(n):
    rnd = random.Random(n)
    return ["".join(rnd.choice("aabbcécx日") for _ in range(rnd.randrange(1, 8))) for _ in range(n)] + [" ab", "  ab", "   ", S, "\n", " " + "abc" * 2]


def test_a_star_equals_all_paths(tiny):
    for w in words(200):
        every, got = all_paths(w, tiny), P.n_best(P.lattice(w, tiny), 5)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in every[:5]])
        assert len(set(got)) == len(got)


@pytest.mark.parametrize("long", [P.LONG_CHUNK, 0])
def test_chunk_scores_equal_all_paths(tiny, monkeypatch, long):
    monkeypatch.setattr(P, "LONG_CHUNK", long)
    for w, (ids, score, gap) in zip(words(200), P.score_chunks(words(200), tiny)):
        every = all_paths(w, tiny)
        best = {path for s, path in every if s > every[0][0] - 1e-9}
        assert score == pytest.approx(every[0][0]) and tuple(np.frombuffer(ids, np.int32).tolist()) in best
        assert gap == (pytest.approx(every[0][0] - every[1][0]) if len(every) > 1 else np.inf)


def test_text_n_best_equals_all_paths(tiny):
    rnd = random.Random(9)
    for _ in range(60):
        text = "".join(rnd.choice("abc é \n") for _ in range(rnd.randrange(0, 9)))
        own = P.chunks(text)
        assert "".join(own) == (" " + text if text else "")
        every = sorted((sum(s for s, _ in way) for way in itertools.product(*[all_paths(c, tiny) for c in own])), reverse=True)
        ids, score, found = next(P.Encoder(tiny, 4).encode([text]))
        assert [f["score"] for f in found] == pytest.approx(every[:4])
        assert score == pytest.approx(every[0]) and found[0]["edits"] == []
        for f in found:
            paths = {e["chunk"]: e["ids"] for e in f["edits"]}
            total = sum(dict((p, s) for s, p in all_paths(c, tiny))[tuple(paths[k])] if k in paths else all_paths(c, tiny)[0][0] for k, c in enumerate(own))
            assert total == pytest.approx(f["score"])


TEXTS = [None, "", " ", "a  b\n\n c", "tab\there", f"{S}literal {S}{S}", "日本語 Ελλάδα naïve 🎉", "x" * 300, "word " * 20000, " lead and trail  ", "\r\n\x0b\x1c"]


def test_round_trip(spark, make_docs):
    vocab = P.load()
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[3])]).selectExpr("*", "1 as ids", "2 as n_best", "3 as score")
    encoded = P.encoded_rows(docs, vocab)
    rows = P.decode_rows(encoded, vocab).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.text == ("no id" if r.doc_id is None else TEXTS[r.doc_id] or "")
        assert r.n_pieces == len(r.ids) and r.n_best[0].score == pytest.approx(r.score)
        assert [x.score for x in r.n_best] == sorted([x.score for x in r.n_best], reverse=True)
        assert len(r.n_best) == P.BEST if len(r.text) > 9 else 1 <= len(r.n_best) <= P.BEST
    assert P.encode_rows(make_docs([]), vocab).count() == 0


def test_query_round_trips(spark, small):
    from strollgraph.llm.queries import QUERIES

    got = P.decode_rows(QUERIES["op9_piece_lattice"](spark, small)).select("doc_id", "text").collect()
    want = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_query_decodes_what_it_encodes(spark, small, make_docs, monkeypatch):
    from strollgraph.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op9_piece_lattice"](spark, small).select("doc_id", "decoded_sha256", "lossless").collect()
    assert len(rows) == len(texts) and all(r.lossless for r in rows)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
    odd = P.round_trip_rows(make_docs([(1, None), (2, ""), (None, "é▁\n x"), (2, "a  b ")])).collect()
    assert len(odd) == 4 and all(r.lossless for r in odd)
    whole = P.decode_rows
    monkeypatch.setattr(P, "decode_rows", lambda *a: whole(*a).selectExpr("* except (text)", "rtrim(text) as text"))
    assert sorted(r.lossless for r in P.round_trip_rows(make_docs([(1, "a b"), (2, "a b ")])).collect()) == [False, True]


def test_one_long_chunk(make_docs):
    """A text without any place to cut is linear in its length, and its n best are found all the same."""
    rnd = random.Random(12)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=200_000))
    vocab = P.load()
    began = time.process_time()
    ids, score, found = next(P.Encoder(vocab).encode([text]))
    assert time.process_time() - began < 20
    assert P.decode(P.np.frombuffer(ids, P.np.int32), vocab) == text and len(found) == P.BEST
    short = P.lattice(" " + text[:60], vocab)
    paths = P.n_best(short, 2)
    assert P.best_and_gap(short)[1:] == pytest.approx((paths[0][0], paths[0][0] - paths[1][0]))
