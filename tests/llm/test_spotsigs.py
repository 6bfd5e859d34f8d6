import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from strollgraph.llm import spotsigs as S
from strollgraph.llm.queries import QUERIES


def brute(text):
    """Signatures as (anchor=word, next content words), or words, or the text."""
    words = [w for w in re.sub(r"[\W_]+", " ", (text or "").lower()).split(" ") if w]
    content = [i for i, w in enumerate(words) if w not in S.ANCHORS]
    chains = set()
    for k, i in enumerate(content):
        if i and words[i - 1] in S.ANCHORS:
            chains.add((f"{words[i - 1]}={words[i]}", *[words[j] for j in content[k + 1 : k + S.CHAIN]]))
    return chains or {words[i] for i in content} or {text or ""}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def expected(rows):
    """(doc_id, n_chars, sha, near_edited, near_next) in the order of ids, for distinct ids."""
    out, order = {}, sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + nxt[:n]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(brute(t), brute(edited)), jaccard(brute(t), brute(nxt)))
    return out


def check(got, rows):
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        n, sha, edited, nxt = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert abs(r.near_edited - (edited if edited >= S.LEAST else r.near_edited)) < 1e-9
        assert abs(r.near_next - nxt) < 1e-9 or nxt < S.LEAST


def test_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_spot_signatures"](spark, small).collect()
    check(got, rows)
    same = {}
    for (d, t), r in zip(sorted(rows), sorted(got)):
        assert same.setdefault(t, r.fingerprint) == r.fingerprint


def write(spark, rows, make_docs, tmp_path):
    make_docs(rows).selectExpr("*", "1 as _for", "'x' as signatures", "2 as head").write.parquet(f"{tmp_path}/documents.parquet")
    return QUERIES["op5_spot_signatures"](spark, str(tmp_path)).collect()


def test_edge_cases(spark, make_docs, tmp_path):
    rnd = random.Random(1)
    prose = lambda n: " ".join(rnd.choice("the House of stone, and é日 river a Mann der hill".split()) for _ in range(n))
    rows = [(3, None), (5, ""), (-7, "x"), (10**12, prose(50)), (8, prose(40)), (9, prose(8000)), (11, "plain words only"), (12, "?? !!"), (2, "the of and")]
    check(write(spark, rows, make_docs, tmp_path), rows)


def test_repeated_and_missing_ids(spark, make_docs, tmp_path):
    rows = [(1, "the house stands"), (2, "a river runs past the mill"), (2, "a river runs past the mill"), (None, "the hill of stone ends here")]
    got = write(spark, rows, make_docs, tmp_path)
    assert len(got) == 4
    two = [r for r in got if r.doc_id == 2]
    assert two[0] == two[1] and two[0].edited_sha256 == expected([(1, rows[0][1]), (2, rows[1][1])])[2][1]
    lone = next(r for r in got if r.doc_id is None)
    assert lone.edited_sha256 == expected([(2, rows[1][1]), (3, rows[3][1])])[3][1]


def test_single_and_no_document(spark, make_docs, tmp_path):
    got = write(spark, [(4, "the house of stone stands here")], make_docs, tmp_path / "one")
    check(got, [(4, "the house of stone stands here")])
    assert write(spark, [], make_docs, tmp_path / "none") == []
    assert len(write(spark, [(None, "the end")], make_docs, tmp_path / "null")) == 1


def test_likeness_is_pruned_by_length(spark):
    one = spark.createDataFrame([(list(range(100)), list(range(4)))], "a array<int>, b array<int>")
    assert one.select(S.likeness(F.col("a"), F.col("b"))).first()[0] == 0.0
    assert one.select(S.likeness(F.col("a"), F.slice("a", 1, 50))).first()[0] == 0.5
