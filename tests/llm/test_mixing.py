from collections import defaultdict
import hashlib
import re

import pytest

from strollgraph.llm import mixing


def brute(rows, weights=(5, 2, 1), share=1.5, most=2):
    """(doc_id, taken) pairs and targets, by sorting every source."""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), t) for d, t, _, s in rows]
    total = defaultdict(int)
    for _, s, n, _ in sized:
        total[s] += n
    order = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        level = (share * sum(total.values()) - sum(most * total[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if level * weight[s] > most * total[s]}
        if not more:
            break
        capped |= more
    target = {s: most * total[s] if s in capped else level * weight[s] for s in order}
    taken = []
    for s in order:
        want = int(target[s])
        epochs = want // total[s] if total[s] else 0
        left = want - epochs * total[s]
        key = lambda d, t: hashlib.md5(f"{chr(0) if d is None else d}|{chr(0) if t is None else t}".encode()).hexdigest()
        for d, _, n, t in sorted((x for x in sized if x[1] == s), key=lambda x: key(x[0], x[3])):
            got = min(n, left)
            left -= got
            taken.append((d, epochs * n + got))
    return sorted(taken, key=str), target


def rows():
    out = [(i, "w " * (i * 7 % 40), "en", f"s{i % 3}" if i % 5 else "hot") for i in range(300)]
    out += [(300, None, None, None), (301, "", "en", None), (302, "one two", None, None), (303, "a b c", "en", "é"), (303, "a b c", "en", "é")]
    return out + [(None, "x y", None, "z"), (None, None, None, "z")]


def test_mix_equals_brute_force(make_docs, monkeypatch):
    expected, target = brute(rows())
    for per_range in (2000, 3):  # without and with key ranges
        monkeypatch.setattr(mixing, "RANGE_ROWS", per_range)
        got = mixing.mix(make_docs(rows())).collect()
        assert sorted(((r.doc_id, r.taken) for r in got), key=str) == expected
        for r in got:
            assert r.target == pytest.approx(target[r.source])
            assert 0 <= r.taken <= 2 * r.size
    by = defaultdict(int)
    for r in got:
        by[r.source] += r.taken
    assert all(abs(by[s] - target[s]) < 1 for s in by)


def test_mix_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_rows_of_the_mix(make_docs, spark):
    docs = make_docs(rows()).selectExpr("*", "'x' as size", "1 as taken", "'k' as key")
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in mixed.where("doc_id < 300").groupBy("doc_id").count().collect()}
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(make_docs(rows())).collect() if r.doc_id is not None and r.doc_id < 300}
    for d, (got, size) in taken.items():
        assert copies.get(d, 0) == (1 if size == 0 else -(-got // size))
