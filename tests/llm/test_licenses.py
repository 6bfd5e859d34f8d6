import random
import re

from strollgraph.llm import licenses as L
from strollgraph.llm.queries import ORACLES, QUERIES


def grams(text):
    words = [w for w in re.sub(r"[\W_]+", " ", text.lower()).split(" ") if w]
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def brute(text, templates, threshold=L.THRESHOLD):
    text = text or ""
    out = set()
    for kind, parts in enumerate(([text], re.split(r"\n[\x20\x09-\x0D]*\n", text), text.split("\n"))):
        for i, p in enumerate(parts):
            for t in templates:
                own = grams(p)
                if own and t.bigrams:
                    dice = 2 * len(own & set(t.bigrams)) / (len(own) + len(t.bigrams))
                    if dice >= threshold:
                        out.add((round(dice, 9), kind, i, t.licence))
    return out


def found(docs, templates=None):
    return [(r.doc_id, {(round(m.dice, 9), m.kind, m.number, m.licence) for m in r.matches}) for r in L.scan(docs, templates).collect()]


def test_edited_notices_equal_brute_force(make_docs):
    rnd, templates, rows = random.Random(3), L.load(), []
    notices = [x for texts in L.TEMPLATES.values() for x in texts]
    for i in range(300):
        words = rnd.choice(notices).split()
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = rnd.choice(["thing", "Licence", "-", "the the"])
        text = " ".join(words)
        rows.append((i, rnd.choice([text, f"Some prose here.\n{text}\nmore prose", f"a b c\n \n{text[:40]}\n{text[40:]}\n\nend", text + " and more words after it" * rnd.randrange(3)])))
    got = found(make_docs(rows))
    assert sum(bool(m) for _, m in got) > 100
    assert {d: m for d, m in got} == {d: brute(t, templates) for d, t in rows}


def test_signal_words_lose_nothing():
    for t in L.load():
        words = set(L.signal_words([t]))
        untouched = [b for b in t.bigrams if not set(b.split(" ")) & words]
        low, _ = L.size_bounds(len(t.bigrams))
        assert len(untouched) < low  # a unit without a signal word shares fewer bigrams than the least overlap


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, "MIT"), (4, "released under the mit license"), (4, "released under the mit license"), (None, "Licensed under CC BY-NC 4.0!"),
            (5, "word " * 30000 + "\nLicensed under the Apache License, Version 2.0.\n" + "word " * 30000)]
    docs = make_docs(rows).selectExpr("*", "1 as matches", "'x' as _lower", "2 as best")
    got = found(docs)
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == by[2] == by[3] == set()
    assert {x[3] for x in by[4]} == {"MIT"} and {x[3] for x in by[None]} == {"CC-BY-NC-4.0"}
    assert by[5] == brute(rows[-1][1], L.load()) and (1.0, 2, 1, "Apache-2.0") in by[5]
    assert L.scan(make_docs([])).count() == 0


def test_query_has_its_sql(spark, small):
    import duckdb

    got = sorted(map(tuple, QUERIES["op1_license_scan"](spark, small).collect()), key=str)
    base = duckdb.connect()
    base.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert got == sorted(base.sql(ORACLES["op1_license_scan"]).fetchall(), key=str)
