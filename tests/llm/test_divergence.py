import random
import re
from collections import Counter, defaultdict

from strollgraph.llm import divergence

TERM = re.compile(divergence.TERM)


def brute(rows, least, ranks):
    """From (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans(divergence.UPPER, divergence.LOWER)
    counts, docs = defaultdict(Counter), Counter()
    for text, lang, source in rows:
        own = Counter(TERM.findall(text.translate(lower)))
        counts[lang, source].update(own)
        docs.update((lang, t) for t in own)
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        sources = [s for x, s in counts if x == lang]

        def p(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 2) // (total + 2 * len(kept)) for t in kept}

        of = {s: p(counts[lang, s]) for s in sources}
        whole = p(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-f(of[s][t], whole[t]), t.encode(), t) for t in kept if counts[lang, s][t] and of[s][t] > whole[t])
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:ranks])]
    return sorted(out)


def test_equals_brute_force(make_docs, monkeypatch):
    rnd = random.Random(4)
    words = [f"{c}{d}" for c in "abcdé" for d in ("alpha", "Beta", "gamma!", "x-y", "ΔΕ", "(o)")]
    rows = []
    for i in range(200):
        text = " ".join(rnd.choice(words) + rnd.choice(["", "", ",", ".", "-z", f"-q{rnd.randrange(40)}"]) for _ in range(rnd.randrange(30)))
        rows.append((i, text, rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", "é", None])))
    # A term that reaches its documents only through several chunks, some in one document.
    rows += [(300 + i, f"rare{i}. (rare{i}) rare-{i} Rare{i % 2}", "xx", "s") for i in range(6)]
    rows += [(400 + i, "rare, rare; RARE! (rare)", "xx", "t") for i in range(3)] + [(401, "rare, rare; RARE! (rare)", "xx", "t")]
    rows += [(500, None, "en", "silent"), (501, "", "only", "one"), (502, "\x00\x1c 　 tail x", "en", "a"), (None, "balpha " * 30000, "en", "a")]
    docs = make_docs(rows).selectExpr("*", "1 as n", "'x' as term", "2 as total")
    for least, ranks, held in ((10, 10, divergence.HELD_CHUNKS), (3, 2, 5)):
        monkeypatch.setattr(divergence, "HELD_CHUNKS", held)  # counts handed on early are the same
        got = sorted(tuple(r) for r in divergence.divergence(docs, least, ranks).collect())
        assert got == brute([r[1:] for r in rows], least, ranks)
        assert any(r[2] == "term" for r in got)


def test_term_between_the_bounds(make_docs):
    """Nine documents whose chunks add up to more than ten are too few; ten documents through ten chunks are enough."""
    nine = [(i, f"word.{'' if i else ' word!'} word{i}x (word)", "en", "a" if i % 2 else "b") for i in range(9)]
    kept = lambda rows: {r.item for r in divergence.divergence(make_docs(rows)).collect() if r.part == "term"}
    assert "word" not in kept(nine)
    ten = [(i, f"word{'.' * i}", "en", "a") for i in range(10)] + [(99, "other", "en", "b")]
    got = divergence.divergence(make_docs(ten)).collect()
    assert sorted(tuple(r) for r in got) == brute([r[1:] for r in ten], 10, 10)


def test_empty_table(make_docs):
    assert divergence.divergence(make_docs([])).collect() == []
    one = divergence.divergence(make_docs([(1, "a b", "en", "s")])).collect()
    assert one == []
    two = divergence.divergence(make_docs([(1, None, None, None), (2, "x", None, "s")])).collect()
    assert sorted(tuple(r) for r in two) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]
