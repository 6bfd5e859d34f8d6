import itertools
import random
import unicodedata

import numpy as np

from strollgraph.llm import langid as L
from strollgraph.llm.queries import QUERIES


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(5)
    counts = np.array([3, 0, 6, 1, 5])
    scores = rng.normal(size=(counts.sum(), 3)) * 2
    got, at = L.viterbi(scores, counts, penalty=1.5), 0
    for n in counts:
        own = scores[at : at + n]
        value = lambda path: sum(own[i][s] for i, s in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
        if n:
            best = max(itertools.product(range(3), repeat=int(n)), key=value)
            assert np.isclose(value(tuple(got[at : at + n])), value(best))
        at += n


def test_query_on_held_out_documents(spark, small):
    got = QUERIES["op8_language_spans"](spark, small).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(langs)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def corpus():
    rnd = random.Random(0)
    kinds = {"en": "the house and people walking with thing other", "de": "der schöne und ich nicht auch über zwischen", "ru": "это дом который люди видят сегодня снова"}
    rows = []
    for i in range(90):
        lang = list(kinds)[i % 3]
        rows.append((i, " ".join(rnd.choice(kinds[lang].split()) for _ in range(30)), lang, "s"))
    return rows


def test_spans_of_mixed_text(make_docs):
    english, german, russian = "the people walking with other thing", "zwischen auch über nicht schöne", "люди видят дом"
    text = f"{english}. {german} {russian}!"
    rows = corpus() + [(1000, text, None, None), (1001, "12 34 --", "en", "s"), (1002, None, "en", "s"), (1003, "", "de", "s"), (1004, "日本語の文", None, None),
                       (None, english, None, None), (1005, "the house " * 20000, None, None), (1000, text, None, None)]
    docs = make_docs(rows).selectExpr("*", "1 as _text", "'x' as _row", "2 as score")
    got = {(r.doc_id, r.text): r._language for r in L.identify(docs).collect()}
    mixed = got[(1000, text)]
    assert [s.lang for s in mixed.spans] == ["en", "de", "ru"]
    assert text[mixed.spans[1].start : mixed.spans[1].end] == german
    assert text[mixed.spans[2].start : mixed.spans[2].end] == russian
    for d in (1001, 1002, 1003):
        assert next(v for (k, _), v in got.items() if k == d).lang == "und"
    assert next(v for (k, _), v in got.items() if k == 1004).lang in ("en", "de", "ru")
    assert got[(None, english)].lang == "en" and got[(1005, "the house " * 20000)].lang == "en"
    assert L.identify(docs).count() == len(rows)
    kept = L.kept_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


def test_nothing_to_learn_from(make_docs):
    assert L.identify(make_docs([])).count() == 0
    only = L.identify(make_docs([(2, "text", None, None)])).first()
    assert (only._language.lang, only._language.score) == ("und", 0.0)


def test_letters_of_every_plane_count(make_docs):
    """Only a text without any letter is undetermined."""
    learned = [(i, w, lang) for i, (w, lang) in enumerate([("hello there friend", "en"), ("\u4f60\u597d\u4e16\u754c", "zh")] * 20)]
    odd = [(900 + k, chr(cp) * 3) for k, cp in enumerate((0x323AF, 0x32000, 0x31350, 0x10400, 0x1E900, 0xFB01, 0x20000)) if unicodedata.category(chr(cp))[0] == "L"]
    odd += [(990, "123 !?"), (991, "\u0301\u0302"), (992, None)]
    got = {r.doc_id: r._found.lang for r in L.identify(make_docs(learned + odd).select("doc_id", "text", "lang"), out="_found").collect()}
    assert len(odd) > 7 and all((got[d] == "und") == (d >= 990) for d, _ in odd)
