import random

import pytest

import corpus_pipeline as C
from strollgraph.llm import mixing, pieces, quality_rules
from strollgraph.session import cut


@pytest.fixture(scope="module")
def staged(spark, small):
    """The documents before and after every stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(cut(stage(spark, out[-1], small)))
    return out


def test_stages_take_effect(staged):
    before, language, rules, single, mixed, encoded = staged
    assert [n for n, _ in C.STAGES] == ["language identification", "quality rules", "near duplicates", "source mix", "pieces"]
    for docs in (language, rules, single, mixed):
        assert docs.columns == before.columns
    judged = quality_rules.quality_rules(language)
    assert sorted(r.doc_id for r in rules.collect()) == sorted(r.doc_id for r in judged.where("kept").collect())
    assert 0 < single.count() < rules.count() <= language.count() <= before.count()
    assert single.select("doc_id").subtract(rules.select("doc_id")).count() == 0
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(single).collect()}
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {d: -(-t // s) for d, (s, t) in taken.items() if t > 0}
    assert encoded.count() == mixed.count()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.text == texts[r.doc_id] for r in pieces.decode_rows(encoded).select("doc_id", "text").collect())


def test_run_equals_its_stages(spark, small, staged):
    rows = lambda df: sorted(map(str, df.select("doc_id", "n_pieces", "score").collect()))
    assert rows(C.run(spark, small)) == rows(staged[-1])


def test_odd_documents(spark, make_docs, small):
    rnd = random.Random(0)
    text = lambda: " ".join(rnd.choice("the house and people walking with other thing river stone mill".split()) for _ in range(60)) + "."
    rows = [(i, text(), "en", f"s{i % 2}") for i in range(40)] + [(50, None, "en", "s0"), (51, "", None, None), (None, text(), None, None), (3, text(), "en", "s1")]
    docs = make_docs(rows).selectExpr("*", "1 as _row", "'q' as kept", "2 as _id", "3 as size", "'k' as key", "4 as _language")
    for name, stage in C.STAGES:
        out = cut(stage(spark, docs, small))
        if name != "pieces":
            assert out.columns == docs.columns
        docs = out
    assert {r.doc_id for r in docs.collect()} <= {r[0] for r in rows} - {50, 51}
    docs = make_docs([])
    for name, stage in C.STAGES:
        docs = cut(stage(spark, docs, small))
        assert docs.count() == 0
