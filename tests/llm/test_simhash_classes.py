import random

from strollgraph.llm import simhash

import corpus_pipeline


def test_simhash_classes_form_groups_in_the_pipeline(spark, make_docs):
    """Texts of equal fingerprints whose sets of shingles differ are one class of SimHash, so one of them stays; similar pairs beyond its radius still go."""
    rnd = random.Random(3)
    line = "the same short line of this page is repeated over and over again "
    tail = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(12))
    rows = [(k, line * 300 + tail()) for k in range(3)]
    base = [f"v{rnd.randrange(3000)}" for _ in range(204)]
    edited = list(base)
    for i in (20, 90, 150):
        edited[i] = f"new{i}"
    rows += [(10, " ".join(base)), (11, " ".join(edited)), (12, tail() + " " + tail()), (None, line * 300 + tail())]
    docs = make_docs(rows)
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert [classes[k] for k in (0, 1, 2, 10, 11)] == [0, 0, 0, 10, 11]
    assert {r.doc_id for r in simhash.first_of_groups(docs).collect()} == {0, 1, 2, 10, 12, None}
    assert {r.doc_id for r in corpus_pipeline.remove_near_duplicates(spark, docs, "").collect()} == {0, 10, 12}


def test_classes_without_ids(spark, make_docs):
    rnd = random.Random(5)
    text = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60))
    docs = make_docs([(None, text()), (None, text()), (7, text())])
    assert corpus_pipeline.remove_near_duplicates(spark, docs, "").count() == 3
