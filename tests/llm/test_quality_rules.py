import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strollgraph.llm import quality_rules as Q
from strollgraph.llm.textstats import counts, repeated_words


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_counts_equal_brute_force():
    rnd = random.Random(1)
    alphabet = ["a", "b", "é", " ", "\x1c", "#", "日", " ", " ", "\n", "\t", "\x0b", "\x85", " "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))) for _ in range(200)]
    texts += ["", " \n ", "one", "x y " * 50, "a b c d e f g h " * 2, "a b c d e f g h", "a a a a a a a a a", "l\nl\n \n \nl "]
    for t in texts:
        assert counts(t.encode())[:5] == base(t)


def test_overlapping_windows_count_once():
    assert repeated_words(np.zeros(9, dtype=int)) == 9
    assert repeated_words(np.zeros(8, dtype=int)) == 0
    assert repeated_words(np.array([*range(8), 99, *range(8)])) == 16


@pytest.fixture(scope="module")
def sample(make_docs):
    rnd = random.Random(2)
    common = ["the", "house", "Stone", "river", "of", "light,", "mountain", "and", "people.", "walked"]
    rows = []
    for i in range(1500):
        words = [rnd.choice(common) for _ in range(rnd.randrange(30, 200))]
        if i % 10 == 0:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), "en" if i % 50 else "xx", "hot" if i % 3 else f"s{i % 7}"))
    return rows + [(2000, None, "en", "hot"), (2001, "", None, None), (2002, "short", "en", "hot"), (None, "the " * 60, None, None), (2003, "word " * 9000, "en", "hot")]


def test_outliers_go_and_clean_rows_stay(make_docs, sample):
    got = {r.doc_id: r for r in Q.quality_rules(make_docs(sample)).collect()}
    assert len(got) == len(sample)
    for d, t, _, _ in sample:
        b = base(t) if t is None or len(t) < 5000 else None
        if b:
            assert tuple(got[d][c] for c in Q.COUNTS[:5]) == b
            assert got[d].base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        if d is not None and d < 2000:
            assert got[d].kept == (d % 10 != 0)
    assert not any(got[d].kept for d in (2000, 2001, 2002, 2003, None))


def test_kept_rows_keep_columns(make_docs, sample):
    docs = make_docs(sample).selectExpr("*", "1 as _k0", "'q' as kept", "2.0 as distance", "3 as n_words")
    kept = Q.kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(1500) if i % 10]


def test_empty_table(make_docs):
    assert Q.quality_rules(make_docs([])).count() == 0
    assert Q.kept_rows(make_docs([(1, "few words")])).count() == 0


def test_estimate_is_near_the_core(spark):
    rng = np.random.default_rng(0)
    clean = rng.multivariate_normal([1, 2, 3, 4], np.diag([1, 0.25, 4, 1]) + 0.2, 3000)
    bad = rng.multivariate_normal([30, 2, -20, 4], np.eye(4) * 0.1, 700)
    rows = spark.createDataFrame([("g", *map(float, x)) for x in np.vstack([clean, bad])], "_group string, x0 double, x1 double, x2 double, x3 double")
    est = Q.robust_estimates(rows).first()
    assert np.allclose(est["mean"], [1, 2, 3, 4], atol=0.2)
    core = np.linalg.inv(np.array(est["inverse"]).reshape(4, 4))
    true = np.cov(clean.T)
    assert np.all(np.diag(core) < 1.5 * np.diag(true)) and np.all(np.diag(core) > 0.3 * np.diag(true))


def test_chi_square_points():
    assert Q.chi2_point(0.05, 4) == pytest.approx(9.4877, abs=1e-3)
    assert Q.chi2_point(0.25, 4) == pytest.approx(5.3853, abs=1e-3)


def test_small_groups_are_drawn_towards_wider_ones(spark):
    """Half towards the language at STEADY rows, by the same rule towards all rows; every step against plain numpy."""
    rng = np.random.default_rng(4)
    sizes = {("en", "a"): 200, ("en", "b"): 3, ("de", "a"): 50, (None, None): 1}
    rows = [(*g, *map(float, rng.normal(i, 1, 4)), 100, 0) for i, (g, n) in enumerate(sizes.items()) for _ in range(n)] + [("en", "unused", *[0.0] * 4, 5, 0)]
    names = [f"x{i}" for i in range(4)]
    table = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} double" for c in names) + ", n_words long, n_repeat_words long")
    estimates = Q.robust_estimates(Q._fit_rows(table))
    own = {r["_group"]: (np.array(r["mean"]), np.array(r["cov"]).reshape(4, 4), r["n"]) for r in estimates.collect()}
    assert {k: v[2] for k, v in own.items()} == {
        '["en","a"]': 200, '["en","b"]': 3, '["de","a"]': 50, "[null,null]": 1, '["en"]': 203, '["de"]': 50, "[null]": 1, "[]": 254
    }
    got = {(r["_l"], r["_s"]): (np.array(r["mean"]), np.linalg.inv(np.array(r["inverse"]).reshape(4, 4))) for r in Q._by_source(table, estimates).collect()}
    assert set(got) == {*sizes, ("en", "unused")}
    text = lambda *x: json.dumps(x, separators=(",", ":"))
    for (lang, source), (mean, cov) in got.items():
        want_mean, want_cov, _ = own["[]"]
        for level in (text(lang), text(lang, source)):
            m, c, n = own.get(level, (want_mean, want_cov, 0))
            want_mean, want_cov = (n * m + Q.STEADY * want_mean) / (n + Q.STEADY), (n * c + Q.STEADY * want_cov) / (n + Q.STEADY)
        assert np.allclose(mean, want_mean) and np.allclose(cov, want_cov)
