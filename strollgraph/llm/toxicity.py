"""Toxicity by the nearest labelled examples.

Words that tell the labels apart (chi-square) form the space; texts are TF-IDF vectors in it and nearness is the exact cosine.
Equal example vectors are one entry with its label counts.  The index is inverted: every term lists the examples that hold it
in blocks with the largest weight of each block.  A search visits blocks in the order of their upper bounds and stops where
no block can reach the neighbours already found, so it is exact.

Learning reads at most ``SAMPLE`` labelled documents, so model and index are bounded and broadcast; every document is searched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.llm.labelled import sample
from strollgraph.llm.text import arrow_rows

#: Labelled documents that are learned from, at most.
SAMPLE = 20_000
#: Terms of the space, at most; documents a term needs, the chi-square it needs, and that by document (a few copies of
#: one text reach the chi-square in a large sample, but not the share).
TERMS = 4096
LEAST_DOCS = 5
LEAST_CHI2 = 30.0
LEAST_SHARE = 0.016
#: Examples that vote, at least; examples at the last similarity all vote.
NEIGHBOURS = 25
BLOCK = 64
#: Weight of the base rate among the votes, and the distance that halves a vote.
PRIOR_VOTES = 0.5
HALF_DISTANCE = 0.1

_WORD = re.compile(r"[^\W_]+")


def word_counts(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def term_counts(text: str, number: dict[str, int]) -> dict[int, int]:
    """Occurrences of the terms of the space."""
    return {number[w]: n for w, n in word_counts(text).items() if w in number}


@dataclass
class Index:
    """Examples as postings per term, in blocks of ``BLOCK`` examples."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    counts: np.ndarray  # examples with this vector
    toxic: np.ndarray  # and how many are toxic
    ids: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # per term: example numbers, weights
    bounds: list[np.ndarray] = field(default_factory=list)  # per term: largest weight per block
    base: tuple[float, float] = (0.0, 0.0)  # examples without any term: all, toxic

    def weights(self, found: dict[int, int]) -> dict[int, float]:
        w = {t: (1 + math.log(n)) * float(self.idf[t]) for t, n in found.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    def search(self, found: dict[int, int], k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Example entries and cosines of the ``k`` nearest examples and all as near as the last, nearest first."""
        query = self.weights(found)
        upper = sum(q * self.bounds[t] for t, q in query.items())
        order = np.argsort(-upper, kind="stable")
        near: list[tuple[float, int]] = []
        worst, held = 0.0, 0
        for b in order:
            if upper[b] <= 0 or (held >= k and upper[b] < worst - 1e-9):
                break
            low = int(b) * BLOCK
            sums = np.zeros(BLOCK)
            for t, q in query.items():
                at, w = self.postings[t]
                i, j = np.searchsorted(at, (low, low + BLOCK))
                sums[at[i:j] - low] += q * w[i:j]
            near += [(round(float(sums[i]), 9), low + int(i)) for i in np.flatnonzero(sums > max(0.0, worst - 1e-9))]
            near.sort(key=lambda x: (-x[0], x[1]))
            held, worst, last = 0, 0.0, len(near)
            for i, (s, e) in enumerate(near):
                if held >= k and s < worst:
                    last = i
                    break
                held += int(self.counts[e])
                if held >= k:
                    worst = s if worst == 0.0 else worst
            near = near[:last]
        return np.array([e for _, e in near], dtype=np.int64), np.array([s for s, _ in near])

    def score(self, found: dict[int, int]) -> tuple[float, list[dict]]:
        """Smoothed share of toxic votes, and the nearest examples as evidence."""
        prior = (self.toxic.sum() + self.base[1] + 0.5) / (self.counts.sum() + self.base[0] + 1)
        if not found:
            return (float((self.base[1] + PRIOR_VOTES * prior) / (self.base[0] + PRIOR_VOTES)) if self.base[0] else float(prior)), []
        at, cosines = self.search(found)
        votes = HALF_DISTANCE / (HALF_DISTANCE + 1 - np.minimum(1, cosines))
        share = ((votes * self.toxic[at]).sum() + PRIOR_VOTES * prior) / ((votes * self.counts[at]).sum() + PRIOR_VOTES)
        evidence = [
            {"doc_id": int(self.ids[e]), "similarity": float(s), "toxic": float(self.toxic[e] / self.counts[e])}
            for e, s in list(zip(at, cosines))[:3]
        ]
        return float(min(1.0, max(0.0, share))), evidence


def build_index(vocabulary: list[tuple[str, int]], n: int, examples: list[tuple[tuple[int, ...], tuple[int, ...], int, int, int]]) -> Index:
    """Index from (term, documents) and from (term numbers, their counts, examples, toxic ones, least id)."""
    idf = np.array([math.log(1 + n / d) for _, d in vocabulary])
    filled = sorted(e for e in examples if e[0])
    index = Index(
        {t: i for i, (t, _) in enumerate(vocabulary)}, idf,
        np.array([e[2] for e in filled], dtype=float), np.array([e[3] for e in filled], dtype=float), np.array([e[4] for e in filled], dtype=np.int64),
    )
    blocks = -(-len(filled) // BLOCK)
    lists: list[tuple[list[int], list[float]]] = [([], []) for _ in vocabulary]
    for number, e in enumerate(filled):
        for t, w in index.weights(dict(zip(e[0], e[1]))).items():
            lists[t][0].append(number)
            lists[t][1].append(w)
    for at, w in lists:
        at, w = np.array(at, dtype=np.int64), np.array(w)
        bound = np.zeros(blocks)
        np.maximum.at(bound, at // BLOCK, w)
        index.postings.append((at, w))
        index.bounds.append(bound)
    index.base = (float(sum(e[2] for e in examples if not e[0])), float(sum(e[3] for e in examples if not e[0])))
    return index


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: Counter = Counter()
    toxic: Counter = Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            own = word_counts(text).keys()
            docs.update(own)
            if label == 1:
                toxic.update(own)
    names = list(docs)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([docs[t] for t in names], pa.int64()), pa.array([toxic[t] for t in names], pa.int64())],
        names=["term", "n", "n1"],
    )


def learn(docs: DataFrame, labels: DataFrame) -> Index:
    known = sample(docs, labels, "toxic", SAMPLE)
    totals = known.agg(F.count("*").alias("n"), F.sum((F.col("label") == 1).cast("int")).alias("n1")).first()
    n, n1 = totals["n"], totals["n1"] or 0
    counted = known.select("text", "label").mapInArrow(_document_counts, "term string, n bigint, n1 bigint")
    table = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1")).where(F.col("n") >= LEAST_DOCS)
    a, b = F.col("n1"), F.col("n") - F.col("n1")
    c, d = F.lit(n1) - a, F.lit(n - n1) - b
    cross = (a * d - b * c).cast("double")
    spread = F.col("n").cast("double") * (n - F.col("n")) * F.lit(float(n1)) * F.lit(float(n - n1))
    chi2 = F.when(spread > 0, cross * cross * n / spread).otherwise(0.0)
    chosen = table.withColumn("chi2", chi2).where(F.col("chi2") >= max(LEAST_CHI2, LEAST_SHARE * n)).orderBy(F.desc("chi2"), "term").limit(TERMS)
    vocabulary = [(r.term, r.n) for r in chosen.collect()]
    number = {t: i for i, (t, _) in enumerate(vocabulary)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(term_counts(x, number).items()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int32())), pa.array([[c for _, c in f] for f in found], pa.list_(pa.int32())),
                 batch.column("label"), batch.column("doc_id")],
                names=["terms", "counts", "label", "doc_id"],
            )

    entries = (
        known.mapInArrow(vectors, "terms array<int>, counts array<int>, label int, doc_id bigint").groupBy("terms", "counts")
        .agg(F.count("*").alias("n"), F.sum((F.col("label") == 1).cast("int")).alias("n1"), F.min("doc_id").alias("least"))
    )
    return build_index(vocabulary, n, [(tuple(r.terms), tuple(r.counts), r.n, r.n1, r.least) for r in entries.collect()])


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.float64())]))


def score_rows(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, score, evidence`` for every row of ``docs`` (doc_id, text).

    A null, empty or other text without any term of the space scores the toxic share of the examples without one (the base rate
    if there are none); with no labels at all the score is 0.5.  Equal texts score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in parts:
            results = []
            for text in batch.column("text"):
                found = term_counts(text.as_py() or "", own.vocabulary)
                key = tuple(sorted(found.items()))
                if key not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[key] = own.score(dict(key))
                results.append(known[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in results], pa.float64()), pa.array([e for _, e in results], _EVIDENCE)],
                names=["doc_id", "score", "evidence"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, evidence array<struct<doc_id:bigint,similarity:double,toxic:double>>"
    return arrow_rows(docs).select("doc_id", "text").mapInArrow(batches, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_rows(docs, learn(docs, labels))
