"""Quality by nearest-neighbour voting on latent-semantic vectors.

A text's features are hashed counts of its byte trigrams, weighted by TF-IDF, and the shares of words by the distance to their last
occurrence, which shows stutters and loops; the leading singular directions of a labelled sample make them latent-semantic
vectors.  The labelled vectors (at most ``SAMPLE``) are broadcast; cosine products are exact and
computed in blocks for every document, and the nearest labels vote with a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strollgraph.llm.labelled import sample
from strollgraph.llm.text import arrow_rows

#: Labelled documents that are learned from, at most.
SAMPLE = 8192
TRIGRAMS = 2048
#: Words by distance to their last occurrence: doubling classes, and new words in the last.
GAPS = 16
FEATURES = TRIGRAMS + GAPS
RANK = 48
NEIGHBOURS = 32
#: Power of the cosine that weighs a vote.
SHARPNESS = 8
#: Bytes and documents handled at once.
CHUNK_BYTES = 1_000_000
CHUNK_DOCS = 512


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and (size + len(t) > CHUNK_BYTES or i - at >= CHUNK_DOCS):
            yield at, i
            at = i
            size = 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def word_gaps(text: bytes) -> np.ndarray:
    """Words by the binary logarithm of the distance to their last occurrence; new words in the last class."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in text.split()], dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    again = ids[order[1:]] == ids[order[:-1]]
    gap = np.log2((order[1:] - order[:-1])[again]).astype(np.int64)
    out = np.bincount(np.minimum(gap, GAPS - 2), minlength=GAPS)
    out[-1] = len(number)
    return out


def features(texts: list[bytes]) -> np.ndarray:
    """One row of trigram and gap counts per text; a long text is counted in pieces that overlap."""
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i, TRIGRAMS:] = word_gaps(text)
    for low, high in _chunks(texts):
        lengths = np.array([len(t) for t in texts[low:high]])
        data = np.frombuffer(b"".join(texts[low:high]), dtype=np.uint8)
        row = np.repeat(np.arange(high - low), lengths)
        for at in range(0, max(0, len(data) - 2), CHUNK_BYTES):
            piece, own = data[at : at + CHUNK_BYTES + 2].astype(np.uint32), row[at : at + CHUNK_BYTES + 2]
            h = piece[:-2] * np.uint32(0x9E3779B1) ^ piece[1:-1] * np.uint32(0x85EBCA77) ^ piece[2:] * np.uint32(0xC2B2AE3D)
            bucket = ((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(21)).astype(np.int64)
            inside = own[:-2] == own[2:]
            cell = (own[:-2] * TRIGRAMS + bucket)[inside]
            out[low:high, :TRIGRAMS] += np.bincount(cell, minlength=(high - low) * TRIGRAMS).reshape(-1, TRIGRAMS)
    return out


def _scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of the weighted trigrams and of the gaps, side by side."""
    weighted = np.log1p(counts[:, :TRIGRAMS]) * idf
    gaps = np.sqrt(counts[:, TRIGRAMS:])
    unit = lambda x: x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))
    return np.hstack([unit(weighted), unit(gaps)])


def _projected(counts: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    z = _scaled(counts, idf) @ basis
    return z / np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        for low in range(0, len(texts), CHUNK_DOCS):
            rows = features(texts[low : low + CHUNK_DOCS])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label")[low : low + CHUNK_DOCS], pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "features"]
            )


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Model of at most ``SAMPLE`` rows of counts."""
    df = (counts[:, :TRIGRAMS] > 0).sum(axis=0)
    idf = np.log((1 + len(counts)) / (1 + df)).astype(np.float32) + np.float32(0.1)
    blocks = [slice(at, at + CHUNK_DOCS) for at in range(0, len(counts), CHUNK_DOCS)]
    gram = np.zeros((FEATURES, FEATURES))
    for block in blocks:
        x = _scaled(counts[block], idf)
        gram += x.T @ x
    _, directions = np.linalg.eigh(gram)
    basis = directions[:, ::-1][:, :RANK]
    # Fixed signs make reruns equal.
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1, 1)
    basis = np.ascontiguousarray(basis, dtype=np.float32)
    vectors = np.vstack([_projected(counts[block], idf, basis) for block in blocks])
    return Model(idf, basis, vectors, labels.astype(np.float32))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    known = sample(docs, labels, "quality", SAMPLE).select("label", "text").mapInArrow(_feature_batches, "label int, features binary")
    rows = known.toArrow()
    if not rows.num_rows:
        return None
    counts = np.empty((rows.num_rows, FEATURES), dtype=np.float32)
    for i, features_of in enumerate(b for chunk in rows.column("features").chunks for b in chunk):
        counts[i] = np.frombuffer(features_of.as_buffer(), dtype=np.float32)
    found = np.array(rows.column("label").to_pylist())
    del rows
    return fit(counts, found)


def votes(model: Model, counts: np.ndarray) -> np.ndarray:
    """Share of label 1 among the nearest labels, weighed by cosine; the base rate for texts without a trigram."""
    base = float(model.labels.mean())
    cosines = _projected(counts, model.idf, model.basis) @ model.vectors.T
    k = min(NEIGHBOURS, cosines.shape[1])
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(0, np.take_along_axis(cosines, near, axis=1).astype(np.float64)) ** SHARPNESS
    total = weight.sum(axis=1)
    share = (weight * model.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
    return np.where((total > 1e-9) & (counts[:, :TRIGRAMS].sum(axis=1) > 0), np.clip(share, 0, 1), base)


def score_rows(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (doc_id, text).

    A null text, an empty one and one below three bytes score the base rate of the labels; without any labels every score is 0.5.
    Equal texts score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            scores = np.full(len(texts), 0.5)
            if own is not None:
                for low in range(0, len(texts), CHUNK_DOCS):
                    scores[low : low + CHUNK_DOCS] = votes(own, features(texts[low : low + CHUNK_DOCS]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return arrow_rows(docs).select("doc_id", "text").mapInArrow(batches, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_rows(docs, learn(docs, labels))
