"""Language identification with spans for mixed text.

Script ranges of the code points narrow the candidates of a word; the word's score per language is the sum of logarithms of learned
letter trigrams; Viterbi over the words with a penalty for every switch labels spans; the language with most letters
names the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.llm.text import arrow_rows, fold, whole_row
from strollgraph.session import cut

#: First code points of script blocks (fixed values of Unicode), up to the next entry.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Odia"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"),
    (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF00, "Latin"), (0x10000, "Other"),
    (0x20000, "Han"), (0x323B0, "Other"),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))
BUCKETS = 1 << 15
#: Share of a language's letters in a script from which it is a candidate there.
SCRIPT_SHARE = 0.005
SWITCH_PENALTY = 12.0
#: Characters handled at once.
CHUNK = 800_000
UNDETERMINED = "und"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case if it belongs to a word (letters and their marks), else a space; and whether it is a letter."""
    lower = np.full(0x110000, 32, dtype=np.uint32)
    letter = np.zeros(0x110000, dtype=bool)
    for cp in (*range(0xD800), *range(0xE000, 0x110000)):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            small = chr(cp).lower()
            lower[cp] = ord(small) if len(small) == 1 else cp
            letter[cp] = kind == "L"
    return lower, letter


def _scripts(cps: np.ndarray) -> np.ndarray:
    starts = np.array([s for s, _ in SCRIPTS])
    number = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])
    return number[np.searchsorted(starts, cps, side="right") - 1]


def _trigrams(norm: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams around the positions ``at``; words end in spaces."""
    h = norm[at - 1] * np.uint32(0x9E3779B1) ^ norm[at] * np.uint32(0x85EBCA77) ^ norm[at + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(17)).astype(np.int64)


def _chunks(texts: list[str | None]) -> Iterator[list[int]]:
    """Row numbers in lots of similar length, so that few steps run over long texts alone."""
    lot, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i] or "")):
        lot.append(i)
        size += len(texts[i] or "")
        if size >= CHUNK:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


class Words:
    """The words of several texts as arrays."""

    def __init__(self, texts: list[str | None]):
        lower, letter = _tables()
        joined = "\n" + "\n".join(t or "" for t in texts) + "\n"
        self.cps = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        norm = lower[self.cps]
        inside = norm != 32
        self.offsets = np.concatenate(([1], 1 + np.cumsum([len(t or "") + 1 for t in texts])))
        self.letters = np.flatnonzero(inside)
        first = inside[self.letters] & ~inside[self.letters - 1]
        self.first = np.flatnonzero(first)  # of each word, among the letters
        self.starts = self.letters[self.first]
        self.lengths = np.diff(np.append(self.first, len(self.letters)))
        self.buckets = _trigrams(norm, self.letters)
        self.scripts = _scripts(self.cps[self.letters])
        self.text_of = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text_of, minlength=len(texts)) if len(self.starts) else np.zeros(len(texts), np.int64)
        real = np.flatnonzero(letter[self.cps])
        found = np.searchsorted(self.offsets, real, side="right") - 1
        self.has_letter = np.bincount(found, minlength=len(texts)) > 0


@dataclass
class Model:
    """``scores[bucket, language]`` and ``candidates[script, language]``; its size is languages times buckets."""

    langs: list[str]
    scores: np.ndarray
    candidates: np.ndarray


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts per language of one partition; scripts follow the trigrams."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in set(langs):
            own = [t for l, t in zip(langs, texts) if l == lang]
            sums = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), dtype=np.int64))
            for lot in _chunks(own):
                words = Words([own[i] for i in lot])
                sums[:BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                sums[BUCKETS:] += np.bincount(words.scripts, minlength=len(SCRIPT_NAMES))
    for lang, sums in totals.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def learn(docs: DataFrame) -> Model:
    """Model of the languages in ``docs`` (text, lang): every row counts whose fold of three is not 1 and whose language
    is known.  The counts are at most 32,768 numbers per language."""
    rows = arrow_rows(docs).where((fold("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    summed = (
        rows.mapInArrow(_count_batches, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    found = summed.toPandas()
    langs = sorted(found["lang"].unique())
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    table[found["bucket"].to_numpy(dtype=int), [langs.index(l) for l in found["lang"]]] = found["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    shares = scripts / np.maximum(1, scripts.sum(axis=0))
    return Model(langs, scores.astype(np.float32), shares >= SCRIPT_SHARE)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Score of every word in every language; languages that don't write its script are out unless none does."""
    if not len(words.first):
        return np.zeros((0, len(model.langs)), dtype=np.float32)
    sums = np.add.reduceat(model.scores[words.buckets], words.first, axis=0)
    allowed = model.candidates[words.scripts[words.first]]
    allowed = allowed | ~allowed.any(axis=1, keepdims=True)
    return np.where(allowed, sums, sums.min(axis=1, keepdims=True) - 1000.0)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best language of every word, for texts that follow each other with ``counts`` words: all texts advance together.

    Ties prefer staying, then the first language.
    """
    out = np.zeros(len(scores), dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    counts = counts[order]
    n_active = int((counts > 0).sum())
    if not n_active:
        return out
    moved = np.zeros(scores.shape, dtype=bool)  # whether the best way into a word's state is a switch
    source = np.zeros(len(scores), dtype=np.int64)  # and from which language
    best = scores[starts[:n_active]].astype(np.float64)
    final = best.copy()
    active = np.searchsorted(-counts, -np.arange(1, counts[0] + 1), side="right")  # texts with that many words
    for step in range(1, int(counts[0])):
        a = active[step]
        best = best[:a]
        at = starts[:a] + step
        top = best.argmax(axis=1)
        value = best[np.arange(a), top] - penalty
        switch = value[:, None] > best
        moved[at], source[at] = switch, top
        best = np.where(switch, value[:, None], best) + scores[at]
        final[:a] = best
    state = final.argmax(axis=1)
    for step in range(int(counts[0]) - 1, -1, -1):
        a = active[step]
        at = starts[:a] + step
        out[at] = state[:a]
        if step:
            hop = moved[at, state[:a]]
            state[:a] = np.where(hop, source[at], state[:a])
    return out


def label(texts: list[str | None], model: Model) -> Iterator[tuple[int, str, float, list[dict]]]:
    """Row number, language, share of its letters and spans of every text."""
    for lot in _chunks(texts):
        words = Words([texts[i] for i in lot])
        langs = viterbi(word_scores(words, model), words.counts) if model.langs else np.zeros(len(words.first), np.int64)
        n = max(1, len(model.langs))
        letters = np.zeros((len(lot), n), dtype=np.int64)
        np.add.at(letters, (words.text_of, langs), words.lengths)
        top = letters.argmax(axis=1)
        new = np.flatnonzero(np.r_[True, (langs[1:] != langs[:-1]) | (words.text_of[1:] != words.text_of[:-1])]) if len(langs) else []
        spans: dict[int, list[dict]] = {}
        for k, at in enumerate(new):
            end = (new[k + 1] if k + 1 < len(new) else len(langs)) - 1
            row = int(words.text_of[at])
            spans.setdefault(row, []).append({
                "start": int(words.starts[at] - words.offsets[row]),
                "end": int(words.starts[end] + words.lengths[end] - words.offsets[row]),
                "lang": model.langs[langs[at]] if model.langs else UNDETERMINED,
            })
        for k, i in enumerate(lot):
            if words.has_letter[k] and model.langs:
                yield i, model.langs[top[k]], float(letters[k, top[k]] / letters[k].sum()), spans.get(k, [])
            else:
                yield i, UNDETERMINED, 0.0, []


_RESULT = pa.struct([
    ("lang", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))),
])


def _found(docs: DataFrame, model: Model | None) -> DataFrame:
    """``_row``, a struct of all columns of ``docs``, and ``_found``, the struct of its language."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found: list = [None] * batch.num_rows
            for i, lang, score, spans in label(batch.column("_row").field("text").to_pylist(), shared.value):
                found[i] = {"lang": lang, "score": score, "spans": spans}
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, _RESULT)], names=["_row", "_found"])

    picked = arrow_rows(docs).select(whole_row(docs).alias("_row"))
    spans = "array<struct<start:bigint,end:bigint,lang:string>>"
    return picked.mapInArrow(batches, f"_row {picked.schema['_row'].dataType.simpleString()}, _found struct<lang:string,score:double,spans:{spans}>")


def identify(docs: DataFrame, model: Model | None = None, out: str = "_language") -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang) and a struct ``out`` of ``lang``, ``score`` and ``spans``.

    ``score`` is the share of the text's letters in spans of its language.  A null text and one without a letter are
    ``und`` with score 0, as is everything if no language can be learned.  Words of a script that no learned language uses keep
    all languages as candidates.  Ties go to the first language in code point order; repeated rows are labelled alike.
    """
    return _found(docs, model).select("_row.*", F.col("_found").alias(out))


def kept_rows(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is determined and holds at least the share ``least`` of the letters."""
    kept = (F.col("_found.lang") != UNDETERMINED) & (F.col("_found.score") >= least)
    return _found(docs, None).where(kept).select("_row.*")
