"""Language-model scores by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens fall into classes: the most frequent words have one each, other words share ``BINS`` classes by their last letters, and the end of a text
is a class.  The two tokens before predict the class of the next: q(h) = c1 * r[a] + c2 * r[b], score = q(h) . w[class] + bias.  Within a
class words have their smoothed corpus frequency; one unseen word for each class closes the sum to one.

Training is spread over all training documents.  They are dealt into ``ROUNDS`` parts; in a round every task starts from the shared
parameters, learns from its own documents with numpy (noise words are drawn from the classes' frequencies), and the parameters of the tasks are
averaged by tokens, in whole numbers so that their order does not matter.

The model is bilinear, so the sum over all classes for all pairs of contexts at once is one matrix product exp(A1) exp(A2)', and a token's
normalised log-probability is three entries of tables.  Sizes of model and tables are fixed by parameters.

Counts of all training words are a table.  The ``LISTED`` most frequent are broadcast; what a document holds beside them meets the
table in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.llm.text import arrow_rows
from strollgraph.session import cut

#: Words with a class of their own, classes of other words, dimensions.
WORDS, BINS, DIMS = 1024, 511, 32
#: Words whose counts are broadcast, and their longest in bytes.
LISTED, LISTED_BYTES = 1 << 17, 48
#: Rounds of averaging; tokens of a step, noise words of a step, size of a step.
ROUNDS, STEP, NOISE, RATE = 3, 2048, 64, 0.1
#: Words that a task counts before it hands them on.
HELD = 400_000
#: Parameters are averaged in steps of 2 ** -FINE.
FINE = 20
END = WORDS + BINS
CLASSES = END + 1
LETTERS = 3


def bin_of(word: bytes) -> int:
    return WORDS + zlib.crc32(word[-LETTERS:]) % BINS


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; its end is not among them."""
    return (text or "").encode().lower().split()


# --- counts -----------------------------------------------------------------------------------------


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(tokens(text))
            if len(counts) > HELD:
                yield flush()
                counts = Counter()
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all ``docs`` (text), without the ends."""
    return arrow_rows(docs).select("text").mapInArrow(_count_batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What the counts say: totals, the listed words, and the classes."""

    total: int  # tokens, ends included
    distinct: int
    place: dict[bytes, int]  # of a listed word
    counts: np.ndarray  # of the listed words
    classes: np.ndarray  # of the listed words
    tokens_of: np.ndarray  # of every class
    words_of: np.ndarray  # distinct words of every class

    def stream(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, bytes]]:
        """Tokens of all texts one after the other: classes, listed places (-1 beside the list, -2 for an end), the ends' positions, and unlisted words by position."""
        classes, places, ends, beside, at = [], [], [], {}, 0
        get = self.place.get
        for text in texts:
            words = tokens(text)
            place = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
            own = self.classes[place]
            for i in np.flatnonzero(place < 0).tolist():
                own[i] = bin_of(words[i])
                beside[at + i] = words[i]
            classes += [own, [END]]
            places += [place, [-2]]
            at += len(words) + 1
            ends.append(at - 1)
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return join(classes), join(places), np.array(ends, dtype=np.int64), beside


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before every token and the one before that; before the first is the end of the text before."""
    one = np.concatenate(([END], classes[:-1]))[: len(classes)]
    two = np.concatenate(([END], one[:-1]))[: len(classes)]
    return one, np.where(one == END, END, two)


def lexicon(counted: DataFrame, ends: int) -> Lexicon:
    """From ``word, n`` and the number of training documents."""
    bins = F.lit(WORDS) + F.crc32(F.expr(f"substring(cast(word as binary), greatest(octet_length(word) - {LETTERS - 1}, 1), {LETTERS})")) % BINS
    totals = counted.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    top = (
        counted.where(F.octet_length("word") <= LISTED_BYTES).orderBy(F.desc("n"), "word").limit(LISTED).collect()  # bounded by LISTED
    )
    by_bin = counted.groupBy(bins.cast("int").alias("bin")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()  # at most BINS
    tokens_of, words_of = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
    for r in by_bin:
        tokens_of[r["bin"]], words_of[r["bin"]] = r["n"], r["v"]
    words = [r["word"].encode() for r in top]
    counts, classes = np.array([r["n"] for r in top], dtype=np.int64), np.array([bin_of(w) for w in words] or [0], dtype=np.int64)
    for i, w in enumerate(words[:WORDS]):
        tokens_of[classes[i]] -= counts[i]
        words_of[classes[i]] -= 1
        classes[i], tokens_of[i], words_of[i] = i, counts[i], 1
    tokens_of[END], words_of[END] = ends, min(1, ends)
    return Lexicon(totals["n"] + ends, totals["v"] + min(1, ends), {w: i for i, w in enumerate(words)}, counts, classes, tokens_of, words_of)


# --- the model --------------------------------------------------------------------------------------


@dataclass
class Model:
    r: np.ndarray  # classes as contexts
    w: np.ndarray  # classes as predictions
    bias: np.ndarray
    c: np.ndarray  # 2 x DIMS: how the two places enter

    def flat(self) -> np.ndarray:
        return np.concatenate([self.r.ravel(), self.w.ravel(), self.bias, self.c.ravel()])

    @staticmethod
    def of(flat: np.ndarray) -> Model:
        n = CLASSES * DIMS
        return Model(*(x.astype(np.float32) for x in (
            flat[:n].reshape(CLASSES, DIMS), flat[n : 2 * n].reshape(CLASSES, DIMS), flat[2 * n : 2 * n + CLASSES], flat[2 * n + CLASSES :].reshape(2, DIMS)
        )))


def noise(known: Lexicon) -> np.ndarray:
    """Smoothed frequencies of the classes."""
    return (known.tokens_of + 1) / (known.tokens_of.sum() + CLASSES)


def start(known: Lexicon, seed: int = 7) -> Model:
    """The classes' frequencies as biases, small random contexts."""
    rnd = np.random.default_rng(seed)
    r = rnd.normal(0, 0.3, (CLASSES, DIMS))
    return Model(r.astype(np.float32), np.zeros((CLASSES, DIMS), np.float32), np.log(noise(known)).astype(np.float32), np.ones((2, DIMS), np.float32))


def _scatter(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of equal indices."""
    order = np.argsort(index, kind="stable")
    found = index[order]
    first = np.flatnonzero(np.diff(found, prepend=-1))
    return found[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Noise-contrastive steps with adaptive step sizes on a copy of a model."""

    def __init__(self, model: Model, frequencies: np.ndarray, seed: tuple[int, ...]):
        self.m = Model(model.r.copy(), model.w.copy(), model.bias.copy(), model.c.copy())
        self.rnd = np.random.default_rng(seed)
        self.cumulative = np.cumsum(frequencies)
        self.offset = np.log(NOISE * frequencies).astype(np.float32)  # log(k q)
        self.squares = Model(*(np.full(x.shape, 1e-2, np.float32) for x in (model.r, model.w, model.bias, model.c)))
        self.tokens = 0

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        own, squares = getattr(self.m, name), getattr(self.squares, name)
        squares[at] += gradient * gradient
        own[at] += RATE * gradient / np.sqrt(squares[at])

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, n = self.m, len(target)
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rnd.random(NOISE)), CLASSES - 1)
        r1, r2 = m.r[one], m.r[two]
        q = r1 * m.c[0] + r2 * m.c[1]
        mine, other = m.w[target], m.w[drawn]
        own = np.einsum("ij,ij->i", q, mine) + m.bias[target] - self.offset[target]
        false = q @ other.T + (m.bias - self.offset)[drawn]
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))  # how far a true token is from certainly true
        down = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
        dq = up[:, None] * mine + down @ other
        scale = np.float32(1 / n)
        index, rows = _scatter(np.concatenate([target, drawn]), np.column_stack([
            np.concatenate([up[:, None] * q, down.T @ q]), np.concatenate([up, down.sum(axis=0)])
        ]))
        places, inner = _scatter(np.concatenate([one, two]), np.concatenate([dq * m.c[0], dq * m.c[1]]))
        slope = np.stack([(dq * r1).sum(axis=0), (dq * r2).sum(axis=0)]) * scale
        self._move("w", index, rows[:, :-1] * scale)
        self._move("bias", index, rows[:, -1] * scale)
        self._move("r", places, inner * scale)
        self._move("c", slice(None), slope)
        self.tokens += n

    def learn(self, classes: np.ndarray) -> None:
        one, two = contexts(classes)
        for at in range(0, len(classes), STEP):
            part = slice(at, at + STEP)
            self.step(classes[part], one[part], two[part])


def train(docs: DataFrame, known: Lexicon) -> Model:
    """A model from all ``docs`` (text); each of them is in one round."""
    model, frequencies = start(known), noise(known)
    context = docs.sparkSession.sparkContext
    words = context.broadcast(known)
    dealt = arrow_rows(docs).select("text", F.pmod(F.xxhash64("text"), F.lit(ROUNDS)).alias("_part"))
    for round_no in range(ROUNDS):
        shared = context.broadcast(model)

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(shared.value, frequencies, (round_no, TaskContext.get().partitionId()))
            for batch in batches:
                trainer.learn(words.value.stream(batch.column("text").to_pylist())[0])
            if trainer.tokens:
                fixed = np.rint(trainer.m.flat().astype(np.float64) * (1 << FINE)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens], pa.int64()), pa.array([fixed.tobytes()], pa.binary())], names=["n", "model"])

        found = dealt.where(F.col("_part") == round_no).select("text").mapInArrow(learned, "n bigint, model binary").rdd.map(
            # Whole numbers of any size would overflow 64 bits when weighted by tokens, so tokens count in thousands here.
            lambda row: (1 + row["n"] // 1000, np.frombuffer(row["model"], np.int64) * (1 + row["n"] // 1000))
        )
        n, total = found.treeAggregate((0, np.zeros(1, np.int64)), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        if n:
            model = Model.of(total / n / (1 << FINE))
    return model


@dataclass
class Tables:
    """Log-probabilities (base 10): of a class after two classes as first[a, x] + second[b, x] - total[a, b]."""

    first: np.ndarray
    second: np.ndarray
    total: np.ndarray

    def of(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.first[one, target].astype(np.float64) + self.second[two, target] - self.total[one, two]


def tables(model: Model) -> Tables:
    first = (model.r * model.c[0]) @ model.w.T + model.bias
    second = (model.r * model.c[1]) @ model.w.T
    high1, high2 = first.max(axis=1, keepdims=True), second.max(axis=1, keepdims=True)
    total = np.log(np.exp(first - high1) @ np.exp(second - high2).T) + high1 + high2.T
    return Tables(*(x * np.float32(1 / math.log(10)) for x in (first, second, total)))


# --- scores -----------------------------------------------------------------------------------------

_BESIDE = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))


def _score_batches(shared_words, shared_tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scores = shared_words.value, shared_tables.value
        within = np.log10(known.tokens_of + known.words_of + 1.0)  # what divides a word's count plus one in its class
        within[:WORDS] = within[END] = 0.0
        # A listed word's share of its class; words with a class of their own and the end are the whole of it.
        own = np.log10(known.counts + 1.0)
        share = np.concatenate([np.where(known.classes[: len(own)] < WORDS, 0.0, own), [0.0, 0.0]])  # -1 and -2 index these two
        floor = math.log10(known.total + known.distinct + 1)
        counted = np.concatenate([own, [math.log10(known.tokens_of[END] + 1), 0.0]])
        for batch in batches:
            names = [n for n in batch.schema.names if n != "_text"]
            texts = batch.column("_text").to_pylist()
            classes, places, ends, beside = known.stream(texts)
            one, two = contexts(classes)
            score = scores.of(classes, one, two) - within[classes] + share[places]
            base = counted[places] - floor
            lengths = np.diff(ends, prepend=-1)
            sums = lambda x: np.add.reduceat(x, ends - lengths + 1) if len(ends) else np.zeros(0)
            listed = np.where(places == -2, known.tokens_of[END] > 0, places >= 0).astype(np.int64)
            lists: list[Counter] = [Counter() for _ in texts]
            text_of = np.searchsorted(ends, np.fromiter(beside, np.int64, len(beside)))
            for t, word in zip(text_of.tolist(), beside.values()):
                lists[t][word] += 1
            rest = [[{"word": w.decode(), "n": n} for w, n in c.items()] for c in lists]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(lengths), pa.array(sums(listed)), pa.array(sums(base)), pa.array(sums(score)), pa.array(rest, _BESIDE)],
                names=[*names, "n_tokens", "_known", "_base", "_score", "_beside"],
            )

    return run


def score_texts(docs: DataFrame, training: Column, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs`` (key, text).

    The model learns from the rows where ``training`` holds.  A null or empty text is one token, its end.  Words that training never saw are the
    unseen word of their class, and count nothing in ``n_known``.  Equal texts score alike; repeated rows are all returned; with nothing to learn
    from, classes are equally likely; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    chosen = docs.where(F.coalesce(training, F.lit(False))).select("text")
    counted = cut(word_counts(chosen))
    known = lexicon(counted, chosen.count())
    model = train(chosen, known)
    shared_words, shared_tables = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(tables(model))
    rows = arrow_rows(docs).select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    scored = cut(rows.mapInArrow(
        _score_batches(shared_words, shared_tables),
        f"_key {kind}, _row bigint, n_tokens bigint, _known bigint, _base double, _score double, _beside array<struct<word:string,n:bigint>>",
    ))
    beside = scored.select("_row", F.inline("_beside").alias("word", "times")).join(counted, "word")
    more = beside.groupBy("_row").agg(F.sum("times").alias("_more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_logs"))
    joined = scored.drop("_beside").join(more, "_row", "left")
    logs = F.coalesce("_logs", F.lit(0.0))
    return joined.select(
        F.col("_key").alias(key), "n_tokens", (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"), (F.col("_base") + logs).alias("base_score"), (F.col("_score") + logs).alias("score"),
    )
