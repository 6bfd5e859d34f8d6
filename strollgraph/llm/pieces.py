"""SentencePiece encoding and decoding with the N best segmentations.

A text is a lattice of the pieces of a public vocabulary.  The forward Viterbi scores (best score from the start to every position)
are the exact remaining cost of a search from the end, so A-star expands nothing but the N best paths.

No piece crosses the place before a space or around a line feed, so the lattice falls apart into chunks (words).
Frequent chunks are remembered, new ones are scored together: forward and backward scores of all chunks of one length
are array steps, and the best path that avoids the best one gives each chunk's gap.  Only the chunks with the smallest gaps of a text can
differ in its N best segmentations; A-star lists their alternatives and a heap combines them.

The vocabulary and its scores are read on the driver from a model file and broadcast (some 32,000 strings); nothing is trained.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, field
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.llm.text import arrow_rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Segmentations listed for every text.
BEST = 4
#: Score of a character outside the vocabulary below the least score of a piece.
UNKNOWN_PENALTY = 10.0
#: Characters above which a chunk is scored alone, chunks remembered, characters handled at once.
LONG_CHUNK = 40
REMEMBERED = 250_000
CHUNK_CHARS = 2_000_000

_CHUNK = re.compile(f" *[^ \n{SPACE}]+| +|\n|{SPACE}")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEN_SHIFT = np.uint64(46)
_NOTHING = (np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1 << 18, dtype=bool))


@dataclass
class Vocabulary:
    """Pieces with their scores; bytes for the rest."""

    ids: dict[str, int]
    scores: dict[str, float]
    texts: list[bytes]  # of every id; control ids are empty
    byte_ids: list[int]
    #: Per length the hashes of the pieces, their ids and scores, and which leading bits of a hash occur.
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    unknown: float = 0.0  # score of a character outside
    encoders: dict[int, Encoder] = field(default_factory=dict, repr=False)  # by N, in use


def vocabulary(pieces: list[tuple[int, str, float]], byte_ids: list[int], size: int) -> Vocabulary:
    """From (id, piece, score), the ids of the 256 bytes and the number of ids."""
    crossing = [p for _, p, _ in pieces if re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S)]
    if crossing:
        raise ValueError(f"Pieces cross the places where texts are cut: {crossing[:3]}")
    texts = [b""] * size
    for i, p, _ in pieces:
        texts[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        texts[i] = bytes([b])
    vocab = Vocabulary({p: i for i, p, _ in pieces}, {p: s for _, p, s in pieces}, texts, byte_ids)
    vocab.unknown = min(vocab.scores.values(), default=0.0) - UNKNOWN_PENALTY
    by_length: dict[int, list[tuple[int, int, float]]] = {}
    for i, p, s in pieces:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in p:
                h = h * _BASE + np.uint64(ord(c) + 1)
        by_length.setdefault(len(p), []).append((int(h), i, s))
    for n, rows in by_length.items():
        rows.sort()
        hashes = np.array([r[0] for r in rows], dtype=np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("Two pieces share a hash")
        seen = np.zeros(1 << 18, dtype=bool)
        seen[(hashes >> _SEEN_SHIFT).astype(np.int64)] = True
        vocab.tables[n] = (hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), seen)
    return vocab


def load(path: str = MODEL) -> Vocabulary:
    """Pieces of a SentencePiece model file with byte fallback."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    bytes_of = {model.id_to_piece(i): i for i in range(size) if model.is_byte(i)}
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return vocabulary(
        [(i, model.id_to_piece(i), model.get_score(i)) for i in plain], [bytes_of[f"<0x{b:02X}>"] for b in range(256)], size
    )


def chunks(text: str) -> list[str]:
    """Parts of the text with a space before it; no piece crosses them.  An empty text has none."""
    return _CHUNK.findall(" " + text) if text else []


# --- one chunk as a lattice -------------------------------------------------------------------------


def lattice(chunk: str, vocab: Vocabulary) -> list[list[tuple[int, float, tuple[int, ...]]]]:
    """For every end position the edges (start, score, ids) that arrive there."""
    literal = chunk == SPACE  # the character itself, which would decode as a space
    text = chunk.replace(" ", SPACE)
    arrive: list[list] = [[] for _ in range(len(text) + 1)]
    longest = max(vocab.tables, default=1)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + longest) + 1):
            piece = text[i:j]
            if piece in vocab.ids and not literal:
                arrive[j].append((i, vocab.scores[piece], (vocab.ids[piece],)))
        if literal or text[i] not in vocab.ids:
            own = " " if text[i] == SPACE and not literal else text[i]
            arrive[i + 1].append((i, vocab.unknown, tuple(vocab.byte_ids[b] for b in own.encode())))
    return arrive


def forward(arrive: list[list]) -> list[float]:
    best = [0.0] + [float("-inf")] * (len(arrive) - 1)
    for end in range(1, len(arrive)):
        best[end] = max((best[i] + s for i, s, _ in arrive[end]), default=float("-inf"))
    return best


def n_best(arrive: list[list], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best paths, best first, by A-star from the end with the forward scores as its heuristic.

    The heuristic is exact, so every open place stands for a path of just its cost and no more of them than paths are still wanted
    need to stay open.  Of equal costs the place nearest to the start goes on, then the one found first.
    """
    ahead = forward(arrive)
    # (cost, place, number, score so far, ids from here as nested pairs), ascending
    queue: list[tuple] = [(-ahead[-1], len(arrive) - 1, 0, 0.0, None)]
    out: list[tuple[float, tuple[int, ...]]] = []
    number = 0
    while queue and len(out) < n:
        _, at, _, behind, path = queue.pop(0)
        if at == 0:
            ids: list[int] = []
            while path is not None:
                ids += path[0]
                path = path[1]
            out.append((behind, tuple(ids)))
            continue
        for start, score, own in arrive[at]:
            total = behind + score
            cost = -(total + ahead[start])
            if len(queue) < n - len(out) or (cost, start) < queue[-1][:2]:
                number += 1
                insort(queue, (cost, start, number, total, (own, path)))
                del queue[n - len(out) :]
    return out


def best_and_gap(arrive: list[list]) -> tuple[tuple[int, ...], float, float]:
    """Ids and score of the best path and its lead over the second best (infinite if there is none), in one pass each way."""
    ahead, last = forward(arrive), len(arrive) - 1
    behind = [float("-inf")] * last + [0.0]
    for end in range(last, 0, -1):
        for start, score, _ in arrive[end]:
            behind[start] = max(behind[start], score + behind[end])
    taken, parts, at = {}, [], last
    while at:
        start, _, own = max(arrive[at], key=lambda e: ahead[e[0]] + e[1])  # of equal ones the first, which is the longest piece
        taken[at] = start
        parts.append(own)
        at = start
    second = max(
        (ahead[i] + s + behind[end] for end in range(1, last + 1) for i, s, _ in arrive[end] if taken.get(end) != i), default=float("-inf")
    )
    return tuple(i for own in reversed(parts) for i in own), ahead[last], ahead[last] - second


# --- many chunks at once ----------------------------------------------------------------------------


def score_chunks(words: list[str], vocab: Vocabulary) -> list[tuple[bytes, float, float]]:
    """For every chunk the ids (int32) of its best path, its score, and the gap to the second best (infinite if there is none)."""
    out: list = [None] * len(words)
    longest = max(vocab.tables, default=1)
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w) if len(w) <= LONG_CHUNK and w != SPACE else 0, []).append(k)
    for k in by_length.pop(0, []):
        ids, score, gap = best_and_gap(lattice(words[k], vocab))
        out[k] = (np.array(ids, np.int32).tobytes(), score, gap)
    for length, members in by_length.items():
        cps = np.frombuffer("".join([words[k] for k in members]).encode("utf-32-le"), "<u4").reshape(-1, length).astype(np.uint64)
        cps = np.where(cps == 32, np.uint64(ord(SPACE)), cps).T + np.uint64(1)  # one row for each position
        n, rows = len(members), np.arange(len(members))
        edges = []  # (start, length, chunks that have a piece there, ids, scores)
        for i in range(length):
            h = np.zeros(n, dtype=np.uint64)
            for size in range(1, min(longest, length - i) + 1):
                h = h * _BASE + cps[i + size - 1]
                hashes, known, values, seen = vocab.tables.get(size, _NOTHING)
                some = np.flatnonzero(seen[(h >> _SEEN_SHIFT).astype(np.int64)])
                at = np.minimum(np.searchsorted(hashes, h[some]), len(hashes) - 1)
                hit = hashes[at] == h[some]
                at, some = at[hit], some[hit]
                if size == 1:  # a character outside the vocabulary is an edge too
                    ids, scores = np.full(n, -2), np.full(n, vocab.unknown)
                    ids[some], scores[some] = known[at], values[at]
                    edges.append((i, 1, rows, ids, scores))
                elif len(some):
                    edges.append((i, size, some, known[at], values[at]))
        ahead = np.full((length + 1, n), -np.inf)
        ahead[0] = 0
        step = np.zeros((length + 1, n), dtype=np.int64)
        piece = np.zeros((length + 1, n), dtype=np.int64)
        for i, size, own, ids, scores in edges:  # starts ascend, so every start is final
            value = ahead[i][own] + scores
            better = value > ahead[i + size][own]
            own = own[better]
            ahead[i + size][own], step[i + size][own], piece[i + size][own] = value[better], size, ids[better]
        behind = np.full((length + 1, n), -np.inf)
        behind[length] = 0
        for i, size, own, ids, scores in reversed(edges):
            behind[i][own] = np.maximum(behind[i][own], scores + behind[i + size][own])
        taken = np.zeros((length, n), dtype=np.int64)  # step of the best path at each start, 0 elsewhere
        path = np.full((n, length), -1, dtype=np.int64)
        at = np.full(n, length)
        live = rows
        while len(live):
            size, last = step[at[live], live], piece[at[live], live]
            at[live] -= size
            taken[at[live], live], path[live, at[live]] = size, last
            live = live[at[live] > 0]
        second = np.full(n, -np.inf)
        for i, size, own, ids, scores in edges:
            other = np.where(taken[i][own] == size, -np.inf, ahead[i][own] + scores + behind[i + size][own])
            second[own] = np.maximum(second[own], other)
        best = ahead[length]
        gaps = best - second
        inside = path != -1
        data, ends = path[inside].astype(np.int32).tobytes(), 4 * np.cumsum(inside.sum(axis=1))
        low = 0
        for k, high, score, gap in zip(members, ends.tolist(), best.tolist(), gaps.tolist()):
            out[k] = (data[low:high], score, gap)
            low = high
        for row in np.flatnonzero((path == -2).any(axis=1)):
            word, found = words[members[row]], []
            for start in np.flatnonzero(inside[row]):
                found += [path[row, start]] if path[row, start] >= 0 else [vocab.byte_ids[b] for b in word[start].encode()]
            _, score, gap = out[members[row]]
            out[members[row]] = (np.array(found, dtype=np.int32).tobytes(), score, gap)
    return out


# --- texts ------------------------------------------------------------------------------------------


def combine(options: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` smallest sums that take one loss of every list (each ascends from 0), with the choices."""
    queue, seen, out = [(0.0, (0,) * len(options))], {(0,) * len(options)}, []
    while queue and len(out) < n:
        loss, pick = heapq.heappop(queue)
        out.append((loss, pick))
        for k, own in enumerate(options):
            if pick[k] + 1 < len(own):
                more = pick[:k] + (pick[k] + 1,) + pick[k + 1 :]
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(queue, (loss - own[pick[k]] + own[pick[k] + 1], more))
    return out


class Encoder:
    """Encodes texts and remembers frequent chunks."""

    def __init__(self, vocab: Vocabulary, best: int = BEST):
        self.vocab, self.best = vocab, best
        self.place: dict[str, int] = {}
        self.parts: list[bytes] = []  # ids of the best path of every chunk known
        self.values = np.zeros((0, 2))  # and its score and gap
        self.lists: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def _alternatives(self, chunk: str) -> list[tuple[float, tuple[int, ...]]]:
        if chunk not in self.lists:
            if len(self.lists) > REMEMBERED // 10:
                self.lists.clear()
            found = n_best(lattice(chunk, self.vocab), self.best)
            # The path that stands in the result leads its equals.
            own = tuple(np.frombuffer(self.parts[self.place[chunk]], np.int32).tolist())
            found = [(found[0][0], own), *(x for x in found if x[1] != own)][: self.best]
            if len(chunk) > LONG_CHUNK:
                return found
            self.lists[chunk] = found
        return self.lists[chunk]

    def _learn(self, here: set[str]) -> None:
        if len(self.place) > REMEMBERED:  # what comes back stays
            stays = [c for c in here if c in self.place]
            old = [self.place[c] for c in stays]
            self.parts, self.values = [self.parts[k] for k in old], self.values[old]
            self.place = dict(zip(stays, range(len(stays))))
        new = [c for c in here if c not in self.place]
        scored = score_chunks(new, self.vocab)
        self.place.update(zip(new, range(len(self.parts), len(self.parts) + len(new))))
        self.parts += [x[0] for x in scored]
        self.values = np.concatenate([self.values, np.array([x[1:] for x in scored]).reshape(-1, 2)])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, float, list[dict]]]:
        """Ids (int32) of the best segmentation, its score, and the N best: score and the chunks that differ from the best, with their ids."""
        parts = [chunks(t) for t in texts]
        self._learn(set().union(*parts))
        place, known = self.place.__getitem__, self.parts
        few = self.best - 1
        for own in parts:
            at = list(map(place, own))
            ids = b"".join([known[k] for k in at])
            scores, gaps = self.values[at].T if at else np.zeros((2, 0))
            score = float(scores.sum())
            if len(gaps) > few > 0:
                limit = np.partition(gaps, few - 1)[few - 1]
                near = np.concatenate([np.flatnonzero(gaps < limit), np.flatnonzero(gaps == limit)])[:few]
            else:
                near = np.arange(len(gaps)) if few else np.array([], dtype=int)
            near = sorted(int(k) for k in near if np.isfinite(gaps[k]))
            lists = [self._alternatives(own[k]) for k in near]
            found = combine([[paths[0][0] - s for s, _ in paths] for paths in lists], self.best)
            yield ids, score, [
                {"score": score - loss, "edits": [{"chunk": k, "ids": list(paths[p][1])} for k, paths, p in zip(near, lists, pick) if p]}
                for loss, pick in found
            ]


def encoder_of(vocab: Vocabulary, best: int) -> Encoder:
    """The encoder of a shared vocabulary; tasks of one Python worker go on with what the last one remembered."""
    if best not in vocab.encoders:
        vocab.encoders[best] = Encoder(vocab, best)
    return vocab.encoders[best]


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of ids; the space that encoding puts in front is taken away, and bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(vocab.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def _lots(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


_NBEST = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("chunk", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))


def encode_rows(docs: DataFrame, vocab: Vocabulary | None = None, best: int = BEST, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``keep``, ``ids, score, n_best`` for every row of ``docs`` (doc_id, text).

    ``ids`` is the best segmentation and decodes to the text exactly.  ``n_best`` lists up to ``best`` segmentations, best first: their
    scores, and as edits the chunks (numbered from 0, see ``chunks``) that differ from the best with their ids.  A null or empty text has no
    ids, score 0 and itself as its only segmentation.  Characters outside the vocabulary, line feeds and the space sign U+2581 become bytes.
    Of equal scores the earlier chunk's change comes first; equal texts are encoded alike.
    """
    names = ["doc_id", *keep]
    shared = docs.sparkSession.sparkContext.broadcast(vocab or load())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, best)
        for batch in parts:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in _lots(texts):
                rows = list(encoder.encode(texts[low:high]))
                ends = np.cumsum([0] + [len(r[0]) // 4 for r in rows], dtype=np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join([r[0] for r in rows]))])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n)[low:high] for n in names), pa.ListArray.from_arrays(pa.array(ends), values),
                     pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], _NBEST)],
                    names=[*names, "ids", "score", "n_best"],
                )

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    schema = f"{kinds}, ids array<int>, score double, n_best array<struct<score:double,edits:array<struct<chunk:int,ids:array<int>>>>>"
    return arrow_rows(docs).select(*names, "text").mapInArrow(batches, schema)


def decode_rows(encoded: DataFrame, vocab: Vocabulary | None = None) -> DataFrame:
    """All columns of ``encoded`` (ids) and the decoded ``text``; a null list of ids gives a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab or load())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            ids = batch.column("ids")
            values, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            valid = ids.is_valid().to_pylist()
            texts = [decode(values[at[i] : at[i + 1]], own) if valid[i] else None for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return arrow_rows(encoded).mapInArrow(batches, f"{schema}, text string")


def encoded_rows(docs: DataFrame, vocab: Vocabulary | None = None, best: int = BEST, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``encode_rows`` with the number of pieces."""
    return encode_rows(docs, vocab, best, keep).withColumn("n_pieces", F.size("ids").cast("bigint"))


def round_trip_rows(docs: DataFrame, vocab: Vocabulary | None = None, best: int = BEST) -> DataFrame:
    """The rows of ``encoded_rows``, the SHA-256 of the text that their ids decode to, and whether the source has the same (a null one counts as empty)."""
    source = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("_source"))
    decoded = decode_rows(encoded_rows(source, vocab, best, ("_source",)), vocab)
    return decoded.withColumn("decoded_sha256", F.sha2(F.col("text").cast("binary"), 256)).withColumn(
        "lossless", F.col("decoded_sha256") == F.col("_source")
    ).drop("text", "_source")
