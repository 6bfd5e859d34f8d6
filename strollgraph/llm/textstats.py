"""Counts over one whole text, taken from its UTF-8 bytes."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
WINDOW = 8

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` (a power of two) words found twice or more.

    Runs get exact numbers by doubling: equal pairs of numbers of runs of 1, 2, 4 words get equal numbers.
    """
    n = len(ids)
    if n <= window:
        return 0
    ranks, width = ids.astype(np.int64), 1
    while width < window:
        pairs = ranks[:-width] * (int(ranks.max()) + 1) + ranks[width:]
        order = np.argsort(pairs, kind="stable")
        sorted_pairs = pairs[order]
        ranks = np.empty(len(pairs), dtype=np.int64)
        ranks[order] = np.cumsum(np.concatenate(([0], sorted_pairs[1:] != sorted_pairs[:-1])))
        width *= 2
        counts = np.bincount(ranks)
        if counts.max() < 2:  # no shorter run repeats, so no longer one does
            return 0
    starts = np.flatnonzero(counts[ranks] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def counts(data: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then ASCII marks, ASCII capitals and words equal to the one before."""
    words = data.split()
    if not words:
        return (0,) * 8
    of_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    total = lambda mask: int(of_byte[mask].sum())
    return (
        len(words), total(~_CONTINUES & ~_SPACE), total(_SYMBOL), len(lines) - len(set(lines)), repeated_words(ids),
        total(_MARK), total(_UPPER), int((ids[1:] == ids[:-1]).sum()),
    )
