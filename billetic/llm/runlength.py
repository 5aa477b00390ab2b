"""A run-length index over short contexts: suffix order, Burrows-Wheeler runs
with sampled ends, and matching statistics streamed from them."""

from __future__ import annotations

import numpy as np

STEP, MOST = 7, 168     # symbols of 9 bits in a first key; longest context


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class RunLengthIndex:
    """Over contexts of at most MOST bytes, one after the other. Suffixes end
    with their context; of equal ones the earlier context is less.

    ``heads``: where the runs of the transform begin (in suffix order),
    ``head_at`` and ``tail_at``: the text places sampled at the runs' ends,
    ``head_lcp``: the match with the suffix before, known at the heads only.
    A context's first place counts as a head."""

    def __init__(self, contexts: list[bytes]):
        lens = np.array([len(c) for c in contexts])
        if len(lens) and lens.max() > MOST:
            raise ValueError("a context is too long")
        self.text = np.frombuffer(b"".join(contexts), np.uint8)
        n = len(self.text)
        self.end = np.repeat(np.cumsum(lens), lens)
        first = np.repeat(np.cumsum(lens) - lens, lens)
        at = np.arange(n)
        symbols = np.concatenate((self.text.astype(np.int64) + 1, np.zeros(STEP, np.int64)))
        key = np.zeros(n, np.int64)
        for j in range(STEP):
            key = key << 9 | np.where(at + j < self.end, symbols[at + j], 0)
        ranks = {STEP: _ranks(key)}
        size = STEP
        while size < MOST:
            step = min(size, MOST - size)
            there = at + step
            nxt = np.where(there < self.end, ranks[size][np.minimum(there, n - 1)] + 1, 0)
            ranks[size + step] = _ranks(ranks[size] * (n + 1) + nxt)
            size += step
        self._ranks = ranks
        self.order = np.argsort(ranks[size], kind="stable")
        before = np.where(self.order > first[self.order], symbols[self.order - 1], 0)
        is_head = np.ones(n, bool)
        is_head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.heads = np.flatnonzero(is_head)
        self.head_at = self.order[self.heads]
        self.tail_at = self.order[np.append(self.heads[1:], n) - 1] if n else self.order
        self.head_lcp = self._matches(self.order[self.heads - 1], self.head_at)
        if n:
            self.head_lcp[0] = 0

    def _matches(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of suffixes, from the ranks."""
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        got = np.zeros(len(a), np.int64)
        last = len(self.text) - 1
        for size in sorted(self._ranks, reverse=True):
            r = self._ranks[size]
            # ranks compare ends, too: equal ranks short of the end are equal symbols
            fits = got + size <= most
            same = fits & (r[np.minimum(a + got, last)] == r[np.minimum(b + got, last)])
            got += size * same
        for _ in range(STEP - 1):
            fits = got < most
            same = fits & (self.text[np.minimum(a + got, last)] == self.text[np.minimum(b + got, last)])
            got += same
        return got

    def statistics(self) -> np.ndarray:
        """For each place, in text order, the match with the suffix before
        its own in suffix order. Inside a run it is one less than at the
        place before, so only the heads' samples are read."""
        n = len(self.text)
        value, known = np.zeros(n, np.int64), np.zeros(n, bool)
        value[self.head_at], known[self.head_at] = self.head_lcp, True
        last = np.maximum.accumulate(np.where(known, np.arange(n), -1))
        return value[last] - (np.arange(n) - last)

    def repeats(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next ``length`` bytes also start at an earlier place,
        and the earliest such place."""
        if not len(self.text):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        long_ = self.statistics()[self.order] >= length
        group = np.cumsum(~long_)
        start = np.flatnonzero(~long_)
        earliest = np.minimum.reduceat(self.order, start)[group - 1]
        later = (self.order > earliest) & (self.end[self.order] - self.order >= length)
        return self.order[later], earliest[later]
