"""Marginal probability of a word under a unigram model of subword pieces (Kudo 2018), in numpy.

A word is read as its UTF-8 bytes behind one blank, the mark of a word's beginning. The
pieces are byte strings, each with a log weight. Every way to cut the word into pieces
has the product of its pieces' weights; the forward recursion adds all of them up, in
logarithms, from left to right. All 256 single bytes are pieces, so every word has a cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LONGEST = 16
#: Distinct words read together, of about the same length.
GROUP = 20_000
GROUP_BYTES = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Lattice:
    """``tables``: for each length the sorted piece hashes and the pieces' numbers; ``logp``: weights by
    piece number, the last one that of the end of a text."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]]
    logp: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes], logp: np.ndarray) -> Lattice:
        """Pieces longer than ``LONGEST`` bytes must have been left out; ``logp`` has one more value, for the end."""
        lengths = np.array([len(p) for p in pieces])
        tables = {}
        for n in np.unique(lengths):
            ids = np.flatnonzero(lengths == n)
            data = np.frombuffer(b"".join(pieces[i] for i in ids), dtype=np.uint8).reshape(len(ids), n)
            sums = _prefix(data)
            key = sums[:, n]
            order = np.argsort(key)
            tables[int(n)] = (key[order], ids[order])
        return cls(tables, logp)

    def with_weights(self, logp: np.ndarray) -> Lattice:
        return Lattice(self.tables, logp)

    def _arcs(self, data: np.ndarray):
        """For each end and length the piece number of every word's stretch, -1 where there is none."""
        sums = _prefix(data)
        size = data.shape[1]
        found: dict[tuple[int, int], np.ndarray] = {}
        for n, (keys, ids) in self.tables.items():
            with np.errstate(over="ignore"):
                lift = _power(n)
                for end in range(n, size + 1):
                    h = sums[:, end] - sums[:, end - n] * lift
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit = keys[at] == h
                    if hit.any():
                        found[end, n] = np.where(hit, ids[at], -1)
        return found

    def _weights(self, arc: np.ndarray) -> np.ndarray:
        return np.where(arc >= 0, self.logp[arc], -np.inf)

    def _forward(self, data: np.ndarray, arcs) -> np.ndarray:
        alpha = np.full((data.shape[1] + 1, len(data)), -np.inf)
        alpha[0] = 0.0
        for end in range(1, data.shape[1] + 1):
            for n in range(1, min(end, LONGEST) + 1):
                if (end, n) in arcs:
                    alpha[end] = np.logaddexp(alpha[end], alpha[end - n] + self._weights(arcs[end, n]))
        return alpha

    def log_probability(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log of every word's marginal probability."""
        out = np.zeros(len(bounds) - 1)
        for rows, block, lengths in _groups(data, bounds):
            alpha = self._forward(block, self._arcs(block))
            out[rows] = alpha[lengths, np.arange(len(rows))]
        return out

    def expected_counts(self, data: np.ndarray, bounds: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all cuts by their share and all words by ``weight``."""
        counts = np.zeros(len(self.logp))
        for rows, block, lengths in _groups(data, bounds):
            arcs = self._arcs(block)
            alpha = self._forward(block, arcs)
            size, n_rows = block.shape[1], np.arange(len(rows))
            total = alpha[lengths, n_rows]
            beta = np.full((size + 1, len(rows)), -np.inf)
            beta[lengths, n_rows] = 0.0
            for end in range(size, 0, -1):
                for n in range(1, min(end, LONGEST) + 1):
                    if (end, n) not in arcs:
                        continue
                    arc = arcs[end, n]
                    through = self._weights(arc) + beta[end]
                    beta[end - n] = np.logaddexp(beta[end - n], through)
                    use = np.flatnonzero((arc >= 0) & (through > -np.inf))
                    share = np.exp(alpha[end - n, use] + through[use] - total[use]) * weight[rows[use]]
                    counts += np.bincount(arc[use], weights=share, minlength=len(counts))
        return counts


def _power(n: int) -> np.uint64:
    out = np.uint64(1)
    with np.errstate(over="ignore"):
        for _ in range(n):
            out = out * _BASE
    return out


def _prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, in words of 64 bits; a stretch's hash follows from two of them."""
    sums = np.zeros((len(data), data.shape[1] + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(31)
        for i in range(data.shape[1]):
            sums[:, i + 1] = sums[:, i] * _BASE + mixed[data[:, i]]
    return sums


def _groups(data: np.ndarray, bounds: np.ndarray):
    """(rows, bytes, lengths): words of about equal length side by side, a blank before each, zeros behind."""
    lengths = np.diff(bounds)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lengths[order[min(at + GROUP, len(order)) - 1]]) + 1
        stop = min(len(order), at + max(1, min(GROUP, GROUP_BYTES // longest)))
        rows = order[at:stop]
        size = lengths[rows]
        width = int(size.max()) + 1
        block = np.zeros((len(rows), width), dtype=np.uint8)
        block[:, 0] = 0x20
        owner = np.repeat(np.arange(len(rows)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        block[owner, place + 1] = data[bounds[:-1][rows][owner] + place]
        yield rows, block, size + 1
        at = stop
