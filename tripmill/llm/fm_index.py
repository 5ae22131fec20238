"""An FM-index over a sequence of small numbers, in numpy; all searches of a call run side by side."""

import numpy as np


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the length that ranks compare."""
    n = len(rank)
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    k = 1
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n - 1:
        behind = np.zeros(n, np.int64)
        behind[: n - k if k < n else 0] = rank[k:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(n, np.int64)
        np.cumsum(sorted_key[1:] != sorted_key[:-1], out=new[1:])
        rank[order] = new
        k *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, level by level of their bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.ones, self.zeros = [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = (now >> level) & 1
            count = np.zeros(len(now) + 1, np.int64)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(now) - count[-1])
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        begin = np.zeros(len(at), np.int64)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at - begin

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the positions, and how often each occurs before."""
        symbol = np.zeros(len(at), np.int64)
        begin = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = (ones[at + 1] - ones[at]).astype(bool)
            symbol = symbol * 2 + one
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return symbol, at - begin


class FMIndex:
    """Over a sequence in which 0 ends each text; searched phrases have no 0."""

    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = 8):
        sequence = sequence.astype(np.int64)
        n = len(sequence)
        ends = sequence == 0
        self.n_ends = int(ends.sum())
        # Each end is a symbol of its own, in the order of texts; so no comparison goes past one.
        rank = sequence + self.n_ends
        rank[ends] = np.arange(self.n_ends)
        order = suffix_array(rank)
        self.bwt = WaveletMatrix(sequence[order - 1], max(1, int(symbols).bit_length()))
        count = np.bincount(sequence, minlength=symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(count)])
        # Every eighth position and the first of each text: no walk back crosses an end.
        first = np.zeros(n, bool)
        if n:
            first[0] = True
            first[1:] = ends[:-1]
        kept = (order % sample == 0) | first[order]
        self.sampled = kept
        self.sample_at = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-open ranges of the suffixes that begin with each phrase; a phrase is a row, padded at its end."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.sampled), np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > k) & (low < high))
            symbol = phrases[live, k]
            low[live] = self.before[symbol] + self.bwt.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.bwt.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """Positions in the sequence where the suffixes start."""
        suffix = suffix.copy()
        steps = np.zeros(len(suffix), np.int64)
        walking = np.flatnonzero(~self.sampled[suffix])
        while len(walking):
            symbol, rank = self.bwt.access(suffix[walking])
            suffix[walking] = self.before[symbol] + rank
            steps[walking] += 1
            walking = walking[~self.sampled[suffix[walking]]]
        return self.samples[self.sample_at[suffix]] + steps
