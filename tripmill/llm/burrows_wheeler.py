"""Common prefixes of suffixes from a Burrows-Wheeler transform, by breadth-first backward extension."""

import numpy as np

from tripmill.llm.fm_index import WaveletMatrix, suffix_array


class _Extender(WaveletMatrix):
    """All backward extensions of many intervals at once."""

    def __init__(self, bwt: np.ndarray, symbols: int):
        super().__init__(bwt, max(1, int(symbols - 1).bit_length()))
        count = np.bincount(bwt, minlength=symbols)
        self.before = np.cumsum(count) - count
        # Where a symbol's run begins on the lowest level.
        self.bottom = np.zeros(symbols, np.int64)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            one = ((np.arange(symbols) >> level) & 1).astype(bool)
            self.bottom = np.where(one, zeros + ones[self.bottom], self.bottom - ones[self.bottom])

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of each string with one symbol more in front, for the symbols that occur there but 0."""
        symbol = np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one_low, one_high = ones[low], ones[high]
            has_one, has_zero = one_low < one_high, high - low > one_high - one_low
            symbol = np.concatenate([symbol[has_zero] * 2, symbol[has_one] * 2 + 1])
            low, high = (
                np.concatenate([(at - one)[has_zero], zeros + one[has_one]])
                for at, one in ((low, one_low), (high, one_high))
            )
        kept = symbol > 0
        shift = (self.before - self.bottom)[symbol[kept]]
        return low[kept] + shift, high[kept] + shift


def equal_prefix_classes(sequence: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each the number of its class: those that share their first ``length`` symbols.

    0 ends a text; no common prefix goes past one. Strings of 0, 1, 2 ... symbols are taken in turn, as intervals of the suffixes that
    begin with them. Where an interval of a string of l + 1 symbols ends and no smaller value was set, the common prefix with the next suffix is
    l; only intervals that set one go on. All values below ``length`` are set when strings of that length are reached, and there it stops:
    what is not set is at least that long.
    """
    n = len(sequence)
    values, sequence = np.unique(sequence, return_inverse=True)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if values[0] != 0:
        raise ValueError("the last text has no end")
    ends = sequence == 0
    n_ends = int(ends.sum())
    rank = sequence + n_ends
    rank[ends] = np.arange(n_ends)
    order = suffix_array(rank)
    bwt = _Extender(sequence[order - 1], len(values))
    unset = np.ones(n + 1, bool)
    unset[: n_ends + 1] = False
    unset[n] = False
    # Strings of one symbol: each end for itself, and each other symbol.
    low, high = bwt.extensions(np.array([0]), np.array([n]))
    unset[high] = False
    low = np.concatenate([np.arange(n_ends), low])
    high = np.concatenate([np.arange(1, n_ends + 1), high])
    for _ in range(1, length):
        low, high = bwt.extensions(low, high)
        new = unset[high]
        low, high = low[new], high[new]
        if not len(low):
            break
        unset[high] = False
    return order, np.cumsum(~unset[:n])
