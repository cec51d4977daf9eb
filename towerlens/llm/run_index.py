"""Run-length index of short texts: run-compressed BWT, sampled run ends, and match lengths streamed from them.

Two neighbours in suffix order that follow the same letter have neighbours one
position to the left, with a common prefix one longer. So common prefixes need
comparing only at the heads of BWT runs; from each such sample the lengths of
the next positions follow by counting down (the phi function of an r-index).
Repetitive texts have few runs.
"""

from __future__ import annotations

import numpy as np


def _word_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as a big-endian number (zeros behind the end)."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(text),), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)


class RunLengthIndex:
    """Over several texts of bytes above zero, none of which a match may leave."""

    def __init__(self, texts: list[bytes]):
        data = b"\x00".join(texts) + b"\x00"
        self.text = np.frombuffer(data, dtype=np.uint8)
        n = len(self.text)
        ends = np.flatnonzero(self.text == 0)
        self.text_of = np.searchsorted(ends, np.arange(n))
        self.left = ends[self.text_of] - np.arange(n)  # bytes before the end of the own text
        self.suffixes = self._sort()
        before = np.concatenate([[0], self.text[:-1]])[self.suffixes] if n else self.text
        # Run heads; the ends of texts differ from each other, so each is a run of its own.
        heads = np.flatnonzero((before != np.concatenate([[0], before[:-1]])) | (before == 0))
        self.run_letters, self.run_lengths = before[heads], np.diff(np.append(heads, n))
        self.run_heads, self.run_ends = self.suffixes[heads], self.suffixes[np.append(heads[1:], n) - 1]  # the samples
        self._samples = self._compare(self.run_heads, self.suffixes[heads - 1], heads == 0)

    def _sort(self) -> np.ndarray:
        """Suffix order by prefix doubling of what is not yet apart; a suffix ends with its text, equal ones keep their order."""
        n = len(self.text)
        keep = np.minimum(self.left, 8)
        key = _word_at(self.text)
        shift = ((8 - keep) * 8).astype(np.uint64)
        key = np.where(keep > 0, (key >> np.minimum(shift, 63)) << np.minimum(shift, 63), 0).astype(np.uint64)
        order = np.argsort(key)
        ranked = key[order]
        slots, width = np.arange(n), 8  # places in the order that are not settled yet: runs of equal keys
        rank = np.empty(n, dtype=np.int64)
        while True:
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0)) + 1  # the first place of its run
            slots = slots[~(new & np.append(new[1:], True))]
            if not len(slots):
                return order
            open_ = order[slots]
            if width >= self.left[open_].max():
                order[slots] = open_[np.argsort(rank[open_] * (n + 1) + open_)]  # equal suffixes by place
                return order
            follows = np.zeros(len(open_), dtype=np.int64)
            inside = np.flatnonzero(self.left[open_] > width)
            follows[inside] = rank[open_[inside] + width]
            key = rank[open_] * (n + 1) + follows
            by = np.argsort(key)
            order[slots], ranked = open_[by], key[by]
            width *= 2

    def _compare(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at a and b (0 where there is no neighbour)."""
        out = np.zeros(len(a), dtype=np.int64)
        most = np.where(first, 0, np.minimum(self.left[a], self.left[b]))
        words = _word_at(self.text)
        at = np.flatnonzero(most > 0)
        while len(at):  # eight bytes a step
            differ = words[a[at] + out[at]] ^ words[b[at] + out[at]]
            same = sum((differ < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8)) + (differ == 0)
            out[at] += same
            at = at[(same == 8) & (out[at] < most[at])]
        return np.minimum(out, most)

    def common_prefixes(self) -> np.ndarray:
        """For every suffix in order, the bytes it shares with the one before: streamed from the samples at run heads."""
        n = len(self.text)
        sampled = np.full(n, -1, dtype=np.int64)
        sampled[self.run_heads] = self._samples
        at = np.maximum.accumulate(np.where(sampled >= 0, np.arange(n), -1))
        lengths = np.maximum(sampled[at] - (np.arange(n) - at), 0)  # one less with every step to the right
        return lengths[self.suffixes]

    def smallest_owner(self, owners: np.ndarray, length: int) -> np.ndarray:
        """For every position, the smallest owner of a text that holds the ``length`` bytes from there (-1: text too short)."""
        n = len(self.text)
        out = np.full(n, -1, dtype=np.int64)
        shares = self.common_prefixes() >= length
        starts = np.flatnonzero(~shares)
        if n:
            low = np.minimum.reduceat(owners[self.text_of[self.suffixes]], starts)
            out[self.suffixes] = np.repeat(low, np.diff(np.append(starts, n)))
        out[self.left < length] = -1
        return out
