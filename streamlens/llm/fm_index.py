"""FM-index of a shard of documents over words (numpy, used inside Spark tasks).

The text of a shard is its documents' word codes, each document closed by a
separator of its own; separators order by document, so all suffixes differ and
no match crosses documents.  The index holds the Burrows-Wheeler transform as a
wavelet matrix (one ranked bit vector per code bit), the symbol counts, and the
suffix positions whose place in their document is a multiple of ``sample``.
"""

from __future__ import annotations

import numpy as np


class RankedBits:
    """A bit vector with constant-time rank: running counts per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        counts = np.bitwise_count(words).astype(np.uint32)
        self.before = np.cumsum(counts, dtype=np.uint32) - counts
        self.ones = int(self.before[-1] + counts[-1])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Rank and access over codes below ``sigma``."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, (sigma - 1).bit_length())
        self.levels: list[RankedBits] = []
        self.zeros: list[int] = []
        for b in range(self.bits - 1, -1, -1):
            one = (seq >> b) & 1 == 1
            level = RankedBits(one)
            self.levels.append(level)
            self.zeros.append(len(seq) - level.ones)
            seq = np.concatenate([seq[~one], seq[one]])
        self.base = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, zeros, b in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1)):
            ones = level.rank1(i)
            i = np.where((code >> b) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``code`` occurs before position ``i`` (element-wise)."""
        return self._descend(code, i) - self.base[code]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code at position ``i`` and how often it occurs before it."""
        code = np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros):
            bit = level.get(i)
            ones = level.rank1(i)
            code = (code << 1) | bit
            i = np.where(bit, zeros + ones, i - ones)
        return code, i - self.base[code]


def suffix_array(text: np.ndarray, n_codes: int) -> np.ndarray:
    """Suffix order by prefix doubling; only suffixes that are still tied are
    sorted again.  The last symbol must be unique."""
    n = len(text)
    bits = max(1, (n_codes - 1).bit_length())
    depth = max(1, min(8, 62 // bits))
    first = text.astype(np.int64)
    for j in range(1, depth):
        first <<= bits
        if j < n:
            first[:n - j] |= text[j:]
    sa = np.argsort(first)
    first = first[sa]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(first[1:], first[:-1], out=new[1:])
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[sa] = heads[np.cumsum(new) - 1]
    del first
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    h = depth
    while len(tied):
        p = sa[tied]
        k = (rank[p].astype(np.int64) << 32) | rank[p + h]
        o = np.argsort(k)
        p, k = p[o], k[o]
        sa[tied] = p
        new = np.empty(len(k), bool)
        new[0] = True
        np.not_equal(k[1:], k[:-1], out=new[1:])
        rank[p] = tied[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
        tied = tied[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


class FMIndex:
    def __init__(self, codes: np.ndarray, n_words: np.ndarray, sigma: int, sample: int = 8):
        """``codes``: all word codes (0..sigma-1) of the documents one after
        the other; ``n_words``: words per document (at least one document)."""
        n_docs = len(n_words)
        ends = np.cumsum(n_words + 1) - 1  # separator positions
        n = int(ends[-1]) + 1
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        is_sep = np.zeros(n, bool)
        is_sep[ends] = True
        text = np.empty(n, np.int32)
        text[ends] = np.arange(n_docs)
        text[~is_sep] = codes + n_docs
        sa = suffix_array(text, sigma + n_docs)
        bwt = text[sa - 1]  # the symbol before each suffix; row of suffix 0 gets the last separator
        bwt = np.where(bwt < n_docs, 0, bwt - n_docs + 1).astype(np.int32)  # one code for all separators
        self.wavelet = WaveletMatrix(bwt, sigma + 1)
        counts = np.bincount(codes, minlength=sigma)
        self.first = n_docs + np.concatenate([[0], np.cumsum(counts)])  # C: first row of each word code
        place = np.arange(n) - np.repeat(self.starts, n_words + 1)
        kept = (place % sample == 0)[sa]
        self.sampled = RankedBits(kept)
        self.positions = sa[kept].astype(np.int32)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of each pattern, by backward search.  Patterns
        are right-aligned rows of word codes; hi <= lo: no occurrence."""
        width = patterns.shape[1]
        lo = np.zeros(len(patterns), np.int64)
        hi = np.zeros(len(patterns), np.int64)
        live = np.flatnonzero(lengths > 0)
        code = patterns[live, width - 1]
        lo[live], hi[live] = self.first[code], self.first[code + 1]
        for j in range(1, width):
            live = live[(lengths[live] > j) & (hi[live] > lo[live])]
            if not len(live):
                break
            code = patterns[live, width - 1 - j]
            lo[live] = self.first[code] + self.wavelet.rank(code + 1, lo[live])
            hi[live] = self.first[code] + self.wavelet.rank(code + 1, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step backwards (LF) to a sampled one.
        Every document start is sampled, so no walk crosses a separator."""
        out = np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        at, step = rows.astype(np.int64), 0
        while len(todo):
            hit = self.sampled.get(at)
            out[todo[hit]] = self.positions[self.sampled.rank1(at[hit])] + step
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                code, before = self.wavelet.access_rank(at)
                at = self.first[code - 1] + before
                step += 1
        return out
