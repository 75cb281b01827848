"""Words as ``[^\\x20\\x09-\\x0D]+``: native expressions and vectorised helpers for Arrow batches."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\f\r "  # fixed value: the bytes that part words
SPACE_RUN = r"[\x20\x09-\x0D]+"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def word_array(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest table asked for is kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1), np.uint64(base))
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _POWERS[base] = known
    return known[:n]


def rolling(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of every ``width`` consecutive values (position i covers i .. i+width-1)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = _BASES[which] | 1
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=prefix[1:])
    return mixed((prefix[width:] - prefix[:-width]) * powers(pow(base, -1, 1 << 64), n))


def portions(texts: pa.Array, most_bytes: int = 1 << 19) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive pieces of a batch with about ``most_bytes`` of text each, and where they start.

    Bounds what the vectorised helpers hold at a time; a single longer text is a piece of its own.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(texts)]
    for low, high in itertools.pairwise(cuts):
        if low < high:
            yield int(low), texts.slice(low, high - low)


class WordBatch:
    """All words of a batch of texts, hashed at once.

    starts, ends: byte range of each word in ``data``; first: index of each text's first word,
    with one entry more at the end; hashes: a 64-bit hash of each word's bytes.
    """

    def __init__(self, texts: pa.Array, fold_ascii: bool = False, parts: np.ndarray | None = None) -> None:
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low = int(bounds[0])
        raw = np.frombuffer(data, np.uint8)[low:int(bounds[-1])] if data is not None else np.empty(0, np.uint8)
        self.bounds = bounds - low
        if fold_ascii:
            raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
        self.data = raw
        word = IN_WORD[raw] if parts is None else parts[raw]
        begins, stops = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        stops[:-1] &= ~word[1:]
        # a word also begins and stops where its text does
        edges = self.bounds[:-1][self.bounds[:-1] < len(raw)]
        begins[edges] = word[edges]
        edges = self.bounds[1:][self.bounds[1:] > 0] - 1
        stops[edges] = word[edges]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A polynomial in each word's bytes, from running sums, scrambled with the length."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.multiply(self.data, powers(_BASES[0] | 1, len(self.data)), out=sums[1:])
        np.cumsum(sums, out=sums)
        back = powers(pow(_BASES[0] | 1, -1, 1 << 64), len(self.data))[self.starts]
        lengths = (self.ends - self.starts).astype(np.uint64)
        return mixed((sums[self.ends] - sums[self.starts]) * back + mixed(lengths))


IN_WORD = np.ones(256, bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words, A-Z folded.

    A text with fewer words gives its whole sequence as one; without words, nothing.
    """
    out = []
    for _, portion in portions(texts):
        batch = WordBatch(portion, fold_ascii=True)
        hashes = batch.hashes()
        grams = rolling(hashes, width)
        for first, count in zip(batch.first, batch.counts, strict=False):
            if count >= width:
                out.append(np.unique(grams[first:first + count - width + 1]))
            elif count:
                short = rolling(hashes[first:first + count], int(count)) ^ mixed(np.full(1, count, np.uint64))
                out.append(short)
            else:
                out.append(np.empty(0, np.uint64))
    return out
