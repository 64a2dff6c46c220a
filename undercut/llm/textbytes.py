"""UTF-8 texts of Arrow batches as flat numpy arrays: words and their hashes.

Every word class used here holds all bytes from 0x80 up or none of the ASCII bytes that
separate words, so classes of bytes decide as classes of code points would.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that white space separates.
SPACED = ~SPACES
#: Bytes of words of digits, letters a-z and everything beyond ASCII, in lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; a bijection."""
    values = values ^ (values >> np.uint64(30))
    values *= MIX_1
    values ^= values >> np.uint64(27)
    values *= MIX_2
    values ^= values >> np.uint64(31)
    return values


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    table = np.full((2, 1 << bits), 1, np.uint64)
    table[0, 1:], table[1, 1:] = BASE, inverse
    np.cumprod(table, axis=1, out=table)
    return table[0], table[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n of them at least."""
    return _powers(max(21, int(n - 1).bit_length()))


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``limit`` bytes of text each, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with a space after each text, and where each text starts (one more at the end)."""
    large = pa.large_string()
    texts = pc.fill_null(texts.cast(large), pa.scalar("", large))
    parts = pc.binary_join_element_wise(texts, pa.scalar("", large), pa.scalar(" ", large))
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    starts = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
    data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]] if len(parts) else np.zeros(0, np.uint8)
    return data, starts - starts[0]


class Words:
    """Words of many texts: byte spans, 64-bit hashes and the first word of each text."""

    def __init__(self, texts: pa.Array, letters: np.ndarray, lower: bool = True):
        data, self.texts = joined(texts)
        self.data = LOWER[data] if lower else data
        self.inside = letters[self.data]
        step = np.diff(self.inside.astype(np.int8), prepend=np.int8(0))
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.starts, self.texts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @functools.cached_property
    def rows(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.texts) - 1), self.counts)

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        """A polynomial in the word's bytes modulo 2^64, mixed; equal words have equal hashes."""
        power, inverse = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mix(value + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive values, whatever text they lie in."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out *= BASE
        out += hashes[j : j + len(out)]
    return mix(out)
