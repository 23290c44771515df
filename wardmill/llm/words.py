"""Word hashes of texts straight from Arrow's bytes, without a Python string per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text hashed at a time, and of texts taken at a time.
WINDOW = 1 << 20
PIECE = 1 << 23

_U = np.uint64
STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, each to one other."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(punctuation: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it separates words, and its 64-bit value with A-Z as a-z."""
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    if punctuation:
        blank[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
    letters = np.arange(256)
    letters[65:91] += 32
    return blank, mixed((letters + 1).astype(_U) * STEP)


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)


def pieces(batch: pa.RecordBatch | pa.Array, name: str | None = None) -> Iterator:
    """Slices of a batch whose texts have about ``PIECE`` bytes; a longer text is a slice by itself."""
    texts = batch.column(name) if name else batch
    if not len(texts):
        return
    bounds = _offsets(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PIECE, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def word_hashes(texts: pa.Array, punctuation: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts in turn, and the number of words before each text.

    Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``, and with ``punctuation`` other than ASCII
    punctuation too. A word's hash is a polynomial over its bytes, taken from running sums, so there
    is no loop over words. Sums run over windows of about ``WINDOW`` bytes, cut between words.
    """
    if not len(texts):
        return np.empty(0, _U), np.zeros(1, np.int64)
    bounds = _offsets(texts)
    if bounds[-1] == bounds[0]:
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    blank, value = _tables(punctuation)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]: bounds[-1]]
    bounds = bounds - bounds[0]
    free = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = free.copy()
    begins[1:] &= ~free[:-1] | edge[1:-1]
    ends = free.copy()
    ends[:-1] &= ~free[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    out = np.empty(len(begins), _U)
    power, back = np.empty(0, _U), np.empty(0, _U)
    first = 0
    while first < len(begins):
        origin = begins[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + WINDOW, "right")))
        size = int(ends[last - 1] - origin)
        if size > len(power):
            power = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, STEP))])
            back = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, _BACK))])
        sums = np.zeros(size + 1, _U)
        np.cumsum(value[data[origin: origin + size]] * power[:size], out=sums[1:])
        a, b = begins[first:last] - origin, ends[first:last] - origin
        out[first:last] = mixed((sums[b] - sums[a]) * back[a])
        first = last
    return out, np.searchsorted(begins, bounds)
