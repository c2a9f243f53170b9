"""Hashes of words and word runs for whole Arrow batches, with numpy.

Used inside tasks. A word's hash is a polynomial in random values of its
bytes, taken from a running sum over the batch, so no Python object is made
per word.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)               # odd, so it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEPS = _RNG.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
BLOCK = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, BLOCK)
_INV = _powers(_INVERSE, BLOCK)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if n >= len(_POW):
        return _powers(_BASE, n), _powers(_INVERSE, n)
    return _POW, _INV


def arrow_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array, null as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int64 if "large" in str(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * kind().itemsize)
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+`` in order, and the index of
    each text's first word (one more entry than texts). A-Z equal a-z."""
    inside = ~_IS_SPACE[raw]
    fresh = np.ones(len(raw) + 1, bool)                  # a word may start or must end here
    fresh[1:-1] = ~inside[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    after = np.ones(len(raw) + 1, bool)
    after[:-1] = ~inside
    after[offsets] = True
    stops = np.flatnonzero(inside & after[1:]) + 1
    out = np.empty(len(starts), np.uint64)
    table = _LOWER if lower else _BYTE
    at = 0
    while at < len(starts):                              # blocks of whole words bound the memory
        low = starts[at]
        end = max(int(np.searchsorted(stops, low + BLOCK - 1, "right")), at + 1)
        high = stops[end - 1]
        power, inverse = _power_tables(int(high - low))
        run = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[raw[low:high]] * power[:high - low], out=run[1:])
        a, b = starts[at:end] - low, stops[at:end] - low
        out[at:end] = (run[b] - run[a]) * inverse[a]
        at = end
    return mixed(out), np.searchsorted(starts, offsets).astype(np.int64)


def runs(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (k - 1 fewer entries)."""
    n = max(len(word) - k + 1, 0)
    h = np.full(n, (k * int(_STEPS[-1])) % 2**64, np.uint64)
    for j in range(k):
        h += word[j:j + n] * _STEPS[j]
    return mixed(h)


def shingle_sets(word: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the k-word runs of each text, and where each
    text's begin. A text of fewer words, but not none, has one: all of them."""
    n_words = np.diff(firsts)
    sizes = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(offsets[-1], np.uint64)
    every = runs(word, k)
    for i in np.flatnonzero(sizes):
        a, b, first = offsets[i], offsets[i + 1], firsts[i]
        if n_words[i] >= k:
            out[a:b] = every[first:first + b - a]
            out[a:b].sort()
        else:
            out[a:b] = runs(word[first:firsts[i + 1]], int(n_words[i]))
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[offsets[:-1][sizes > 0]] = True
    return out[fresh], np.concatenate(([0], np.cumsum(fresh)))[offsets]


def batches(batch, text_column: int, limit: int = 2 << 20):
    """Row ranges of an Arrow batch with about ``limit`` bytes of text."""
    _, offsets = arrow_bytes(batch.column(text_column))
    at = 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1, at + 1)
        end = min(end, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
