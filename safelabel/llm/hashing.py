"""Words, shingles and 64-bit hashes of many texts at once, on numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes depend
on content only, so any task gives the same ones. Long inputs are taken in blocks, so
memory follows the block and the number of words, not the number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 20
SHINGLE = 5

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; ``x`` itself is left alone."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = stream(11, 256)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0
_RADIX = _U(0xD1342543DE82EF95)
_STEP = stream(29, SHINGLE) | _U(1)


def batches(texts: Sequence[str | None], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters; one long text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and the end)."""
    parts = [encoded(t) for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    offsets = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    if not len(starts):
        return np.zeros(0, _U), offsets
    out = np.empty(len(starts), _U)
    edges = np.append(starts, len(data))
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK)))
        low, high = edges[at], edges[stop]
        own = starts[at:stop] - low
        place = np.arange(high - low) - np.repeat(own, np.diff(np.append(own, high - low)))
        power = np.full(int(place.max()) + 1, _RADIX, _U)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        out[at:stop] = np.add.reduceat(_BYTE[data[low:high]] * power[place], own)
        at = stop
    return mix(out), offsets


def shingles(words: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, offsets per text), runs in text order, repeats kept.

    A text of fewer words, but at least one, gives its whole sequence as one run.
    """
    n = len(words)
    steps = _STEP if size == SHINGLE else stream(29, size) | _U(1)
    if n >= size:
        total = words[: n - size + 1] * steps[0]
        for k in range(1, size):
            total += words[k : n - size + 1 + k] * steps[k]
        total = mix(total)
    else:
        total = np.zeros(0, _U)
    counts = np.diff(offsets)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.empty(int(runs.sum()), _U)
    places = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    full = np.flatnonzero(counts >= size)
    if len(full):
        source = np.repeat(offsets[full] - np.concatenate([[0], np.cumsum(runs[full])[:-1]]), runs[full]) + np.arange(int(runs[full].sum()))
        target = np.repeat(places[full] - np.concatenate([[0], np.cumsum(runs[full])[:-1]]), runs[full]) + np.arange(int(runs[full].sum()))
        out[target] = total[source]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[offsets[d] : offsets[d + 1]]
        out[places[d]] = mix(np.array([(own * steps[: len(own)]).sum() + _U(len(own))], _U))[0]
    return out, places


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their offsets."""
    values = values.copy()
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offsets[:-1][offsets[:-1] < len(values)]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[offsets]


def shingle_sets(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct five-word shingles of each text, and their offsets."""
    return distinct(*shingles(*word_hashes(texts)))
