"""Word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15
_SPACES = bytes((0x20, *range(0x09, 0x0E)))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IS_WORD = np.array([b not in _SPACES for b in range(256)])

_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the input changes every bit of the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers_upto(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), _ROOT | 1, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many each text has.

    Words are runs without blanks (0x20, 0x09 to 0x0D), with A-Z in lower case.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b" " + b" ".join(parts).translate(_LOWER) + b" ", np.uint8)
    word = _IS_WORD[data]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    letters = data[word].astype(np.uint64) + _U(1)
    place = np.arange(len(letters)) - np.repeat(begins, lengths)
    letters *= _powers_upto(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(letters, begins) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    text_ends = np.cumsum(sizes + 1) + 1
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, text_ends)]))
    return hashes, counts


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, ascending. Fewer words than ``size`` make one shingle."""
    hashes, counts = word_hashes(texts)
    runs = np.zeros(len(hashes), np.uint64)
    weights = _powers_upto(size + 2)[1:]
    for k in range(size):
        if len(hashes) > k:
            runs[: len(hashes) - k] += hashes[k:] * weights[k]
    runs = mix(runs)
    begin = 0
    for n in counts.tolist():
        if n >= size:
            own = np.sort(runs[begin : begin + n - size + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            few = (hashes[begin : begin + n] * weights[:n]).sum(dtype=np.uint64)
            yield mix(np.array([few + _U(n)], np.uint64) ^ _U(_ROOT))
        else:
            yield runs[:0]
        begin += n
