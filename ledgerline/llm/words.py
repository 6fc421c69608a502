"""Word hashing inside Python tasks: numpy over the UTF-8 bytes of one text.

A word is a run of bytes other than space and 0x09-0x0D (the byte values of
multi-byte characters never collide with them).  A word's 64-bit hash is a
polynomial over its bytes, modulo 2**64, finished with a bit mixer.  Texts
are hashed in chunks cut at white space, so the temporary arrays stay small
however long the text is.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROLL = np.uint64(0xD1342543DE82EF95)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# A-Z folded and every ASCII sign that is no letter or digit a space
_PLAIN = _LOWER.copy()
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit (wraps mod 2**64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, 256)


def _pow_table(n: int) -> np.ndarray:
    return _POW if n <= len(_POW) else _powers(_BASE, n)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(_SPACE[data], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _chunk_hashes(data: np.ndarray) -> np.ndarray:
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lens = ends - starts
    edges = np.concatenate(([0], np.cumsum(lens)))
    letters = data[~_SPACE[data]].astype(np.uint64) + np.uint64(1)
    at = np.arange(edges[-1]) - np.repeat(edges[:-1], lens)
    sums = np.add.reduceat(letters * _pow_table(int(lens.max()))[at], edges[:-1])
    return mix(sums + lens.astype(np.uint64) * _ROLL)


def word_hashes(text: str | bytes | None, lower: bool = False, plain: bool = False) -> np.ndarray:
    """uint64 hash of every word, in order; ``lower`` folds A-Z first,
    ``plain`` also takes ASCII punctuation as white space."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    data = np.frombuffer(raw, dtype=np.uint8)
    if lower or plain:
        data = (_PLAIN if plain else _LOWER)[data]
    if len(data) <= _CHUNK:
        return _chunk_hashes(data)
    parts, at = [], 0
    while at < len(data):
        cut = min(at + _CHUNK, len(data))
        while cut < len(data) and not _SPACE[data[cut]]:
            more = np.flatnonzero(_SPACE[data[cut : cut + _CHUNK]])
            cut = cut + int(more[0]) if len(more) else min(cut + _CHUNK, len(data))
        parts.append(_chunk_hashes(data[at:cut]))
        at = cut
    return np.concatenate(parts)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """uint64 hash of every run of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    weights = _powers(_ROLL, size + 1)[1:]
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        acc += words[j : j + n] * weights[j]
    return mix(acc + np.uint64(size))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles, A-Z folded: runs of
    ``size`` words, or the whole sequence where there are fewer; no word, no
    shingle."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(size, len(words))))
