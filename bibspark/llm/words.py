"""Words of many texts at once, as 64-bit hashes computed with numpy.

A word's hash is a polynomial over its bytes with random coefficients per byte
value, taken from prefix sums, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 20  # bytes per vectorised step; a longer text is cut between words


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _alphabet(is_word: np.ndarray) -> np.ndarray:
    """A random odd value per byte, capitals as small letters, 0 between words."""
    byte = np.arange(256)
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    values = mix((lower + 1).astype(U64) * U64(_BASE)) | U64(1)
    return np.where(is_word, values, U64(0)).astype(U64)


_BYTE = np.arange(256)
#: Words parted by blank and control-space characters.
SPACED = _alphabet(~((_BYTE == 0x20) | ((_BYTE >= 9) & (_BYTE <= 13))))
#: Words of ASCII letters, digits and any character beyond ASCII.
ALNUM = _alphabet(
    ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A))
    | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U64)
    return _POWERS["up"][:n], _POWERS["down"]


def _hash_slice(data: np.ndarray, bounds: np.ndarray, alphabet: np.ndarray):
    """Hashes, starts and ends of the words of ``data``; no word crosses a bound."""
    n = len(data)
    values = alphabet[data]
    inside = values != 0
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[bounds[bounds < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = bounds - 1
    after[last[(last >= 0) & (last < n)]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(max(n, 1))
    sums = np.zeros(n + 1, U64)
    np.cumsum(values * up, out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start]), start, end


def _pieces(text: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A long text cut between words."""
    at = 0
    while at < len(text):
        to, size = min(at + _SLICE, len(text)), _SLICE
        while to < len(text):
            gaps = np.flatnonzero(alphabet[text[at:to]] == 0)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            size *= 2
            to = min(at + size, len(text))
        yield at, text[at:to]
        at = to


def slices(documents: list[bytes], alphabet: np.ndarray):
    """(first document, bytes, bounds) of about a megabyte; a longer text comes in pieces."""
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    at = 0
    while at < len(documents):
        if lengths[at] > _SLICE:
            for _, piece in _pieces(np.frombuffer(documents[at], np.uint8), alphabet):
                yield at, piece, np.array([0, len(piece)])
            at += 1
            continue
        to = at + 1
        size = lengths[at]
        while to < len(documents) and size + lengths[to] <= _SLICE:
            size += lengths[to]
            to += 1
        bounds = np.concatenate([[0], np.cumsum(lengths[at:to])])
        yield at, np.frombuffer(b"".join(documents[at:to]), np.uint8), bounds
        at = to


def doc_words(documents: list[bytes], alphabet: np.ndarray):
    """For each text: the hashes of its words, their starts and their ends in bytes."""
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    at = 0
    while at < len(documents):
        if lengths[at] > _SLICE:
            text = np.frombuffer(documents[at], np.uint8)
            found = [(h, s + off, e + off) for off, piece in _pieces(text, alphabet)
                     for h, s, e in [_hash_slice(piece, np.zeros(0, np.int64), alphabet)]]
            yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
            at += 1
            continue
        to, size = at + 1, lengths[at]
        while to < len(documents) and size + lengths[to] <= _SLICE:
            size += lengths[to]
            to += 1
        bounds = np.concatenate([[0], np.cumsum(lengths[at:to])])
        data = np.frombuffer(b"".join(documents[at:to]), np.uint8)
        hashes, start, end = _hash_slice(data, bounds, alphabet)
        cuts = np.searchsorted(start, bounds)
        for i in range(to - at):
            own = slice(cuts[i], cuts[i + 1])
            yield hashes[own], start[own] - bounds[i], end[own] - bounds[i]
        at = to


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; of a shorter text, one for all words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U64)
    width = min(size, n)
    total = np.full(n - width + 1, U64((_BASE * (width + 1)) & (2**64 - 1)), U64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * U64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
    return mix(total)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    if len(hashes) < 2:
        return hashes
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]
