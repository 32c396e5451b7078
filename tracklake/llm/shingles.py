"""Words and shingles of whole texts as 64-bit hashes, with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at a time; a block ends at white space, so a word is never cut.
BLOCK = 1 << 20
_SEED = 0x5EED
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.random.default_rng(_SEED).integers(1, 2**64, 256, dtype=np.uint64)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            white = np.flatnonzero(_WHITE[data[end : end + BLOCK]])
            if len(white):
                end += int(white[0])
                break
            end = min(end + BLOCK, len(data))
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A hash per word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z lower-cased."""
    found = []
    for block in _blocks(np.frombuffer(data, np.uint8)):
        power, inverse = _powers_to(len(block) + 1)
        white = np.ones(len(block) + 2, np.int8)
        white[1:-1] = _WHITE[block]
        edges = np.flatnonzero(white[1:] != white[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_CODES[block] * power[: len(block)], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(data: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; of fewer words, of all of them."""
    words = word_hashes(data or b"")
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + words[i : i + n])
    return np.unique(out)
