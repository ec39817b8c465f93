"""Word n-grams of a text as a set of 64-bit hashes, computed on whole arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

WORDS = 5
#: Bytes of text hashed at a time.
HASHED = 1 << 20


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        factors = np.full(n, x, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(20_250_101).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


def spread_bits(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit moves many others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order; words end at space and code points 9 to 13."""
    raw = np.frombuffer(text, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(1 << int(max(len(raw), 1) - 1).bit_length())
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_letters()[raw] * up[: len(raw)], out=sums[1:])
    return spread_bits((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _chunks(text: bytes) -> Iterator[bytes]:
    """``text`` in parts that end between words, of about ``HASHED`` bytes."""
    start = 0
    while len(text) - start > HASHED:
        end = start + HASHED
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def tokens(text: str, n_words: int = WORDS) -> np.ndarray:
    """The set of a text's word n-grams, as sorted 64-bit hashes.

    A-Z count as lower case. With fewer than ``n_words``, all words make one; without
    words the set is empty.
    """
    lowered = text.encode().lower()  # of bytes: A-Z and nothing else
    words = np.concatenate([word_hashes(c) for c in _chunks(lowered)])
    width = min(n_words, len(words))
    if width == 0:
        return words
    count = len(words) - width + 1
    rolled = np.full(count, width, np.uint64)
    for i in range(width):
        rolled = rolled * np.uint64(0xA24BAED4963EE407) + words[i : i + count]
    found = np.sort(spread_bits(rolled))
    return found[np.concatenate([[True], found[1:] != found[:-1]])]
