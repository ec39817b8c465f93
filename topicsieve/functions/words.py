"""Words of many texts at once, as Arrow arrays and numbers; used inside tasks.

The same words as ``text.tokens`` finds: runs of two or more letters, digits or
underscores in a text that is already lower-cased. Characters are classified by the
bytes of their UTF-8 form, so no text becomes a Python string.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Bytes of text that are split at a time, unless one text has more.
SPLIT_BYTES = 1 << 20

# Bytes of a character by its first one; a byte that begins none counts as a character.
_WIDTH = np.ones(256, np.uint8)
_WIDTH[0xC2:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:0xF5] = 2, 3, 4
_ASCII = np.array([b < 128 and (chr(b).isalnum() or b == ord("_")) for b in range(256)])


@cache
def _is_word() -> np.ndarray:
    """For every code point, whether it is a letter, digit or underscore."""
    table = np.fromiter((unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)), bool, 0x110000)
    table[ord("_")] = True
    return table


def text_slices(texts: pa.Array, size: int = SPLIT_BYTES) -> Iterator[pa.Array]:
    """Texts in slices of at most ``size`` bytes, unless one has more; none of the slices is empty."""
    ends, at = _bounds(texts), 0
    while at < len(texts):
        stop = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield texts.slice(at, stop - at)
        at = stop


def _bounds(texts: pa.Array) -> np.ndarray:
    """Where each text begins in the bytes, and the last one ends."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(1, kind)
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * kind().itemsize)


def _in_words(data: np.ndarray) -> np.ndarray:
    """For every byte, whether it belongs to a word character."""
    inside = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        width = _WIDTH[data[lead]]
        padded = np.append(data, np.zeros(3, np.uint8))
        rest = [padded[lead + i].astype(np.int32) & 0x3F for i in range(4)]
        two = (padded[lead].astype(np.int32) & 0x1F) << 6 | rest[1]
        three = (padded[lead].astype(np.int32) & 0x0F) << 12 | rest[1] << 6 | rest[2]
        four = (padded[lead].astype(np.int32) & 0x07) << 18 | rest[1] << 12 | rest[2] << 6 | rest[3]
        point = np.select([width == 2, width == 3, width == 4], [two, three, four], 0)
        known = _is_word()[np.minimum(point, 0x10FFFF)]
        for i in range(4):
            places = (lead + i)[(width > i) & known]
            inside[places[places < len(data)]] = True
    return inside


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of lower-cased texts, none of them null, in order.

    Returns each word as a number, the words by number (some of these occur in no
    text), and the row of each word.
    """
    bounds = _bounds(texts).astype(np.int64)
    low, high = int(bounds[0]), int(bounds[-1])
    if low == high:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8, high - low, low)
    inside = _in_words(data)
    # words neither begin before a text nor go on after it
    begins, stops = np.append(True, ~inside[:-1]), np.append(~inside[1:], True)
    filled = bounds[:-1][bounds[1:] > bounds[:-1]] - low
    begins[filled] = True
    stops[filled[1:] - 1] = True
    starts, ends = np.flatnonzero(inside & begins), np.flatnonzero(inside & stops) + 1
    several = ends - starts > _WIDTH[data[starts]]
    starts, ends = starts[several], ends[several]
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, bounds - low)))
    if len(starts) == 0:
        return np.zeros(0, np.int64), pa.array([], pa.string()), row
    # words and what is between them by turns, over the bytes as they are
    places = np.stack([starts, ends], 1).ravel().astype(np.int32)
    whole = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
    encoded = whole.dictionary_encode()
    return encoded.indices.to_numpy()[::2].astype(np.int64), encoded.dictionary, row
