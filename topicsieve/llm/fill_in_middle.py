"""Fill-in-middle transformation of whole texts, by a sparse index of their exceptions.

A text is cut twice at token boundaries, or at code points, and its three spans are
written in another order between markers. Cuts are found in the UTF-8 bytes; they are
told in code points through an ``Exceptions`` index, which records multibyte characters
only: their positions and the bytes they have beyond one. A binary search in it converts
a cut; where it is empty, in ASCII spans, byte and code point are the same number. So an
ASCII text costs no index at all, however long it is.

What is drawn depends on the seed and the identifier alone, so every run, retry and
partitioning gives the same rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import slices, text_or_empty

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Recipe:
    """How texts are cut and written.

    ``unit`` is ``"token"`` (white space and the word after it, or white space at the
    end) or ``"char"`` (code points). ``plain_from`` is the share of hundred below which
    a text is transformed, ``spm_below`` the share of these that begin with the suffix.
    No marker may be empty, begin as one ends, or be part of another.
    """

    seed: int = 42
    unit: str = "token"
    plain_from: int = 50
    spm_below: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        if self.unit not in ("token", "char"):
            raise ValueError("unit must be 'token' or 'char'")
        for a in self.markers:
            for b in self.markers:
                overlaps = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b))))
                if not a or overlaps or (a is not b and a in b):
                    raise ValueError("markers must be told apart wherever they stand")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Exceptions:
    """The multibyte characters of UTF-8 bytes: where they begin, and their excess bytes."""

    def __init__(self, raw: np.ndarray):
        self.bytes = np.flatnonzero(raw >= 0xC0)  # first bytes of characters of several
        lead = raw[self.bytes]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        #: excess[i]: bytes beyond one that the first i of these characters have
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.chars = self.bytes - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte positions that stand between characters."""
        return cuts - self.excess[np.searchsorted(self.bytes, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before code points."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]


def token_ends(raw: np.ndarray) -> np.ndarray:
    """Byte positions at which tokens end.

    A token is white space (space, code points 9 to 13) and the word that follows it;
    white space at the end of the text is one of its own.
    """
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(raw)) if len(raw) else ends


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32, from the digest of seed and identifier."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(named.encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


@dataclass(frozen=True)
class Transformed:
    """One text's result; cuts are of the text as it was, and None where it stays plain."""

    form: str
    units: int
    text: str
    prefix_chars: int | None = None
    middle_chars: int | None = None
    prefix_bytes: int | None = None
    middle_bytes: int | None = None


def transform(text: str, doc_id: int | None, recipe: Recipe = Recipe()) -> Transformed:
    """``text`` in the form that is drawn for ``doc_id``."""
    encoded = text.encode()
    raw = np.frombuffer(encoded, np.uint8)
    index = Exceptions(raw)
    ends = token_ends(raw) if recipe.unit == "token" else None
    units = len(ends) if ends is not None else len(raw) - int(index.excess[-1])
    first, second, plain, order = draws(recipe.seed, doc_id)
    if not text or any(m in text for m in recipe.markers) or plain % 100 >= recipe.plain_from:
        return Transformed(PLAIN, units, text)
    drawn = np.sort(np.array([first, second], np.int64) % (units + 1))
    if ends is not None:
        bytes_at = np.concatenate([[0], ends])[drawn]
        chars_at = index.to_chars(bytes_at)
    else:
        chars_at = drawn
        bytes_at = index.to_bytes(chars_at)
    a, b = map(int, bytes_at)
    before, between, after = (s.decode() for s in (encoded[:a], encoded[a:b], encoded[b:]))
    if order % 100 < recipe.spm_below:
        form = SPM
        out = (recipe.suffix, after, recipe.prefix, before, recipe.middle, between)
    else:
        form = PSM
        out = (recipe.prefix, before, recipe.suffix, after, recipe.middle, between)
    chars = [int(x) for x in chars_at]
    return Transformed(form, units, "".join(out), chars[0], chars[1] - chars[0], a, b - a)


def restore(text: str, form: str, recipe: Recipe = Recipe()) -> str:
    """The text that was transformed, from what became of it and the form."""
    if form == PLAIN:
        return text
    one, other = recipe.prefix, recipe.suffix
    if form == SPM:
        one, other = other, one
    # markers stand in no span, nor across the border of a span and a marker
    head, _, middle = text.partition(recipe.middle)
    left, _, right = head[len(one) :].partition(other)
    return left + middle + right if form == PSM else right + middle + left


FIELDS = "form string, n_units bigint, text string, prefix_chars bigint, middle_chars bigint, prefix_bytes bigint, middle_bytes bigint"


def fill_in_middle(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``doc_id`` and the transformed text of every row of ``docs``, with its cuts.

    Returns ``doc_id``, ``form`` (plain, psm or spm), ``n_units``, ``text`` (as it is to
    be trained on) and the lengths of prefix and middle in code points and bytes, null
    where the form is plain. Null and empty texts are empty and plain, as are, whole,
    texts that hold a marker. Texts of any length are cut whole, a few megabytes of them
    at a time. Repeated rows come out alike; a null identifier is drawn for as an empty
    one. Other columns are not looked at; an empty table gives one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch["doc_id"].to_pylist()
            done = [transform(t.as_py(), d, recipe) for d, t in zip(ids, batch["text"], strict=True)]
            cuts = ("prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes")
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "form": pa.array([x.form for x in done], pa.string()),
                    "n_units": pa.array([x.units for x in done], pa.int64()),
                    "text": pa.array([x.text for x in done], pa.string()),
                }
                | {c: pa.array([getattr(x, c) for x in done], pa.int64()) for c in cuts}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", text_or_empty().alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, {FIELDS}")


def restored(text: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The exact text before the transformation, from output and form, in column functions."""

    def halves(whole: Column, marker: str) -> Column:
        return F.split(whole, re.escape(marker), 2)

    def spans(one: str, other: str) -> tuple[Column, Column, Column]:
        head, middle = (halves(text, recipe.middle)[i] for i in (0, 1))
        both = F.substring(head, len(one) + 1, F.length(head))
        return halves(both, other)[0], halves(both, other)[1], middle

    before, after, middle = spans(recipe.prefix, recipe.suffix)
    psm = F.concat(before, middle, after)
    after, before, middle = spans(recipe.suffix, recipe.prefix)
    spm = F.concat(before, middle, after)
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(text)
