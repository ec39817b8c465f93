"""TF-IDF vocabulary: term counts, document frequencies, pruning and fitting.

Terms are counted where the texts are (a slice of documents at a time, in Arrow
arrays of their bytes), so the only shuffle of a fit is the one by term, and that one is
pre-aggregated on the map side: a term that occurs in every document costs one
row per task.

A fit needs few of the terms. Its first pass adds up all occurrences in the cells of a
sketch of fixed size, which bound every term's frequency from above; its second pass counts
the terms of the cells that may hold a term of the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.functions.text import (
    DEFAULT_STOP_WORDS,
    drop_stop_words,
    is_blank,
    ngrams_1_2,
    tokens,
)
from topicsieve.functions.words import split_words, text_slices
from topicsieve.session import scratch_path

# Pruning limits of the vocabulary.
MAX_DF = 0.95
MAX_FEATURES = 20_000

STATISTICS = "term string, df bigint, cf bigint"

# Counts documents: real terms have at least two characters, so '' is free.
DOCUMENT_MARK = ""

# Bytes of text, and tokens of these, that are counted at a time, unless one document has more.
COUNTED_BYTES = 4 << 20
COUNTED_TOKENS = 1_000_000

# Cells of a sketch, and those that a row of it holds.
SKETCH_CELLS = 1 << 20
BLOCK_CELLS = 1 << 12
# Of so many terms one is counted by itself with the sketch, chosen by its hash.
COUNTED_SHARE = 32
# How many more terms than the vocabulary takes are counted, by estimate.
MARGIN = 1.25

SKETCH = f"{STATISTICS}, block int, cells binary"

# Of hashes of terms, which ones are counted.
Chosen = Callable[[np.ndarray], np.ndarray]


def with_terms(
    docs: DataFrame,
    text: str = "text",
    terms: str = "terms",
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
) -> DataFrame:
    """Add the array of unigrams and bigrams of each row."""
    return (
        docs.withColumn("_tokens", drop_stop_words(tokens(F.col(text)), stop_words))
        .withColumn(terms, ngrams_1_2(F.col("_tokens")))
        .drop("_tokens")
    )


def _shifted(ordered: str) -> Column:
    """The array moved right by one, an empty term in front."""
    rest = F.greatest(F.size(ordered) - 1, F.lit(0))
    return F.concat(F.array(F.lit("")), F.slice(ordered, F.lit(1), rest))


def with_term_counts(docs: DataFrame, terms: str = "terms", counts: str = "counts") -> DataFrame:
    """Add an array of (term, tf) per row from its array of terms.

    Runs of equal terms in the sorted array are measured by the distance between
    their first positions.
    """
    changed = F.zip_with("_sorted", _shifted("_sorted"), lambda term, prev: F.when(term != prev, term))
    heads = F.filter(
        F.transform(changed, lambda term, pos: F.struct(term.alias("term"), pos.alias("pos"))),
        lambda h: h["term"].isNotNull(),
    )
    later = F.slice("_heads", F.lit(2), F.greatest(F.size("_heads") - 1, F.lit(0)))
    ends = F.concat(F.transform(later, lambda h: h["pos"]), F.array(F.col("_size")))
    runs = F.zip_with(
        "_heads",
        ends,
        lambda h, end: F.when(
            h.isNotNull(), F.struct(h["term"].alias("term"), (end - h["pos"]).alias("tf"))
        ),
    )
    return (
        docs.withColumn("_sorted", F.sort_array(terms))
        .withColumn("_heads", heads)
        .withColumn("_size", F.size("_sorted"))
        .withColumn(counts, F.filter(runs, lambda r: r.isNotNull()))
        .drop("_sorted", "_heads", "_size")
    )


def count_rows(counted: DataFrame, *keep: str, counts: str = "counts") -> DataFrame:
    """One row per (term, tf) of each row's counts.

    The outer form matters: a plain explode makes the optimizer derive a filter
    on the array's size and push it through the projections that build the
    array, which would then be evaluated many times over.
    """
    return counted.select(*keep, F.inline_outer(counts)).where(F.col("term").isNotNull())


def term_frequency(
    docs: DataFrame,
    key: str,
    text: str = "text",
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
) -> DataFrame:
    """Rows of (key, term, tf); no shuffle."""
    counted = with_term_counts(with_terms(docs.select(key, text), text, stop_words=stop_words))
    return count_rows(counted, key).withColumn("tf", F.col("tf").cast("long"))


def term_statistics(
    docs: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
) -> DataFrame:
    """Rows of (term, df, cf) over the non-blank documents.

    The row of the empty term counts the documents themselves, so one pass over
    the texts yields everything a fit needs. Statistics of disjoint batches can
    be added up, see ``merge_statistics``.
    """
    return _statistics(docs, text, stop_words)


def _statistics(docs: DataFrame, text: str, stop_words: Sequence[str], chosen: Chosen | None = None) -> DataFrame:
    """``term_statistics``, of the chosen terms alone if they are given."""
    without = tuple(stop_words)
    counted = _lowered(docs, text).mapInArrow(
        lambda batches: _counted_terms(_listed_words(batches, without), chosen), STATISTICS
    )
    return _added(counted)


def _lowered(docs: DataFrame, text: str) -> DataFrame:
    return docs.where(~is_blank(F.col(text))).select(F.lower(text).alias("_text"))


def _added(counted: DataFrame) -> DataFrame:
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _without(
    stop_words: Sequence[str], ids: np.ndarray, known: pa.Array, doc: np.ndarray
) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of words, the words by number and the document of each, without the stop words."""
    if not stop_words:
        return ids, known, doc
    wanted = ~pc.is_in(known, pa.array(stop_words, known.type)).to_numpy(zero_copy_only=False)
    kept = wanted[ids]
    return ids[kept], known, doc[kept]


def _numbered(listed: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of lists as numbers, the words by number, and the list of each."""
    words = listed.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
    return words.indices.to_numpy().astype(np.int64), words.dictionary, doc


def _list_slices(listed: pa.ListArray) -> Iterator[pa.ListArray]:
    """Lists of words in slices of at most ``COUNTED_TOKENS``, unless one list has more."""
    ends, at = listed.offsets.to_numpy(), 0
    while at < len(listed):
        stop = int(np.searchsorted(ends, ends[at] + COUNTED_TOKENS, "right")) - 1
        stop = min(max(stop, at + 1), len(listed))
        yield listed.slice(at, stop - at)
        at = stop


def kept_words(
    listed: pa.ListArray, stop_words: Sequence[str]
) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """Slices of word lists without stop words: how many lists, then as ``_numbered``."""
    for part in _list_slices(listed):
        yield len(part), *_without(stop_words, *_numbered(part))


def _listed_words(batches: Iterator[pa.RecordBatch], stop_words: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Lower-cased texts as lists of their words, which stay numbers of a dictionary."""
    for batch in batches:
        for texts in text_slices(batch.column(0), COUNTED_BYTES):
            ids, known, doc = _without(stop_words, *split_words(texts))
            ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            words = pa.DictionaryArray.from_arrays(pa.array(ids.astype(np.int32)), known)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), words)], names=["_words"])


def _counted_terms(
    batches: Iterator[pa.RecordBatch], chosen: Chosen | None = None, cells: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Rows of (term, df, cf) from word arrays, one for each (chosen) term of a slice of documents.

    The occurrences of all terms are added to the ``cells`` of their hashes, if these are given.
    """
    for batch in batches:
        for listed in _list_slices(batch.column(0)):
            counts = list(_slice_counts(listed, chosen, cells))
            yield pa.RecordBatch.from_arrays(counts, names=["term", "df", "cf"])


def _slice_counts(
    listed: pa.ListArray, chosen: Chosen | None, cells: np.ndarray | None
) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Terms with df and cf in a few documents; the first term stands for the documents."""
    n_docs = len(listed)
    ids, known, doc = _numbered(listed)
    paired = doc[1:] == doc[:-1]
    pairs, pair_doc = ids[:-1][paired] * len(known) + ids[1:][paired], doc[1:][paired]
    if chosen:
        words = _hashes(known)
        both = _pair_hashes(words[ids[:-1][paired]], words[ids[1:][paired]])
        if cells is not None:
            for hashes in (words[ids], both):
                cells += np.bincount(_cell(hashes), minlength=len(cells))
        one, two = chosen(words)[ids], chosen(both)
        ids, doc, pairs, pair_doc = ids[one], doc[one], pairs[two], pair_doc[two]
    single, df, cf = _runs(ids, doc, n_docs)
    double, pair_df, pair_cf = _runs(pairs, pair_doc, n_docs)
    left, right = (known.take(pa.array(place)) for place in np.divmod(double, max(len(known), 1)))
    joined = pc.binary_join_element_wise(left, right, pa.scalar(" ", known.type))
    mark = pa.array([DOCUMENT_MARK], known.type)
    return (
        pa.concat_arrays([mark, known.take(pa.array(single)), joined]),
        pa.array(np.concatenate([[n_docs], df, pair_df])),
        pa.array(np.concatenate([[n_docs], cf, pair_cf])),
    )


def _runs(terms: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different terms, in how many documents each occurs, and how often."""
    terms, doc = np.divmod(np.sort(terms * n_docs + doc), n_docs)
    new = np.append(True, terms[1:] != terms[:-1])[: len(terms)]
    starts = np.flatnonzero(new)
    # a term counts once for each document that has it
    first = new | np.append(True, doc[1:] != doc[:-1])[: len(terms)]
    df = np.diff(np.append(np.flatnonzero(first).searchsorted(starts), first.sum()))
    return terms[starts], df, np.diff(np.append(starts, len(terms)))


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every task."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def _pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (right >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(24) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)


def _in_share(hashes: np.ndarray) -> np.ndarray:
    """One of ``COUNTED_SHARE`` terms, whatever its cell."""
    return (hashes >> np.uint64(48)) % np.uint64(COUNTED_SHARE) == 0


def _sketched(batches: Iterator[pa.RecordBatch], stop_words: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a part of a sketch: terms of the share as in statistics, then blocks of its cells."""
    cells = np.zeros(SKETCH_CELLS, np.int64)
    for counts in _counted_terms(_listed_words(batches, stop_words), _in_share, cells):
        none = [pa.nulls(len(counts), pa.int32()), pa.nulls(len(counts), pa.binary())]
        terms = counts.column(0).cast(pa.string())
        yield pa.RecordBatch.from_arrays([terms, *counts.columns[1:], *none], names=_SKETCH_NAMES)
    blocks = cells.reshape(-1, BLOCK_CELLS)
    filled = np.flatnonzero(blocks.any(1)).astype(np.int32)
    none = [pa.nulls(len(filled), kind) for kind in (pa.string(), pa.int64(), pa.int64())]
    held = pa.array([blocks[place].tobytes() for place in filled], pa.binary())
    yield pa.RecordBatch.from_arrays([*none, pa.array(filled), held], names=_SKETCH_NAMES)


_SKETCH_NAMES = ["term", "df", "cf", "block", "cells"]


def _frequent_cells(sketch: DataFrame, least: int) -> np.ndarray:
    """For each cell, whether its terms occur ``least`` times together; one bit a cell reaches the driver."""

    def summed(parts: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_CELLS, np.int64)
        for cells in parts.column("cells"):
            total += np.frombuffer(cells.as_buffer(), np.int64)
        bits = pa.array([np.packbits(total >= least).tobytes()], pa.binary())
        return pa.table({"block": parts.column("block")[:1].cast(pa.int32()), "bits": bits})

    blocks = sketch.where("block IS NOT NULL").select("block", "cells").groupBy("block")
    frequent = np.zeros((SKETCH_CELLS // BLOCK_CELLS, BLOCK_CELLS), bool)
    for row in blocks.applyInArrow(summed, "block int, bits binary").collect():
        frequent[row["block"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8))
    return frequent.ravel()


def merge_statistics(*parts: DataFrame) -> DataFrame:
    """Statistics of the union of disjoint document sets, less those taken back.

    Terms that no document is left with are dropped.
    """
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    summed = merged.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return summed.where("df != 0 OR cf != 0")


def retracted(statistics: DataFrame) -> DataFrame:
    """Statistics that take the counts of documents back when they are merged."""
    return statistics.select("term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))


def updated_statistics(
    statistics: DataFrame,
    before: DataFrame,
    after: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
) -> DataFrame:
    """Statistics after documents have changed, without reading the others.

    ``before`` has the texts that changed or went away as they were, ``after`` the texts
    that changed or came as they are. Equals the statistics of the whole corpus now.
    """
    old = term_statistics(before, text, stop_words)
    return merge_statistics(statistics, retracted(old), term_statistics(after, text, stop_words))


def document_frequency(statistics: DataFrame) -> DataFrame:
    return statistics.where(F.col("term") != DOCUMENT_MARK)


def corpus_size(statistics: DataFrame) -> DataFrame:
    """One row: the number of non-blank documents, which the statistics hold."""
    # the filter reaches the scan, so no other term is read or added up
    marks = statistics.where(F.col("term") == DOCUMENT_MARK)
    return marks.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n_docs"))


def stored_statistics(statistics: DataFrame) -> DataFrame:
    """Statistics written to the shared scratch folder, so that they can be read often."""
    path = scratch_path(statistics.sparkSession, "statistics")
    statistics.write.parquet(path)
    return statistics.sparkSession.read.parquet(path)


def prune_max_df(frequency: DataFrame, n_docs: Column, max_df: float = MAX_DF) -> DataFrame:
    """Drop terms that occur in more than ``max_df`` of the documents."""
    return frequency.where(F.col("df") <= F.lit(float(max_df)) * n_docs)


def limit_vocabulary(frequency: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms of the corpus; equal counts in term order."""
    return frequency.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)


def idf(n_docs: Column, df: Column) -> Column:
    """Smoothed inverse document frequency, plus one."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary; at most ``max_features`` terms, so it fits a driver."""

    n_docs: int
    terms: tuple[str, ...] = ()
    df: tuple[int, ...] = ()
    cf: tuple[int, ...] = ()
    stop_words: tuple[str, ...] = field(default=DEFAULT_STOP_WORDS, repr=False)

    @property
    def is_fitted(self) -> bool:
        return self.n_docs >= 2 and len(self.terms) > 0

    def idf_values(self) -> list[float]:
        return [math.log((1.0 + self.n_docs) / (1.0 + d)) + 1.0 for d in self.df]

    def frame(self, spark: SparkSession) -> DataFrame:
        """Rows of (idx, term, df, cf, idf, n_docs); small enough to broadcast."""
        columns = {"idx": range(len(self.terms)), "term": self.terms, "df": self.df, "cf": self.cf}
        base = spark.createDataFrame(pd.DataFrame(columns), "idx int, term string, df long, cf long")
        return base.withColumn("idf", idf(F.lit(float(self.n_docs)), F.col("df"))).withColumn(
            "n_docs", F.lit(self.n_docs).cast("long")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        frame = self.frame(spark).drop("idf", "n_docs")
        marked = frame.unionByName(
            spark.createDataFrame(
                [(-1, DOCUMENT_MARK, self.n_docs, 0)], "idx int, term string, df long, cf long"
            )
        )
        marked.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, stop_words: Sequence[str] = DEFAULT_STOP_WORDS) -> "Vocabulary":
        rows = spark.read.parquet(path).orderBy("idx").collect()
        mark, terms = rows[0], rows[1:]
        return cls(
            n_docs=mark["df"],
            terms=tuple(r["term"] for r in terms),
            df=tuple(r["df"] for r in terms),
            cf=tuple(r["cf"] for r in terms),
            stop_words=tuple(stop_words),
        )


def vocabulary_from_statistics(
    statistics: DataFrame,
    max_df: float = MAX_DF,
    max_features: int = MAX_FEATURES,
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
    is_stored: bool = False,
) -> Vocabulary:
    """Prune and limit term statistics; at most ``max_features`` rows reach the driver.

    The statistics are read twice: for the number of documents, and for the terms that
    pruning leaves. They are stored first unless they are a stored table (``is_stored``).
    """
    stored = statistics if is_stored else stored_statistics(statistics)
    n_docs = int(corpus_size(stored).first()["n_docs"])
    if n_docs < 2:
        return Vocabulary(n_docs, stop_words=tuple(stop_words))
    pruned = prune_max_df(document_frequency(stored), F.lit(n_docs), max_df)
    kept = limit_vocabulary(pruned, max_features).collect()
    return Vocabulary(
        n_docs=n_docs,
        terms=tuple(r["term"] for r in kept),
        df=tuple(r["df"] for r in kept),
        cf=tuple(r["cf"] for r in kept),
        stop_words=tuple(stop_words),
    )


def fit(
    docs: DataFrame,
    text: str = "text",
    max_df: float = MAX_DF,
    max_features: int = MAX_FEATURES,
    stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
) -> Vocabulary:
    """Fit on a corpus: two passes over its texts, which shuffle few of the terms.

    The same vocabulary as ``vocabulary_from_statistics`` gives for all terms. How often the
    last term of the vocabulary occurs is estimated from a share of the terms. Terms in cells of
    fewer occurrences cannot reach that and are not counted; all others are. If fewer terms than
    the vocabulary takes turn out to occur so often, the estimate is halved and tried again.

    Fewer than two non-blank documents, or nothing left after pruning, gives a
    vocabulary that is not fitted; scores then stay neutral.
    """
    without = tuple(stop_words)
    parts = _lowered(docs, text).mapInArrow(lambda batches: _sketched(batches, without), SKETCH)
    sketch = stored_statistics(parts)
    n_docs = int(corpus_size(sketch).first()["n_docs"])
    if n_docs < 2:
        return Vocabulary(n_docs, stop_words=without)
    least = _least_count(sketch, n_docs, max_df, max_features)
    while True:
        counted = _statistics(docs, text, without, _in_cells(_frequent_cells(sketch, least)) if least > 1 else None)
        pruned = prune_max_df(document_frequency(counted), F.lit(n_docs), max_df)
        kept = limit_vocabulary(pruned.where(F.col("cf") >= least), max_features).collect()
        if least == 1 or len(kept) == max_features:
            break
        least = max(least // 2, 1)
    return Vocabulary(
        n_docs=n_docs,
        terms=tuple(r["term"] for r in kept),
        df=tuple(r["df"] for r in kept),
        cf=tuple(r["cf"] for r in kept),
        stop_words=without,
    )


def _in_cells(frequent: np.ndarray) -> Chosen:
    packed = np.packbits(frequent)
    return lambda hashes: np.unpackbits(packed).view(bool)[_cell(hashes)]


def _least_count(sketch: DataFrame, n_docs: int, max_df: float, max_features: int) -> int:
    """About how often the last term of the vocabulary occurs, rather too low; 1 if it takes all terms."""
    rank = math.ceil(max_features * MARGIN / COUNTED_SHARE) + 1
    shared = _added(sketch.where("block IS NULL").select("term", "df", "cf"))
    pruned = prune_max_df(document_frequency(shared), F.lit(n_docs), max_df)
    known = pruned.select("cf").orderBy(F.desc("cf")).limit(rank).collect()
    return known[-1]["cf"] if len(known) == rank else 1
