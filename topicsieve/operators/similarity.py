"""TF-IDF vectors and cosine similarity to a query, given a fitted vocabulary."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.functions.text import tokens
from topicsieve.operators.vocabulary import Vocabulary, count_rows, kept_words, with_term_counts, with_terms

NEUTRAL = 0.5


def query_weights(spark: SparkSession, query_text: str, vocabulary: Vocabulary) -> dict[int, float]:
    """Normalised TF-IDF weights of the query by vocabulary index.

    The query goes through the same expressions as the documents; its size is
    that of the topic text, not of the corpus.
    """
    query = spark.range(1).select(F.lit(query_text).alias("text"))
    counted = with_term_counts(with_terms(query, stop_words=vocabulary.stop_words))
    position = {term: i for i, term in enumerate(vocabulary.terms)}
    idf = vocabulary.idf_values()
    weights = {
        position[row["term"]]: row["tf"] * idf[position[row["term"]]]
        for row in count_rows(counted).collect()
        if row["term"] in position
    }
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {index: w / norm for index, w in sorted(weights.items())}


def term_counter(
    spark: SparkSession, vocabulary: Vocabulary, terms: str, counts: str
) -> tuple[CountVectorizerModel, list[int]]:
    """Counter over the vocabulary, and the vector index of each of its terms.

    Fitted on the vocabulary itself, one row per term: handing thousands of
    strings to the JVM one call at a time takes seconds.
    """
    rows = vocabulary.frame(spark).select(F.array("term").alias(terms)).coalesce(1)
    model = CountVectorizer(
        vocabSize=len(vocabulary.terms), minDF=1.0, inputCol=terms, outputCol=counts
    ).fit(rows)
    index = {term: i for i, term in enumerate(model.vocabulary)}
    return model, [index[term] for term in vocabulary.terms]


def scaled_counts(
    docs: DataFrame, vocabulary: Vocabulary, grams: str, unit: str
) -> tuple[DataFrame, list[int]]:
    """Add the unit TF-IDF vector of each row's terms, and the place of each term in it.

    Counter, scaling and normaliser work inside the row.
    """
    counter, place = term_counter(docs.sparkSession, vocabulary, grams, "_counts")
    scaling = [0.0] * len(vocabulary.terms)
    for index, value in enumerate(vocabulary.idf_values()):
        scaling[place[index]] = value
    scale = ElementwiseProduct(scalingVec=Vectors.dense(scaling), inputCol="_counts", outputCol="_scaled")
    normalise = Normalizer(p=2.0, inputCol="_scaled", outputCol=unit)
    staged = docs
    for stage in (counter, scale, normalise):
        staged = stage.transform(staged)
    return staged.drop("_counts", "_scaled"), place


@dataclass(frozen=True)
class _QueryCosine:
    """A vocabulary's terms as numbers, to score texts against one query."""

    words: pa.Array  # of which terms are made
    single: np.ndarray  # term that is the word, or -1
    pairs: np.ndarray  # ascending, first word times the number of words plus second one
    pair_terms: np.ndarray
    idf: np.ndarray
    query: np.ndarray  # weight of each term

    @classmethod
    def of(cls, vocabulary: Vocabulary, weights: Mapping[int, float]) -> _QueryCosine:
        parts = [term.split(" ") for term in vocabulary.terms]
        place = {word: i for i, word in enumerate(dict.fromkeys(word for part in parts for word in part))}
        single = np.full(len(place), -1, np.int64)
        pairs = []
        for term, part in enumerate(parts):
            if len(part) == 1:
                single[place[part[0]]] = term
            else:
                pairs.append((place[part[0]] * len(place) + place[part[1]], term))
        ordered = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        query = np.zeros(len(parts))
        query[list(weights)] = list(weights.values())
        words = pa.array(list(place), pa.string())
        return cls(words, single, ordered[:, 0], ordered[:, 1], np.array(vocabulary.idf_values()), query)

    def cosines(self, ids: np.ndarray, known: pa.Array, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """Cosine of each document with the query; 0.0 without a term of the vocabulary."""
        word = pc.fill_null(pc.index_in(known, self.words), -1).to_numpy().astype(np.int64)[ids]
        term = np.where(word >= 0, self.single[word], -1)
        paired = (doc[1:] == doc[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
        key = word[:-1][paired] * len(self.words) + word[1:][paired]
        at = np.searchsorted(self.pairs, key)
        found = np.append(self.pairs, -1)[at] == key
        terms = np.concatenate([term[term >= 0], self.pair_terms[at[found]]])
        docs = np.concatenate([doc[term >= 0], doc[1:][paired][found]])
        cell, count = np.unique(docs * len(self.idf) + terms, return_counts=True)
        docs, terms = np.divmod(cell, len(self.idf))
        weight = count * self.idf[terms]
        norm = np.sqrt(np.bincount(docs, weight * weight, n_docs))
        return np.bincount(docs, weight / norm[docs] * self.query[terms], n_docs)


def _cosine_column(words: Column, queries: Mapping[str, _QueryCosine], stop_words: tuple[str, ...]) -> Column:
    """Struct of the cosines of a text's words with each named query, in Arrow batches."""

    @F.arrow_udf(", ".join(f"`{name}` double" for name in queries))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for listed in batches:
            parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0)] for name in queries}
            for n_docs, *numbered in kept_words(listed, stop_words):
                for name, query in queries.items():
                    parts[name].append(query.cosines(*numbered, n_docs))
            columns = [pa.array(np.concatenate(part)) for part in parts.values()]
            yield pa.StructArray.from_arrays(columns, names=list(parts))

    return score(words)


def with_tfidf_scores(
    docs: DataFrame, query_text: str, vocabularies: Mapping[str, Vocabulary], text: str = "text"
) -> DataFrame:
    """Add, for each named vocabulary, the cosine between each row's text and the query.

    Every step works inside the row (a vocabulary travels with the task, at most
    ``max_features`` terms): no explode, join or shuffle. Texts are split into words
    once for all vocabularies with the same stop words. 0.5 when nothing is fitted or a side is empty; 0.0 without common terms.
    """
    spark = docs.sparkSession
    empty = F.coalesce(F.col(text), F.lit("")) == ""
    known, queries = {}, {}
    for score, vocabulary in vocabularies.items():
        if not vocabulary.is_fitted or not query_text:
            known[score] = F.lit(NEUTRAL)
        elif weights := query_weights(spark, query_text, vocabulary):
            queries.setdefault(vocabulary.stop_words, {})[score] = _QueryCosine.of(vocabulary, weights)
        else:
            known[score] = F.when(empty, F.lit(NEUTRAL)).otherwise(F.lit(0.0))
    staged = docs
    for i, (stop_words, named) in enumerate(queries.items()):
        staged = staged.withColumn(f"_cosines{i}", _cosine_column(tokens(F.col(text)), named, stop_words))
        for score in named:
            cosine = F.col(f"_cosines{i}").getField(score)
            known[score] = F.when(empty, F.lit(NEUTRAL)).otherwise(cosine)
    staged = staged.withColumns({score: known[score] for score in vocabularies})
    return staged.drop(*[f"_cosines{i}" for i in range(len(queries))])


def with_tfidf_score(
    docs: DataFrame, query_text: str, vocabulary: Vocabulary, text: str = "text", score: str = "tfidf"
) -> DataFrame:
    """Add the cosine between each row's text and the query."""
    return with_tfidf_scores(docs, query_text, {score: vocabulary}, text)


def tfidf_vectors(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str = "text") -> DataFrame:
    """Rows of (key, term, weight): L2-normalised sparse vectors.

    Vectors are made inside the row and only then unfolded; their terms come from a
    broadcast of the vocabulary, so nothing is shuffled.
    """
    if not vocabulary.terms:
        return docs.select(key, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    whole = docs.select(key, F.coalesce(text, F.lit("")).alias(text))
    listed = with_terms(whole, text, "_grams", vocabulary.stop_words)
    staged, place = scaled_counts(listed, vocabulary, "_grams", "_unit")
    spark = docs.sparkSession
    terms = spark.createDataFrame(
        pd.DataFrame({"_index": place, "term": vocabulary.terms}), "_index int, term string"
    )
    # the outer form for the reason given at ``count_rows``
    return (
        staged.select(key, F.unwrap_udt("_unit").alias("_unit"))
        .select(key, F.inline_outer(F.arrays_zip("_unit.indices", "_unit.values")))
        .join(F.broadcast(terms), F.col("indices") == F.col("_index"))
        .select(key, "term", F.col("values").alias("weight"))
    )
