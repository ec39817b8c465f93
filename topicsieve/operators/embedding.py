"""Text embedding as a batch job with a pluggable model."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.functions.words import split_words, text_slices
from topicsieve.sources.commits import Marks
from topicsieve.topic import Topic

# An embedder is a picklable, hashable factory. Calling it loads the model and
# returns the function that encodes a list of texts.
Encode = Callable[[Sequence[str]], Sequence[Sequence[float]]]
Embedder = Callable[[], Encode]

_loaded: dict[Embedder, Encode] = {}

# Words whose hashes a worker keeps.
KEPT_WORDS = 200_000
# Characters of text that are handed to the model at a time, unless one text has more.
EMBEDDED_CHARS = 4_000_000
# Bytes of text whose different words are looked up at a time.
HASHED_BYTES = 4 << 20


def _encoder(embedder: Embedder) -> Encode:
    """Load a model once per Python worker; workers are reused between tasks."""
    if embedder not in _loaded:
        _loaded[embedder] = embedder()
    return _loaded[embedder]


class _Slots(dict):
    """Twice the place of a word's component, and one more if it counts up; a few words are kept."""

    def __init__(self, dimensions: int) -> None:
        super().__init__()
        self.dimensions = dimensions

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        digest = hashlib.md5(word.encode(), usedforsecurity=False).digest()
        found = self[word] = 2 * (int.from_bytes(digest[:4]) % self.dimensions) + (digest[4] < 128)
        return found


@dataclass(frozen=True)
class HashingEmbedder:
    """Signed hashing projection of word counts to unit length; deterministic.

    Stands in for a neural model, whose weights are not part of this package.
    """

    dimensions: int = 64

    def __call__(self) -> Encode:
        slots = _Slots(self.dimensions)
        places = 2 * self.dimensions

        def rows(texts: pa.Array) -> np.ndarray:
            ids, known, doc = split_words(texts)
            seen = np.flatnonzero(np.bincount(ids, minlength=len(known)))
            slot = np.zeros(len(known), np.int64)
            slot[seen] = [slots[word] for word in known.take(pa.array(seen)).to_pylist()]
            counts = np.bincount(doc * places + slot[ids], minlength=places * len(texts)).reshape(-1, places)
            row = (counts[:, 1::2] - counts[:, ::2]).astype(float)
            norm = np.sqrt((row * row).sum(1))
            row[norm == 0.0, 0] = norm[norm == 0.0] = 1.0
            return row / norm[:, None]

        def encode(texts: Sequence[str]) -> list[list[float]]:
            lowered = pa.array([text.lower() for text in texts], pa.large_string())
            return [vector for part in text_slices(lowered, HASHED_BYTES) for vector in rows(part).astype("float32").tolist()]

        return encode


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of bounded size, whatever its texts' lengths; an empty batch is one part."""
    ends, at = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)), 0
    while at < len(texts) or at == 0:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + EMBEDDED_CHARS, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def embed_attempt(text: Column, embedder: Embedder) -> Column:
    """struct(embedding, error) of a text column, in Arrow batches.

    Null texts are skipped, blank ones embedded as one space. If a batch fails
    its texts are tried one by one, so an error stays with its row.
    """

    @F.arrow_udf("embedding array<float>, error string")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(embedder)

        def one(text: str) -> tuple:
            try:
                return list(encode([text])[0]), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"[:200]

        def attempts(texts: pa.Array) -> pa.Array:
            given = texts.to_pylist()
            chosen = [t or " " for t in given if t is not None]
            try:
                results = iter([(list(v), None) for v in encode(chosen)] if chosen else [])
            except Exception:
                results = iter([one(t) for t in chosen])
            rows = [(None, None) if t is None else next(results) for t in given]
            vectors = pa.array([vector for vector, _ in rows], pa.list_(pa.field("element", pa.float32())))
            errors = pa.array([error for _, error in rows], pa.string())
            return pa.StructArray.from_arrays([vectors, errors], names=["embedding", "error"])

        for texts in batches:
            yield pa.concat_arrays([attempts(part) for part in _parts(texts)])

    return embed(text)


def embed_column(text: Column, embedder: Embedder) -> Column:
    """Embedding of a text column; a failure of the model fails the job."""
    attempt = embed_attempt(text, embedder)
    return F.when(attempt["error"].isNotNull(), F.raise_error(attempt["error"]).cast("array<float>")).otherwise(
        attempt["embedding"]
    )


def embed_documents(df: DataFrame, embedder: Embedder, text: str = "text", out: str = "embedding") -> DataFrame:
    return df.withColumn(out, embed_column(F.coalesce(F.col(text), F.lit("")), embedder))


def embed_where(df: DataFrame, needed: Column, embedder: Embedder, text: str = "text") -> DataFrame:
    """Recompute ``embedding`` where ``needed``; other rows keep theirs.

    One pass: rows that need nothing send a null to the model and are skipped.
    """
    fresh = embed_column(F.when(needed, F.coalesce(F.col(text), F.lit(""))), embedder)
    return (
        df.withColumn("_fresh", fresh)
        .withColumn("embedding", F.coalesce("_fresh", "embedding"))
        .drop("_fresh")
    )


def backfill_embeddings(df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    """Embed rows that have a text but no vector; reuse all stored vectors."""
    missing = F.col("embedding").isNull() | (F.size("embedding") == 0)
    return embed_where(df, missing & (F.coalesce(F.col(text), F.lit("")) != ""), embedder, text)


def text_digest(text: Column) -> Column:
    """What a text's vector is kept under; blank and null texts embed as one space."""
    said = F.coalesce(F.nullif(text, F.lit("")), F.lit(" "))
    return F.sha2(said.cast("binary"), 256)


@dataclass(frozen=True)
class VectorStore:
    """Vectors of one embedder, kept by the digest of their text below a folder.

    Each run appends what it had to embed and marks it; vectors without a mark are not
    read. Another embedder needs another folder.
    """

    root: str

    def _read(self, spark: SparkSession) -> DataFrame:
        schema = "text_digest string, embedding array<float>, error string"
        runs = list(Marks(f"{self.root}/runs").all(spark))
        if not runs:
            return spark.createDataFrame([], schema)
        stored = spark.read.schema(schema).parquet(*[f"{self.root}/vectors/{r}" for r in runs])
        return stored.where("error IS NULL")

    def embed(self, df: DataFrame, embedder: Embedder, needed: Column, text: str = "text") -> DataFrame:
        """``embedding`` of the rows that need one; other rows keep theirs.

        Each different text that the store does not hold is given to the model once,
        however many rows have it. Rows whose text cannot be embedded are left as they
        were. Texts are reduced to their digests before rows are joined with vectors.
        """
        spark = df.sparkSession
        keyed = df.withColumn("_digest", F.when(needed, text_digest(F.col(text))))
        wanted = keyed.where(F.col("_digest").isNotNull())
        texts = wanted.groupBy(F.col("_digest").alias("text_digest")).agg(F.first(text).alias("text"))
        missing = texts.join(self._read(spark).select("text_digest"), "text_digest", "left_anti")
        attempt = embed_attempt(F.coalesce("text", F.lit("")), embedder)
        run = uuid.uuid4().hex
        made = missing.withColumn("_attempt", attempt).select("text_digest", "_attempt.*")
        # errors too: a filter here would have the model called twice
        made.write.parquet(f"{self.root}/vectors/{run}")
        Marks(f"{self.root}/runs").put(spark, run)
        # rows that need nothing get keys of their own, or they would meet under null
        found = self._read(spark).select(F.col("text_digest").alias("_digest"), F.col("embedding").alias("_found"))
        spread = F.coalesce("_digest", F.concat(F.lit("none:"), F.uuid()))
        joined = keyed.withColumn("_digest", spread).join(found, "_digest", "left")
        return joined.withColumn("embedding", F.coalesce("_found", "embedding")).select(*df.columns)

    def backfill(self, df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
        """``backfill_embeddings`` by way of the store."""
        missing = F.col("embedding").isNull() | (F.size("embedding") == 0)
        return self.embed(df, embedder, missing & (F.coalesce(F.col(text), F.lit("")) != ""), text)


def embed_text(spark: SparkSession, text: str, embedder: Embedder) -> tuple[float, ...]:
    """Vector of one text, computed by the same job as a corpus."""
    one = spark.createDataFrame([(text,)], "text string")
    return tuple(embed_documents(one, embedder).first()["embedding"])


def refresh_query_vector(spark: SparkSession, old: Topic, embedder: Embedder, **fields) -> Topic:
    """Patch a topic; its vector is recomputed only when a query text is given."""
    return old.patched(embed=lambda text: embed_text(spark, text, embedder), **fields)
