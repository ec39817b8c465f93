"""Removal of lines that several documents share.

Lines are exploded and hashed, each hash is counted over documents, and the lines
of repeated hashes are dropped from every document but the first; what stays is
joined again by position. Only hashes are shuffled by key, once per document and
line, and aggregated before the exchange, so that a line of a third of the corpus
is a few rows per task; the texts move once, by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import slices, stored, text_or_empty

MIN_CHARS = 10
MIN_DOCUMENTS = 2
#: Fixed value: the characters stripped from both ends of a line.
STRIPPED = " \t\n\x0b\x0c\r"
ASSEMBLED = "struct<n_lines: bigint, n_dropped: bigint, text: string>"


def line_hash(line: str, min_chars: int) -> bytes | None:
    """Hash of a line's key (stripped, A-Z in lower case), None for short ones."""
    key = line.strip(STRIPPED)
    # bytes.lower() changes A-Z and nothing else
    return hashlib.md5(key.encode().lower()).digest() if len(key) >= min_chars else None


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id`` and ``line_hash``, once per document and line."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, hashes = [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = {line_hash(line, min_chars) for line in text.split("\n")} - {None}
                ids.extend([doc_id] * len(found))
                hashes.extend(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column(0).type), pa.array(hashes, pa.binary())],
                ["doc_id", "line_hash"],
            )

    chosen = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_or_empty().alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(explode, f"doc_id {id_type}, line_hash binary")


def repeated_lines(hashes: DataFrame, min_documents: int) -> DataFrame:
    """Hashes that enough documents hold, with the first of these documents."""
    found = hashes.groupBy("line_hash").agg(
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
        F.count(F.lit(1)).alias("n_documents"),
    )
    # rows of one repeated document do not make two documents
    several = F.col("first_id") != F.col("last_id")
    return found.where(several & (F.col("n_documents") >= min_documents)).select(
        "line_hash", "first_id"
    )


def _assembled(min_chars: int):
    """A column function: what a text keeps without the lines of some hashes."""

    @F.arrow_udf(ASSEMBLED)
    def assemble(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept_texts = [], [], []
        for text, hashes in zip(texts, dropped, strict=True):
            # one text at a time as a string, however many there are in the batch
            lines = text.as_py().split("\n")
            gone = set(hashes.as_py() or ())
            kept = [x for x in lines if line_hash(x, min_chars) not in gone] if gone else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            kept_texts.append("\n".join(kept))
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept_texts, pa.string())],
            ["n_lines", "n_dropped", "text"],
        )

    return assemble


def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    counts: str = "lines",
) -> DataFrame:
    """``docs`` with shared lines taken out of ``text``, and a column of counts.

    ``counts`` names a struct with ``n_lines`` (before dropping) and ``n_dropped``; it
    replaces a column of that name. A null or empty text is one empty line. Lines
    repeated within one document stay. Repeated rows of a document are cut alike;
    rows without an identifier are not counted and stay whole. For
    ``min_documents`` above two, rows of one identifier have to be unique. Texts of any
    length are cut whole; an empty table gives one.
    """
    hashes = stored(line_hashes(docs, min_chars), "line-hashes")
    repeated = stored(repeated_lines(hashes, min_documents), "repeated-lines")
    dropped = (
        hashes.join(repeated, "line_hash")
        .where(F.col("doc_id") != F.col("first_id"))
        .groupBy(F.col("doc_id").alias("_dropped_from"))
        .agg(F.collect_set("line_hash").alias("_dropped"))
    )

    others = [c for c in docs.columns if c not in ("text", counts)]
    joined = docs.join(dropped, docs["doc_id"] == dropped["_dropped_from"], "left")
    cut = joined.select(
        *[docs[c] for c in others],
        _assembled(min_chars)(F.coalesce(docs["text"], F.lit("")), "_dropped").alias("_cut"),
    )
    return cut.select(
        *others,
        F.col("_cut.text").alias("text"),
        F.struct("_cut.n_lines", "_cut.n_dropped").alias(counts),
    )
