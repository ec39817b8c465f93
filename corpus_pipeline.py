"""From raw documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``docs``. Null and empty texts, repeated rows, rows without an identifier and further
columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.llm import line_dedup, near_dedup, packing, quality
from topicsieve.llm.frames import documents, stored, table, tokenizer
from topicsieve.session import ship_package


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier does not reject."""
    ship_package(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.scored_by(model, F.col("text")) >= 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that several documents share out of all but the first of them."""
    ship_package(spark)
    cut = line_dedup.drop_repeated_lines(docs, counts="_line_counts")
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", size).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one of smallest identifier."""
    ship_package(spark)
    found = near_dedup.near_duplicates(docs, near_dedup.Rule(percent=80))
    return docs.join(found.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(
        *docs.columns
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the remaining documents' tokens: the place of each piece in its sequence."""
    ship_package(spark)
    pieces = packing.token_pieces(docs, tokenizer("byte_bpe_50k.json"))
    return packing.pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]

# A fitted classifier is not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
