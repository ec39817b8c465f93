"""One query per operator, with its production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicsieve.llm import (
    bpe, chat, exact_dedup, fill_in_middle, hilbert, line_dedup, merkle, near_dedup, packing, prefix_join,
    quality, tag_paths, token_files,
)
from topicsieve.llm.frames import documents, table, tokenizer
from topicsieve.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds control strings; read back from the output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(
        r"""SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text
            FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"""
    )
    turns = given.unionByName(hostile)
    formatted = chat.format_chats(
        turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    )
    read = formatted.select(
        "conv_id",
        "formatted",
        chat.read_chats(F.col("formatted")).alias("turns"),
        chat.read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return packing.pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op6_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("lines.n_lines").alias("n_lines"),
        F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    token_files.write_token_shards(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), path)
    return token_files.read_token_shards(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract_main_text(table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = near_dedup.Rule(percent=85, band_rows=5)
    return near_dedup.near_duplicates(documents(spark, sf_dir), rule)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(documents(spark, sf_dir))
    back = fill_in_middle.restored(F.col("text"), F.col("form"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all rows, and what becomes of a seventh of them if tampered with."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    added = [*fields[:3], fields[3] + 1, fields[4]]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        merkle.leaf(*fields).alias("leaf"),
        F.when(chosen, merkle.leaf(*added)).alias("tampered"),
    )
    proven = merkle.manifest(leaves, "lang", ["doc_id"], "leaf")
    given = proven.withColumn("given", F.coalesce("tampered", "leaf"))
    return given.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.col("given"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.similar_documents(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_bpe, op3_best_fit_packing, op4_quality_classifier, op5_exact_dedup,
        op6_hilbert_search, op7_line_dedup, op8_token_files, op9_html_main_text,
        op10_minhash_near_dedup, op11_fill_in_middle, op12_merkle_manifest, op13_ngram_join,
    )
}
