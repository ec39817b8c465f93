"""Edits of topic rows: patches, axis names, keyword lists and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.functions.keywords import first_spellings, ranked_keywords, split_keywords
from topicsieve.functions.scoring import DEFAULT_WEIGHTS
from topicsieve.functions.text import SPACE, strip
from topicsieve.operators.embedding import Embedder, embed_where

# Fixed value: name of the axis that replaces the last one removed.
DEFAULT_AXIS = "keywords"


def normalize_keywords(df: DataFrame, pasted: str, existing: str | None = None, out: str = "keywords") -> DataFrame:
    """Append pasted keywords to existing ones, ignoring case for repeats."""
    pieces = split_keywords(F.col(pasted))
    if existing:
        pieces = F.concat(F.coalesce(F.col(existing), F.array().cast("array<string>")), pieces)
    return (
        df.withColumn("_ranked", ranked_keywords(pieces))
        .withColumn(out, first_spellings(F.col("_ranked")))
        .drop("_ranked")
    )


def weight_sum(weights: Column) -> Column:
    """Sum of the three weights; a missing one counts as zero."""
    total = F.lit(0.0)
    for name in DEFAULT_WEIGHTS:
        total = total + F.coalesce(weights[name], F.lit(0.0))
    return total


def patch_topic(topics: DataFrame, patches: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Replace the non-null fields of a patch; topics without one stay as they are.

    ``patched`` tells which rows received a new time stamp.
    """
    new = patches.select(key, F.lit(True).alias("_given"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = topics.join(new, key, "left")
    kept = [c for c in topics.columns if c not in fields]
    changed = F.coalesce(F.col("_given"), F.lit(False)) & F.coalesce(
        *[F.when(F.col(f"_new_{f}").isNotNull(), True) for f in fields], F.lit(False)
    )
    return joined.select(
        *kept, *[F.coalesce(f"_new_{f}", f).alias(f) for f in fields], changed.alias("patched")
    )


def refresh_query_vectors(
    topics: DataFrame, patches: DataFrame, key: str, embedder: Embedder
) -> DataFrame:
    """Patch query texts of many topics and re-embed exactly those given one."""
    given = patches.where(F.col("query_text").isNotNull()).select(key, "query_text", F.lit(True).alias("_given"))
    joined = topics.join(given.withColumnRenamed("query_text", "_text"), key, "left")
    patched = joined.withColumn("query_text", F.coalesce("_text", "query_text")).drop("_text")
    return embed_where(
        patched, F.coalesce("_given", F.lit(False)), embedder, text="query_text"
    ).withColumnRenamed("_given", "refreshed")


def axis_name(name: Column) -> Column:
    """Trimmed, lower-cased, white space as underscores."""
    return F.regexp_replace(F.lower(strip(name)), f"[{SPACE}]+", "_")


def rename_axis(axes: Column, old: Column, new: Column) -> Column:
    """Rename one axis in place; a blank or unchanged name does nothing.

    Renaming onto an existing axis keeps that axis's place and the later list.
    """
    target = axis_name(new)
    renamed = F.transform(
        F.map_entries(axes),
        lambda e: F.struct(F.when(e["key"] == old, target).otherwise(e["key"]).alias("key"), e["value"].alias("value")),
    )
    # Keep the first place of a key with the last list written to it.
    names = F.array_distinct(F.transform(renamed, lambda e: e["key"]))
    merged = F.map_from_arrays(
        names,
        F.transform(names, lambda k: F.element_at(F.filter(renamed, lambda e: e["key"] == k), -1)["value"]),
    )
    return F.when((target == "") | (target == old), axes).otherwise(merged)


def remove_axis(axes: Column, name: Column) -> Column:
    """Drop an axis; an empty default axis takes the place of the last one."""
    kept = F.map_filter(axes, lambda k, _: k != name)
    fallback = F.create_map(F.lit(DEFAULT_AXIS), F.array().cast("array<string>"))
    return F.when(F.size(kept) == 0, fallback).otherwise(kept)
