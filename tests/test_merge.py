"""Merges by key, seeding, ids and tier moves."""

import pytest
from pyspark.sql import functions as F

from tests.models import FlakyEmbedder
from topicsieve.operators import embedding, identifiers, merge
from topicsieve.operators.topics import patch_topic
from topicsieve.sources import tables


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_update_sets_fields_and_ignores_unknown_ids(spark):
    table = spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], "paper_id string, n int, s string")
    updates = spark.createDataFrame([("A", 9), ("Z", 7)], "paper_id string, n int")
    assert rows(merge.update_by_key(table, updates, ["n"]), "paper_id", "n", "s") == [("A", 9, "x"), ("B", 2, "y")]


def test_update_with_null_overwrites_and_the_last_one_wins(spark):
    table = spark.createDataFrame([("A", 1)], "paper_id string, n int")
    updates = spark.createDataFrame([("A", 5, 1), ("A", None, 3), ("A", 7, 2)], "paper_id string, n int, at int")
    assert rows(merge.update_by_key(table, updates, ["n"], order=["at"]), "paper_id", "n") == [("A", None)]


def test_update_can_add_a_field(spark):
    table = spark.createDataFrame([("A",), ("B",)], "paper_id string")
    updates = spark.createDataFrame([("A", "why")], "paper_id string, justification string")
    merged = merge.update_by_key(table, updates, ["justification"]).collect()
    assert {r["paper_id"]: r["justification"] for r in merged} == {"A": "why", "B": None}


def test_seed_only_into_an_empty_table(spark):
    seeds = spark.createDataFrame([("S",)], "paper_id string")
    table = spark.createDataFrame([("A",)], "paper_id string")
    assert rows(merge.seed_if_empty(table, seeds), "paper_id") == [("A",)]
    assert rows(merge.seed_if_empty(table.limit(0), seeds), "paper_id") == [("S",)]


def test_upsert_seeds(spark):
    schema = "paper_id string, title string, abstract string, text string, embedding array<float>, note string"
    stored = spark.createDataFrame(
        [
            ("A", "old a", "abs a", "text a", [1.0], "n"),
            ("B", "old b", "", "text b", [1.0], "n"),
            ("C", "old c", "abs c", None, None, "n"),
            ("D", "old d", None, None, None, "n"),
        ],
        schema,
    )
    seeds = spark.createDataFrame(
        [("A", "new a", "seed"), ("B", "new b", "seed"), ("C", "new c", None), ("E", "new e", "seed")],
        "paper_id string, title string, abstract string",
    )
    done = {r["paper_id"]: r for r in merge.upsert_seeds(stored, seeds, FlakyEmbedder()).collect()}
    assert done["A"]["touched"] == "untouched" and done["A"]["embedding"] == [1.0]
    assert (done["B"]["title"], done["B"]["abstract"], done["B"]["text"]) == ("old b", "seed", "new b seed")
    assert done["B"]["embedding"] == [10.0, 1.0] and done["B"]["note"] == "n"
    assert (done["C"]["abstract"], done["C"]["text"]) == ("", "new c")
    assert done["D"]["touched"] == "untouched" and done["D"]["embedding"] is None
    assert (done["E"]["title"], done["E"]["text"], done["E"]["note"]) == ("new e", "new e seed", None)


def test_backfill_reuses_and_skips_blank(spark):
    df = spark.createDataFrame(
        [("A", "abc", [7.0]), ("B", "abcd", None), ("C", "ab", []), ("D", "", None), ("E", None, None)],
        "paper_id string, text string, embedding array<float>",
    )
    done = {r["paper_id"]: r["embedding"] for r in embedding.backfill_embeddings(df, FlakyEmbedder()).collect()}
    assert done == {"A": [7.0], "B": [4.0, 1.0], "C": [2.0, 1.0], "D": None, "E": None}


def test_hashing_embedder_is_unit_length_and_repeatable(spark):
    df = spark.createDataFrame([("one two two",), ("",), (None,), ("!?",)], "text string")
    once, twice = (
        [r["embedding"] for r in embedding.embed_documents(df, embedding.HashingEmbedder(16)).collect()]
        for _ in range(2)
    )
    assert once == twice
    assert all(sum(x * x for x in v) == pytest.approx(1.0, abs=1e-6) for v in once)


def test_a_failing_model_fails_a_backfill(spark):
    df = spark.createDataFrame([("A", "poison", None)], "paper_id string, text string, embedding array<float>")
    with pytest.raises(Exception, match="cannot embed"):
        embedding.backfill_embeddings(df, FlakyEmbedder()).collect()


def test_max_suffix_ignores_malformed_ids(spark):
    ids = spark.createDataFrame([("PAPER_7",), ("PAPER_12",), ("PAPER_99x",), ("OTHER_500",), (None,)], "paper_id string")
    assert identifiers.max_id_suffix(ids).first()[0] == 12
    assert identifiers.max_id_suffix(ids.limit(0)).first()[0] == 2000


def test_counter_never_moves_back(spark):
    ids = spark.createDataFrame([("PAPER_7",)], "paper_id string")
    counter = lambda *v: spark.createDataFrame([(x,) for x in v], "seq long")
    assert identifiers.sync_counter(counter(3), ids).first()[0] == 7
    assert identifiers.sync_counter(counter(30), ids).first()[0] == 30
    assert identifiers.sync_counter(counter(), ids).first()[0] == 7


def test_ids_are_consecutive_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    keys = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("key")).repartition(13)
    numbered = identifiers.assign_ids(keys, "key", 100).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    in_order = [r["paper_id"] for r in sorted(numbered, key=lambda r: r["key"])]
    assert in_order == [f"PAPER_{i}" for i in range(101, 5101)]


def test_patch_topic(spark):
    topics = spark.createDataFrame([(1, "a", "q"), (2, "b", "r")], "id int, topic_name string, query_text string")
    patch = spark.createDataFrame([(1, None, "new")], "id int, topic_name string, query_text string")
    done = rows(patch_topic(topics, patch, "id", ["topic_name", "query_text"]), "id", "topic_name", "query_text", "patched")
    assert done == [(1, "a", "new", True), (2, "b", "r", False)]


def test_tier_moves_and_new_placement(spark, tmp_path):
    old = spark.createDataFrame(
        [("A", "tiers/gold/A.pdf"), ("B", "tiers/silver/B.pdf"), ("C", None), ("D", None)],
        "paper_id string, tier_minio_key string",
    )
    new = spark.createDataFrame(
        [("A", 5, "up/A.pdf"), ("B", 1, "up/B.pdf"), ("C", 0, "up/C.pdf"), ("D", 5, None)],
        "paper_id string, score_final int, minio_key string",
    )
    moves = merge.tier_transitions(old, new)
    assert rows(moves, "paper_id", "old_key", "new_key") == [
        ("B", "tiers/silver/B.pdf", "tiers/bronze/B.pdf"),
        ("C", None, "tiers/out_of_range/C.pdf"),
    ]
    placed = spark.createDataFrame([("A", "gold"), ("B", "silver")], "paper_id string, tier string")
    tables.write_by_tier(placed, f"{tmp_path}/v1")
    tables.retire_stale_tier(spark.read.parquet(f"{tmp_path}/v1"), moves, f"{tmp_path}/v2")
    stored = spark.read.parquet(f"{tmp_path}/v2")
    assert rows(stored, "paper_id", "tier") == [("A", "gold"), ("B", "bronze"), ("C", "out_of_range")]
    assert not (tmp_path / "v2" / "tier=silver").exists()


def test_replacing_some_tiers_keeps_the_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_by_tier(spark.createDataFrame([("A", "gold"), ("B", "silver")], "paper_id string, tier string"), path)
    tables.replace_tiers(spark.createDataFrame([("C", "gold")], "paper_id string, tier string"), path)
    assert rows(tables.read_tiers(spark, path), "paper_id", "tier") == [("B", "silver"), ("C", "gold")]
    assert rows(tables.read_tiers(spark, path, "gold"), "paper_id") == [("C",)]
