"""The pipeline: stages one by one against brute force, and all of them in a row."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_dedup import brute_lines, brute_near
from tests.llm.test_tokens import check_packed
from topicsieve.llm import quality

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (_, classify), (_, drop_lines), (_, drop_near), (_, pack) = corpus_pipeline.STAGES
    given = rows_of(docs)

    model = quality.train(docs, labels)
    good = [r for r in given if model.score(quality.text_features(r[1] or "")) >= 0.5]
    assert Counter(rows_of(classify(spark, docs, SF))) == Counter(good)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r[0] for r in good}
    clean = [d for d, q in truth.items() if q == 1]
    assert np.mean([d in kept for d in clean]) > 0.97
    assert np.mean([d in kept for d, q in truth.items() if q == 0]) < 0.1

    frame = spark.createDataFrame(good, docs.schema)
    text = {d: t for d, _, _, t in brute_lines(good)}
    cut = [(d, text[d], lang, source, len(text[d])) for d, _, lang, source, _ in good]
    assert Counter(rows_of(drop_lines(spark, frame, SF))) == Counter(cut)

    frame = spark.createDataFrame(cut, docs.schema)
    _, components = brute_near(cut, 80)
    unique = [r for r in cut if components[r[0]] == r[0]]
    assert Counter(rows_of(drop_near(spark, frame, SF))) == Counter(unique)

    packed = pack(spark, spark.createDataFrame(unique, docs.schema), SF).collect()
    check_packed(packed, 1024)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = defaultdict(int)
    for r in packed:
        sizes[r.doc_id] += r.length
    assert sizes == {r[0]: len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in unique}


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select(*columns).collect())) == Counter(
        map(tuple, docs.select(*columns).collect())
    )


def test_odd_rows_pass_all_stages(spark):
    for df in (cases.frame(spark), cases.empty(spark)):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.schema.names == before.schema.names
        assert docs.count() >= 0
