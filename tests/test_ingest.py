"""Sources, bulk import, re-extraction, streaming ingest, generation and chat."""

import pytest
from pyspark.sql import functions as F

from tests.models import FlakyEmbedder, FlakyGenerator, two_column_pages
from topicsieve.operators import conversations, generation
from topicsieve.operators.joblog import job_latest_state
from topicsieve.operators.vocabulary import Vocabulary, fit
from topicsieve.plans import ingest
from topicsieve.plans.rescore import fit_corpus
from topicsieve.sources import files
from topicsieve.streaming import ingest as streaming
from topicsieve.streaming.store import Store
from topicsieve.topic import Topic

TOPIC = Topic("apples", "red apples", {"a": ["apples"], "b": ["pears"]}, (2000, 2030), query_vector=(1.0, 0.0))
BODY = "Growing apples in very cold places\nAbstract: Apples number {n} from {year}.\n\nIntroduction"


def put(folder, name, content):
    target = folder / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    put(root, "b.pdf", BODY.format(n="two", year=2019))
    put(root, "deep/a.PDF", BODY.format(n="one", year=2018))
    put(root, "c.pdf", b"\xff\xfe\xff")
    put(root, "d.pdf", b"")
    put(root, "notes.txt", "no paper")
    return root


def names(df, column="path"):
    return [r[column].rsplit("/", 1)[-1] for r in df.collect()]


def test_listing_is_recursive_ordered_and_limited(spark, folder):
    assert names(files.list_binary_files(spark, str(folder))) == ["b.pdf", "c.pdf", "a.PDF"]
    assert names(files.list_binary_files(spark, str(folder), 2)) == ["b.pdf", "c.pdf"]
    plan = files.list_binary_files(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_reading_and_checking_files(spark, folder):
    read = {r["path"].rsplit("/", 1)[-1]: r["content"] for r in files.read_binary(spark, str(folder)).collect()}
    assert read["c.pdf"] == b"\xff\xfe\xff"
    good, bad = files.split_upload(files.read_binary(spark, str(folder), None))
    assert sorted(names(good)) == ["a.PDF", "b.pdf", "c.pdf"]
    assert {r["path"].rsplit("/", 1)[-1]: r["reject_reason"] for r in bad.collect()} == {
        "notes.txt": "not a .pdf file"
    }


def test_reject_reasons(spark):
    uploads = spark.createDataFrame(
        [("x.pdf", 3), ("y.PDF", 0), ("z.doc", 0)], "path string, length bigint"
    )
    reasons = {r["path"]: r["reject_reason"] for r in files.validate_upload(uploads).collect()}
    assert reasons == {"x.pdf": None, "y.PDF": "empty file", "z.doc": "not a .pdf file"}


def test_metadata_of_files(spark, tmp_path):
    put(tmp_path / "in", "x.pdf", "Plausible title from the metadata|one|two 2011|three|four 2015")
    row = files.with_metadata(files.read_binary(spark, str(tmp_path / "in")), two_column_pages).first()
    assert row["title"] == "Plausible title from the metadata"
    assert row["year"] == 2011  # the fourth page does not count


def test_import_isolates_failures(spark, folder):
    put(folder, "z.pdf", "Some poison in a title of this paper\nAbstract: bad.\n\n")
    done = ingest.import_batch(spark, str(folder), TOPIC, Vocabulary(0), 2000, embedder=FlakyEmbedder())
    found = {r["source_path"].rsplit("/", 1)[-1]: r for r in done.collect()}
    assert [found[n]["paper_id"] for n in ("b.pdf", "c.pdf", "a.PDF", "z.pdf")] == [
        f"PAPER_{n}" for n in range(2001, 2005)
    ]
    assert found["b.pdf"]["abstract"] == "Apples number two from 2019." and found["b.pdf"]["year"] == 2019
    assert found["b.pdf"]["score_breakdown"]["tfidf"] == 0.5
    assert found["b.pdf"]["minio_key"] == "uploads/PAPER_2001.pdf"
    broken = found["c.pdf"]
    assert (broken["title"], broken["year"], broken["text"]) == ("(unparseable)", 2024, "")
    assert broken["parse_error"] and broken["ingest_error"] is None
    assert "cannot embed" in found["z.pdf"]["ingest_error"]
    papers, failed = ingest.split_ingested(done)
    assert papers.count() == 3 and failed.count() == 1


def test_import_limit(spark, folder):
    done = ingest.import_batch(spark, str(folder), TOPIC, Vocabulary(0), 0, limit=1, embedder=FlakyEmbedder())
    assert names(done, "source_path") == ["b.pdf"]
    with pytest.raises(ValueError):
        ingest.import_batch(spark, str(folder), TOPIC, Vocabulary(0), 0, limit=0)


def test_import_scores_with_the_given_vocabulary(spark, folder):
    old = fit(spark.createDataFrame([("apples are red",), ("pears are green",)], "text string"))
    done = ingest.import_batch(spark, str(folder), TOPIC, old, 0, embedder=FlakyEmbedder())
    scores = {r["source_path"].rsplit("/", 1)[-1]: r["score_breakdown"]["tfidf"] for r in done.collect()}
    assert scores["b.pdf"] > 0.0 and scores["c.pdf"] == 0.0  # the failed one is scored by its title


def test_reextract_keeps_papers_without_a_file(spark):
    schema = "paper_id string, title string, abstract string, year int, text string, embedding array<float>, minio_key string"
    papers = spark.createDataFrame(
        [
            ("A", "old", "abs", 2000, "txt", [9.0], "k/A"),
            ("B", "old", "abs", 2000, "txt", [9.0], None),
            ("C", "old", "abs", 2000, "txt", [9.0], "k/C"),
            ("D", "old", "abs", 2000, "txt", [9.0], "k/D"),
        ],
        schema,
    )
    sources = spark.createDataFrame(
        [("k/A", bytearray(BODY.format(n="x", year=2015).encode())), ("k/D", bytearray(b"\xff"))],
        "minio_key string, content binary",
    )
    done = {r["paper_id"]: r for r in ingest.reextract(papers, sources, FlakyEmbedder()).collect()}
    assert done["A"]["year"] == 2015 and done["A"]["embedding"] == [float(len(done["A"]["text"])), 1.0]
    for kept in "BC":
        assert (done[kept]["title"], done[kept]["embedding"]) == ("old", [9.0])
    assert done["D"]["title"] == "(unparseable)"


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stream_ingest_over_batches(spark, tmp_path):
    inbox, store = tmp_path / "in", Store(f"{tmp_path}/store")

    def step():
        stream = streaming.file_stream(spark, str(inbox))
        run(streaming.stream_ingest(stream, store, TOPIC, f"{tmp_path}/cp", FlakyEmbedder()))

    put(inbox, "a.pdf", BODY.format(n="one", year=2018))
    put(inbox, "b.pdf", BODY.format(n="two", year=2019))
    step()
    first = {r["paper_id"]: r["score_breakdown"]["tfidf"] for r in streaming.read_papers(spark, store).collect()}
    assert first == {"PAPER_2001": 0.5, "PAPER_2002": 0.5}

    put(inbox, "c.pdf", "Growing red apples on the moon now\nAbstract: Unlike poison.\n\nIntroduction")
    put(inbox, "d.pdf", "Growing red apples on the moon now\nAbstract: Two.\n\nIntroduction")
    step()
    papers = streaming.read_papers(spark, store)
    ids = {r["paper_id"] for r in papers.collect()}
    assert ids == {"PAPER_2001", "PAPER_2002", "PAPER_2004"}  # 2003 failed
    third = papers.where("paper_id = 'PAPER_2004'").first()
    assert 0.0 <= third["score_breakdown"]["tfidf"] < 0.5  # scored by the vocabulary of the first batch

    assert streaming.current_vocabulary(spark, store) == fit_corpus(papers)

    jobs = {r["job_id"]: r for r in job_latest_state(streaming.read_log(spark, store)).collect()}
    assert jobs["ingest-PAPER_2001"]["status"] == "completed"
    assert jobs["ingest-PAPER_2003"]["status"] == "failed" and "cannot embed" in jobs["ingest-PAPER_2003"]["error"]
    stages = streaming.read_log(spark, store).where("job_id = 'ingest-PAPER_2001'").orderBy("event_id")
    assert [r["stage"] for r in stages.collect()] == ["queued", *streaming.RUNNING_STAGES, "completed"]


def test_a_repeated_ingest_batch_changes_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.pdf", BODY.format(n="one", year=2018))
    put(tmp_path / "in", "b.pdf", BODY.format(n="two", year=2019))
    store, batch = Store(f"{tmp_path}/store"), files.read_binary(spark, f"{tmp_path}/in")
    outcome = []
    for _ in range(2):
        streaming.ingest_batch(batch, 0, store, TOPIC, FlakyEmbedder())
        stored = streaming.read_papers(spark, store).select("paper_id", "text", "score_breakdown")
        outcome.append((sorted(stored.collect()), streaming.current_vocabulary(spark, store)))
    assert outcome[0] == outcome[1]


def test_refit_every_other_batch_catches_up(spark, tmp_path):
    store, words = Store(f"{tmp_path}/store"), ("one", "two", "three", "four")
    for batch, word in enumerate(words):
        put(tmp_path / word, "a.pdf", BODY.format(n=word, year=2010 + batch))
        read = files.read_binary(spark, f"{tmp_path}/{word}")
        streaming.ingest_batch(read, batch, store, TOPIC, FlakyEmbedder(), refit_every=2)
    assert store.batches(spark, streaming.VOCABULARY) == [1, 3]
    papers = streaming.read_papers(spark, store)
    assert papers.count() == 4
    assert streaming.current_vocabulary(spark, store) == fit_corpus(papers)


def test_a_batch_that_dies_leaves_its_log_and_resumes(spark, tmp_path):
    put(tmp_path / "in", "a.pdf", BODY.format(n="one", year=2018))
    put(tmp_path / "in", "b.pdf", BODY.format(n="two", year=2019))
    store, batch = Store(f"{tmp_path}/store"), files.read_binary(spark, f"{tmp_path}/in")
    broken = Topic("t", "red apples", {"a": ["["]}, (2000, 2030), thresholds={"gold_muy": "no number"})
    with pytest.raises(Exception):
        streaming.ingest_batch(batch, 0, store, broken, FlakyEmbedder())
    jobs = {r.job_id: r for r in job_latest_state(streaming.read_log(spark, store)).collect()}
    assert {(r.status, r.stage) for r in jobs.values()} == {("failed", "scoring")}
    assert all(r.error for r in jobs.values()) and len(jobs) == 2
    texts = store.path(streaming.EXTRACTED, 0)
    written = sorted(p.name for p in (tmp_path / "store" / "extracted" / "batch=0").iterdir())

    before = {r.paper_id: r.ts for r in streaming.read_log(spark, store).where("event_id = 0").collect()}
    streaming.ingest_batch(batch, 0, store, TOPIC, FlakyEmbedder(), justify="auto", generator=generation.TemplateGenerator())
    assert sorted(p.name for p in (tmp_path / "store" / "extracted" / "batch=0").iterdir()) == written and texts
    log = streaming.read_log(spark, store)
    assert {r.paper_id: r.ts for r in log.where("event_id = 0").collect()} == before
    assert log.where("status = 'failed'").count() == 0
    stages = [r.stage for r in log.where("job_id = 'ingest-PAPER_2001'").orderBy("event_id").collect()]
    assert stages == ["queued", *streaming.RUNNING_STAGES, streaming.JUSTIFY_STAGE, "completed"]
    assert all(r.justification for r in streaming.read_papers(spark, store).collect())


def test_statistics_are_kept_in_levels(spark, tmp_path, monkeypatch):
    store = Store(f"{tmp_path}/store")
    for number in range(9):
        put(tmp_path / f"in{number}", "a.pdf", BODY.format(n=f"word{number}", year=2010 + number))
        read = files.read_binary(spark, f"{tmp_path}/in{number}")
        streaming.ingest_batch(read, number, store, TOPIC, FlakyEmbedder(), refit_every=9)
    papers = streaming.read_papers(spark, store)
    assert {r.paper_id for r in papers.collect()} == {f"PAPER_{2001 + i}" for i in range(9)}
    assert streaming.current_vocabulary(spark, store) == fit_corpus(papers)
    levels = tmp_path / "store" / "statistics"
    sizes = [sum(p.stat().st_size for p in (levels / "level=0" / f"batch={n}").iterdir()) for n in range(9)]
    assert max(sizes) < 1.3 * min(sizes)
    assert [p.name for p in (levels / "level=1").iterdir() if p.is_dir()] == ["batch=7"]


BREAKDOWN = "struct<keyword:double,tfidf:double,sbert:double,weighted:double>"


def test_justify_batch_isolates_failures(spark):
    papers = spark.createDataFrame(
        [
            ("A", "title a", None, (0.125, 0.5, 1.0, 0.335), 4, "Gold", "before"),
            ("B", "poison", "x", (0.1, 0.1, 0.1, 0.1), 4, "Gold", "before"),
        ],
        f"paper_id string, title string, abstract string, score_breakdown {BREAKDOWN}, score_final int, decision string, justification string",
    )
    prompt = papers.select(generation.build_prompt(None)).first()[0]
    assert "the current topic" in prompt and "(no abstract available)" in prompt
    assert "keyword 0.13, tfidf 0.50, embedding 1.00, weighted 0.34" in prompt
    results = generation.justify_batch(papers, "poisonless topic", FlakyGenerator())
    assert results.where("error is not null").count() == 2  # the topic name is part of the prompt
    results = generation.justify_batch(papers, "fine topic", FlakyGenerator())
    rows = {r["paper_id"]: r for r in results.collect()}
    assert (rows["A"]["justification"], rows["A"]["generated_in_ms"]) == ("2 seen", 2)
    assert rows["B"]["justification"] is None and "no answer" in rows["B"]["error"]
    merged = generation.with_justifications(papers, results).collect()
    assert {r["paper_id"]: r["justification"] for r in merged} == {"A": "2 seen", "B": "before"}


def chats(spark):
    rows = [
        (1, 1, "assistant", "hi"), (1, 0, "user", "hello"), (1, 2, "user", "bye"),
        (2, 0, "robot", "x"),
        (3, 0, "user", "y" * 100),
        (4, 0, "user", "poison"),
        (5, 0, "user", "free"),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_conversations_are_ordered_and_split_into_parts(spark):
    parts = conversations.assemble_conversations(chats(spark), part_turns=2)
    found = {(r["conv_id"], r["part"]): [m["content"] for m in r["messages"]] for r in parts.collect()}
    assert found[(1, 0)] == ["hello", "hi"] and found[(1, 1)] == ["bye"]


def test_a_dominating_conversation_stays_in_bounded_parts(spark):
    hot = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("conv_id"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("long") / 3).otherwise(0).cast("long").alias("turn"),
        F.lit("user").alias("role"),
        F.lit("t").alias("text"),
    )
    parts = conversations.assemble_conversations(hot).agg(F.max("n_messages"), F.sum("n_messages")).first()
    assert parts[0] == 256 and parts[1] == 5000


def test_conversation_answers_and_failures(spark):
    done = conversations.answer_conversations(chats(spark), FlakyGenerator(), "m")
    rows = {r["conv_id"]: r for r in done.collect()}
    assert set(rows) == {1, 2, 3, 4, 5}
    assert (rows[1]["message"], rows[1]["total_duration_ms"], rows[1]["model"]) == ("3 seen", 2, "m")
    assert rows[2]["error"] == "unknown role"
    assert rows[3]["message"] == "1 seen" and rows[3]["eval_count"] is None
    assert "no answer" in rows[4]["error"] and rows[4]["total_duration_ms"] == 0
    assert rows[5]["total_duration_ms"] == 0


def test_a_long_conversation_streams_through_in_order(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("conv_id"),
            F.col("id").alias("turn"),
            F.lit("user").alias("role"),
            F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text"),
        )
        done = conversations.answer_conversations(rows.repartition(7), generation.TemplateGenerator()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {r["conv_id"]: r for r in done}
    assert len(done) == 2001
    assert found[0]["message"].startswith("Read 1000 messages of ") and found[0]["message"].endswith("turn 2997")
    assert found[0]["eval_count"] == len(found[0]["message"].split())
    assert conversations.answer_conversations(rows.limit(0), generation.TemplateGenerator()).count() == 0
