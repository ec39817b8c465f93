"""Versions, marks, and the jobs on a versioned corpus: killed, resumed, repeated."""

import hashlib
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topicsieve.functions.scoring import score_to_tier, tier_key
from topicsieve.operators import generation
from topicsieve.operators.embedding import HashingEmbedder, VectorStore
from topicsieve.operators.joblog import job_latest_state
from topicsieve.operators.vocabulary import (
    fit,
    merge_statistics,
    retracted,
    term_statistics,
    updated_statistics,
    vocabulary_from_statistics,
)
from topicsieve.plans.import_job import Import, import_job
from topicsieve.plans.ingest import import_batch, reextract
from topicsieve.plans.jobs import read_job_log
from topicsieve.plans.rescore import rescore
from topicsieve.plans.rescore_job import Rescore, create_corpus, rescore_job
from topicsieve.sources.commits import Conflict, Marks, Versions
from topicsieve.sources.files import copied, read_binary, remove_files
from topicsieve.sources.tables import move_placement, read_placement, write_placement
from topicsieve.topic import Topic

EMBEDDER = HashingEmbedder(8)
BEFORE = Topic("old", "zero trust networks", {"core": ["zero trust"]}, (2010, 2030), query_vector=(1.0,) + (0.0,) * 7)
AFTER = Topic("new", "deep learning for plants", {"core": ["plants"]}, (2010, 2030), query_vector=(0.0, 1.0) + (0.0,) * 6)


class CountingGenerator:
    """Notes each call in a folder; fails or hangs on texts that say so."""

    def __init__(self, folder, seconds=0.0):
        self.folder, self.seconds = str(folder), seconds

    def __eq__(self, other):
        return type(self) is type(other) and (self.folder, self.seconds) == (other.folder, other.seconds)

    def __hash__(self):
        return hash((self.folder, self.seconds))

    def __call__(self):
        def reply(messages):
            text = messages[-1]["content"]
            Path(self.folder, f"{time.time_ns()}-{hashlib.md5(text.encode()).hexdigest()}").touch()
            if "hanging" in text:
                time.sleep(self.seconds)
            if "broken" in text and not Path(self.folder, "..", "mended").exists():
                raise ValueError("no answer")
            return f"about {text.split('Title: ')[1][:9]}", 2_000_000

        return reply

    def calls(self):
        return len(list(Path(self.folder).iterdir()))


class OnceBrokenEmbedder(HashingEmbedder):
    """Fails until a file appears."""

    def __init__(self, switch):
        super().__init__(8)
        object.__setattr__(self, "switch", str(switch))

    def __call__(self):
        if not Path(self.switch).exists():
            raise RuntimeError("model is gone")
        return super().__call__()


def page(i, word):
    return (
        f"A study of {word} and their uses in number {i}\n\nAbstract: {word} and more about zero trust {i} in plants\n\n"
        "Introduction\nPublished 2019"
    )


def build(spark, root, n=24):
    """A corpus scored by the old topic, its source files, and its tier copies."""
    rows = [
        (f"PAPER_{i}", f"Title {i}", f"abstract {i}", 2000 + i, f"zero trust text {i} on {'plants' if i % 3 else 'networks'}",
         None if i % 4 == 0 else [float(i % 3), 1.0] + [0.5] * 6, f"uploads/PAPER_{i}.pdf" if i % 5 else None, None)
        for i in range(1, n + 1)
    ]
    schema = "paper_id string, title string, abstract string, year int, text string, embedding array<float>, minio_key string, justification string"
    papers = spark.createDataFrame(rows, schema)
    scored = rescore(papers, BEFORE, keep_inputs=True, embedder=EMBEDDER)
    placed = F.col("minio_key").isNotNull() & (F.length("paper_id") > 7)
    scored = scored.withColumn("tier_minio_key", F.when(placed, tier_key(F.col("paper_id"), F.col("tier"))))
    corpus, objects = Versions(f"{root}/corpus"), Path(root, "objects")
    create_corpus(spark, corpus, scored)
    for r in corpus.read(spark, "papers").collect():
        for key in (r.minio_key, r.tier_minio_key):
            if key and r.paper_id != "PAPER_7":  # whose files are lost
                Path(objects, key).parent.mkdir(parents=True, exist_ok=True)
                Path(objects, key).write_text(page(r.paper_id, "vines"))
    return corpus, str(objects)


def rows_by_id(df):
    return {r.paper_id: r.asDict(recursive=True) for r in df.collect()}


# versions and marks


def test_versions_switch_at_once(spark, tmp_path):
    corpus = Versions(f"{tmp_path}/v")
    assert corpus.current(spark) == 0
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(5).write.parquet(f"{tmp_path}/b")
    assert corpus.publish(spark, 0, t=f"{tmp_path}/a", note="x") == 1
    assert corpus.publish(spark, 1, t=[f"{tmp_path}/a", f"{tmp_path}/b"]) == 2
    assert (corpus.read(spark, "t", 1).count(), corpus.read(spark, "t").count()) == (3, 8)
    assert corpus.facts(spark, 2)["note"] == "x"
    with pytest.raises(Conflict):
        corpus.publish(spark, 1, t=f"{tmp_path}/b")
    with pytest.raises(LookupError):
        corpus.facts(spark, 3)


def test_marks(spark, tmp_path):
    marks = Marks(f"{tmp_path}/m")
    assert marks.all(spark) == {}
    marks.put(spark, "one", n=1)
    marks.put(spark, "two-2")
    marks.put(spark, "one", n=2)
    assert marks.all(spark) == {"one": {"n": "2"}, "two-2": {}}


# placements


def test_moves_write_touched_buckets_only(spark, tmp_path):
    rows = [(f"PAPER_{i}", ("gold", "silver", "bronze")[i % 3]) for i in range(300)]
    folders = write_placement(spark.createDataFrame(rows, "paper_id string, tier string"), f"{tmp_path}/p1", 8)
    before = {r.folder for r in folders.collect()}
    moves = [("PAPER_0", "gold", "silver"), ("PAPER_1", "silver", "gold"), ("PAPER_999", None, "out_of_range")]
    moved = spark.createDataFrame(moves, "paper_id string, old_tier string, new_tier string")
    after = move_placement(spark, folders, moved, f"{tmp_path}/p2", 8)
    got = {r.paper_id: r.tier for r in read_placement(spark, after, "paper_id string").collect()}
    assert got == dict(rows) | {"PAPER_0": "silver", "PAPER_1": "gold", "PAPER_999": "out_of_range"}
    kept = {r.folder for r in after.collect()} & before
    assert len(before - kept) <= 4 and len(kept) >= len(before) - 4


def test_no_placement_and_last_paper_leaves(spark, tmp_path):
    none = write_placement(spark.createDataFrame([], "paper_id string, tier string"), f"{tmp_path}/n")
    assert read_placement(spark, none, "paper_id string").collect() == []
    one = write_placement(spark.createDataFrame([("PAPER_1", "gold")], "paper_id string, tier string"), f"{tmp_path}/o")
    moved = spark.createDataFrame([("PAPER_1", "gold", "bronze")], "paper_id string, old_tier string, new_tier string")
    after = move_placement(spark, one, moved, f"{tmp_path}/o2")
    assert [(r.tier, r.paper_id) for r in read_placement(spark, after, "paper_id string").collect()] == [("bronze", "PAPER_1")]
    assert after.count() == 1


# files


def test_copies(spark, tmp_path):
    Path(tmp_path, "from").mkdir()
    Path(tmp_path, "from", "a b.pdf").write_bytes(b"x" * 3_000_000)
    rows = [(f"{tmp_path}/from/a b.pdf", f"file:{tmp_path}/to/deep/1.pdf"), (f"{tmp_path}/from/none", f"{tmp_path}/to/2.pdf"), (None, "y")]
    df = spark.createDataFrame(rows, "source string, target string")
    for _ in range(2):  # repeated, it replaces itself
        got = df.withColumn("c", copied(F.col("source"), F.col("target"))).orderBy("target").collect()
        by = {r.target: r.c for r in got}
        assert by[rows[0][1]].asDict() == {"bytes": 3_000_000, "error": None}
        assert by[rows[1][1]].bytes is None and "No such file" in by[rows[1][1]].error
        assert by["y"].asDict() == {"bytes": None, "error": None}
    assert [p.name for p in Path(tmp_path, "to").rglob("*") if p.is_file()] == ["1.pdf"]
    paths = spark.createDataFrame([(f"{tmp_path}/to/deep/1.pdf",), (f"{tmp_path}/to/2.pdf",)], "path string")
    assert (remove_files(paths), remove_files(paths)) == (1, 0)


def test_imported_files_can_be_extracted_again(spark, tmp_path):
    inbox, objects = Path(tmp_path, "in"), f"{tmp_path}/objects"
    inbox.mkdir()
    for i in range(7):
        Path(inbox, f"{i}.pdf").write_text(page(i, "vines") if i else "\f")
    papers = import_batch(spark, str(inbox), AFTER, fit(spark.createDataFrame([("a b",)], "text string")), 10, embedder=EMBEDDER, objects=objects)
    papers.write.parquet(f"{tmp_path}/papers")
    papers = spark.read.parquet(f"{tmp_path}/papers")
    stored = read_binary(spark, f"{objects}/uploads").withColumn("minio_key", F.concat(F.lit("uploads/"), F.element_at(F.split("path", "/"), -1)))
    given = {hashlib.md5(p.read_bytes()).hexdigest() for p in inbox.iterdir()}
    assert {r.d for r in stored.select(F.md5("content").alias("d")).collect()} == given
    again = reextract(papers, stored, EMBEDDER).select("paper_id", "title", "abstract", "year", "text", "embedding")
    assert rows_by_id(again) == rows_by_id(papers.select(*again.columns))
    for r in papers.collect():
        assert Path(objects, r.tier_minio_key).exists()


# statistics


def test_statistics_follow_changes(spark):
    old = [(1, "alpha beta beta"), (2, "gamma delta"), (3, "alpha omega"), (4, " ")]
    new = {1: "alpha beta", 2: "", 4: "gamma gamma"}
    frame = lambda rows: spark.createDataFrame(rows, "id int, text string")
    changed = [r for r in old if r[0] in new]
    now = [(i, new.get(i, t)) for i, t in old] + [(5, "fresh words")]
    got = updated_statistics(term_statistics(frame(old)), frame(changed), frame([r for r in now if r[0] in new or r[0] == 5]))
    want = term_statistics(frame(now))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert vocabulary_from_statistics(got) == fit(frame(now))


def test_all_taken_back(spark):
    all_of = term_statistics(spark.createDataFrame([("alpha beta",)], "text string"))
    assert merge_statistics(all_of, retracted(all_of)).collect() == []


# model calls


def asked(spark, texts):
    rows = [(f"PAPER_{i}", t, "words", None) for i, t in enumerate(texts)]
    papers = spark.createDataFrame(rows, "paper_id string, title string, abstract string, decision string")
    return papers.withColumn("score_final", F.lit(4)).withColumn(
        "score_breakdown",
        F.struct(*[F.lit(0.5).alias(s) for s in ("keyword", "tfidf", "sbert", "weighted")]),
    )


def test_answers_are_kept(spark, tmp_path):
    Path(tmp_path, "calls").mkdir()
    model = CountingGenerator(tmp_path / "calls")
    papers = asked(spark, ["fine one", "broken one", "fine two", "fine three"])
    first = rows_by_id(generation.justify_once(papers, "t", model, f"{tmp_path}/kept", per_wave=2))
    assert model.calls() == 4
    assert first["PAPER_0"]["justification"] == "about fine one\n" [:15].strip() or first["PAPER_0"]["error"] is None
    assert first["PAPER_1"]["error"] == "ValueError: no answer" and first["PAPER_1"]["justification"] is None
    second = rows_by_id(generation.justify_once(papers, "t", model, f"{tmp_path}/kept", per_wave=2))
    assert model.calls() == 5 and second == first  # only the failed one is asked about again
    Path(tmp_path, "mended").touch()
    third = rows_by_id(generation.justify_once(papers, "t", model, f"{tmp_path}/kept"))
    assert third["PAPER_1"]["error"] is None and model.calls() == 6
    again = generation.justify_once(papers, "t", model, f"{tmp_path}/kept")
    assert rows_by_id(again) == third and again.count() == 4 and model.calls() == 6
    changed = papers.withColumn("score_final", F.when(F.col("paper_id") == "PAPER_2", 5).otherwise(4))
    generation.justify_once(changed, "t", model, f"{tmp_path}/kept").collect()
    assert model.calls() == 7


def test_no_prompts(spark, tmp_path):
    model = CountingGenerator(tmp_path)
    assert generation.justify_once(asked(spark, ["x"]).limit(0), "t", model, f"{tmp_path}/kept").collect() == []


def test_hanging_calls_are_given_up(spark, tmp_path):
    Path(tmp_path, "calls").mkdir()
    model = CountingGenerator(tmp_path / "calls", seconds=60.0)
    papers = asked(spark, ["hanging one", "fine one", "hanging two", "fine two"]).coalesce(1)
    start = time.monotonic()
    calls = generation.Calls(seconds=1.0, together=4)
    got = rows_by_id(generation.justify_batch(papers, "t", model, calls))
    assert time.monotonic() - start < 40
    assert got["PAPER_0"]["error"] == got["PAPER_2"]["error"] == "TimeoutError: no answer within 1 s"
    assert got["PAPER_1"]["error"] is None and got["PAPER_3"]["justification"].startswith("about fine")


def test_calls_run_together_and_stay_in_order():
    def piece(i):
        def work():
            time.sleep(0.2)
            if i == 3:
                raise TimeoutError("own")
            return i

        return work

    start = time.monotonic()
    got = list(generation.each_within([piece(i) for i in range(8)], generation.Calls(None, 8)))
    assert time.monotonic() - start < 1.0
    assert [x for x in got if isinstance(x, int)] == [0, 1, 2, 4, 5, 6, 7] and str(got[3]) == "own"


# rescore


@pytest.mark.parametrize("mode", ["none", "gold_only", "all"])
def test_rescore_job(spark, tmp_path, mode):
    corpus, objects = build(spark, tmp_path)
    Path(tmp_path, "calls").mkdir()
    model = CountingGenerator(tmp_path / "calls")
    old = rows_by_id(corpus.read(spark, "papers"))
    version = rescore_job(spark, corpus, "j", Rescore(AFTER, justify=mode, generator=model, objects=objects, embedder=EMBEDDER))
    want = rows_by_id(rescore(corpus.read(spark, "papers", 1), AFTER, keep_inputs=True, embedder=EMBEDDER))
    got = rows_by_id(corpus.read(spark, "papers", version))
    chosen = {i for i, r in want.items() if mode == "all" or (mode == "gold_only" and r["score_final"] >= 4)}
    files = {str(p.relative_to(objects)) for p in Path(objects).rglob("*.pdf")}
    for i, r in got.items():
        expected = want[i]["minio_key"] and f"tiers/{want[i]['tier']}/{i}.pdf"
        if i == "PAPER_7":
            expected = old[i]["tier_minio_key"]  # its file is lost
        else:
            assert {k for k in files if k.endswith(f"/{i}.pdf") and k.startswith("tiers")} == ({expected} - {None})
        assert r["tier_minio_key"] == expected
        assert (r["justification"] is not None) == (i in chosen)
        for c in want[i]:
            if c not in ("tier_minio_key", "justification"):
                assert r[c] == want[i][c], (i, c)
    assert rows_by_id(corpus.read(spark, "papers", 1)) == old
    placed = read_placement(spark, corpus.read(spark, "placement", version), "paper_id string")
    assert {r.paper_id: r.tier for r in placed.collect()} == {
        i: r["tier_minio_key"].split("/")[1] for i, r in got.items() if r["tier_minio_key"]
    }
    assert model.calls() == len(chosen)
    log = job_latest_state(read_job_log(spark, corpus)).collect()
    assert [(r.job_id, r.status, r.stage, r.processed) for r in log] == [("j", "completed", "24/24", 24)]
    # done already: nothing is made or asked again
    assert rescore_job(spark, corpus, "j", Rescore(AFTER, justify=mode, generator=model, objects=objects, embedder=EMBEDDER)) == version
    assert corpus.current(spark) == version and model.calls() == len(chosen)


def test_killed_rescore_resumes(spark, tmp_path, monkeypatch):
    corpus, objects = build(spark, tmp_path)
    switch = Path(tmp_path, "switch")
    what = Rescore(AFTER, reextract=True, objects=objects, embedder=OnceBrokenEmbedder(switch))
    with pytest.raises(Exception, match="model is gone"):
        rescore_job(spark, corpus, "j", Rescore(AFTER, objects=objects, embedder=OnceBrokenEmbedder(switch)))
    assert corpus.current(spark) == 1
    states = job_latest_state(read_job_log(spark, corpus)).collect()
    assert [(r.status, r.stage) for r in states] == [("failed", "fit_tfidf 24/24")]
    assert states[0].error
    switch.touch()

    # dies after the version is published, before that is marked
    put = Marks.put

    def dying(self, spark, name, **facts):
        if name == "published":
            raise KeyboardInterrupt
        put(self, spark, name, **facts)

    monkeypatch.setattr(Marks, "put", dying)
    with pytest.raises(KeyboardInterrupt):
        rescore_job(spark, corpus, "k", what)
    monkeypatch.setattr(Marks, "put", put)
    assert corpus.current(spark) == 2
    assert rescore_job(spark, corpus, "k", what) == 2
    got = rows_by_id(corpus.read(spark, "papers", 2))
    assert all(("vines" in r["text"]) == (r["minio_key"] is not None and i != "PAPER_7") for i, r in got.items())
    # its base is gone: another job was first
    with pytest.raises(Conflict):
        rescore_job(spark, corpus, "j", Rescore(AFTER, objects=objects, embedder=EMBEDDER))


def test_reextraction_updates_statistics(spark, tmp_path):
    corpus, objects = build(spark, tmp_path)
    rescore_job(spark, corpus, "plain", Rescore(AFTER, embedder=EMBEDDER))
    version = rescore_job(spark, corpus, "again", Rescore(AFTER, reextract=True, objects=objects, embedder=EMBEDDER))
    papers = corpus.read(spark, "papers", version)
    want = term_statistics(papers.select("text"))
    assert sorted(map(tuple, corpus.read(spark, "statistics", version).collect())) == sorted(map(tuple, want.collect()))


def test_rescore_of_nothing(spark, tmp_path):
    corpus, objects = build(spark, tmp_path)
    empty = Versions(f"{tmp_path}/empty")
    create_corpus(spark, empty, corpus.read(spark, "papers").limit(0))
    assert rescore_job(spark, empty, "j", Rescore(AFTER, objects=objects)) == 1
    assert [(r.status, r.stage) for r in read_job_log(spark, empty).collect()] == [("completed", "0/0")]


def test_rescore_is_checked():
    for wrong in (dict(justify="some"), dict(justify="all"), dict(reextract=True)):
        with pytest.raises(ValueError):
            Rescore(AFTER, **wrong)


# import


def test_import_job(spark, tmp_path):
    corpus, _ = build(spark, tmp_path)
    inbox, objects = Path(tmp_path, "in"), f"{tmp_path}/more"
    inbox.mkdir()
    Path(tmp_path, "calls").mkdir()
    for i in range(9):
        Path(inbox, f"{i}.pdf").write_text(page(i, "plants"))
    model = CountingGenerator(tmp_path / "calls")
    what = Import(AFTER, objects, limit=6, justify="auto", generator=model, embedder=EMBEDDER)
    version = import_job(spark, corpus, str(inbox), "i", what)
    new = corpus.read(spark, "papers", version).where("year = 2019").orderBy("paper_id").collect()
    assert [r.paper_id for r in new] == [f"PAPER_{i}" for i in range(25, 31)]
    assert all(r.justification for r in new) and model.calls() == 6
    assert corpus.read(spark, "papers", 1).count() == 24 and corpus.read(spark, "papers", version).count() == 30
    whole = corpus.read(spark, "papers", version)
    want = term_statistics(whole.select(F.coalesce("text", "title").alias("text")))
    assert sorted(map(tuple, corpus.read(spark, "statistics", version).collect())) == sorted(map(tuple, want.collect()))
    log = job_latest_state(read_job_log(spark, corpus)).collect()
    assert [(r.type, r.status, r.stage) for r in log] == [("import_batch", "completed", "6/6")]
    with pytest.raises(FileNotFoundError):
        import_job(spark, corpus, str(tmp_path / "calls"), "none", what)
    # a rescore goes on from the longer corpus, with its vocabulary
    after = rescore_job(spark, corpus, "r", Rescore(BEFORE, embedder=EMBEDDER))
    again = rescore(corpus.read(spark, "papers", version), BEFORE, embedder=EMBEDDER)
    scores = lambda df: {r.paper_id: r.score_breakdown for r in df.collect()}
    assert scores(corpus.read(spark, "papers", after)) == scores(again)
    assert corpus.read(spark, "papers", after).where(score_to_tier(F.col("score_final")) != F.col("tier")).count() == 0


# vectors


class CountingEmbedder:
    """Notes each text it embeds in a folder."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __eq__(self, other):
        return type(self) is type(other) and self.folder == other.folder

    def __hash__(self):
        return hash(self.folder)

    def __call__(self):
        def encode(texts):
            if any("poison" in t for t in texts):
                raise ValueError("cannot embed")
            for t in texts:
                Path(self.folder, f"{time.time_ns()}-{hashlib.md5(t.encode()).hexdigest()}").touch()
            return [[float(len(t)), 1.0] for t in texts]

        return encode


def test_no_text_is_embedded_twice(spark, tmp_path):
    Path(tmp_path, "calls").mkdir()
    model, store = CountingEmbedder(tmp_path / "calls"), VectorStore(f"{tmp_path}/vectors")
    rows = [(i, ("same", "other", "poison", "", None, "kept")[i % 6], [9.0] if i % 6 == 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, embedding array<float>").repartition(5)

    def vectors(frame):
        return {r.id: r.embedding for r in frame.collect()}

    want = {i: {"same": [4.0, 1.0], "other": [5.0, 1.0], "kept": [9.0]}.get(t) for i, t, _ in rows}
    assert vectors(store.backfill(df, model)) == want
    assert len(list(Path(tmp_path, "calls").iterdir())) == 2
    assert vectors(store.backfill(df, model)) == want
    assert len(list(Path(tmp_path, "calls").iterdir())) == 2
    more = spark.createDataFrame([(0, "same", None), (1, "new", [])], df.schema)
    assert vectors(store.backfill(more, model)) == {0: [4.0, 1.0], 1: [3.0, 1.0]}
    assert len(list(Path(tmp_path, "calls").iterdir())) == 3
    assert store.backfill(df.limit(0), model).collect() == []
