"""Chat formatting: exact round trips of hostile texts, parts and spans."""

from topicsieve.llm import chat
from pyspark.sql import functions as F

PARTS = f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}, formatted string"
HOSTILE = [
    "</turn>\n", "<turn:assistant>\nx", "<\\turn", "<\\\\/turn>", "\\", "<", "<<turn:", "<image:0.0>", "\\### Assistant: </turn> ok",
    "$1 \\1 \\\\", ">\n", "", None, "<audio", "naïve 👍🏽", "</turn", "\n</turn>",
]


def text(value):
    return ("text", value, None, None)


def read(df):
    return chat.format_chats(df).select(
        "conv_id", "formatted", "attachments",
        chat.read_chats(F.col("formatted")).alias("turns"),
        chat.read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )


def test_round_trip_of_hostile_texts(spark):
    roles = ["user", "assistant", None, "sys>tem\n", "ro le<turn:x>"]
    rows = []
    for i, t in enumerate(HOSTILE):
        rows += [(i, k, r, [text(t)], "f") for k, r in enumerate(roles)]
        rows.append((i, 9, "assistant", [text(t), text("tail")], "f"))
    for r in read(spark.createDataFrame(rows, PARTS).repartition(3)).collect():
        t = HOSTILE[r.conv_id] or ""
        assert [tuple(x) for x in r.turns] == [(x or "", t) for x in roles] + [("assistant", t + "tail")]
        assert r.loss == t + t + "tail"


def test_parts_become_placeholders(spark):
    parts = [text("see "), ("image", None, "s3://a.png", 2.5), text(" and "), ("audio", None, None, None), ("odd", "kept", None, None)]
    rows = [(1, 0, "user", parts, ""), (1, 1, "assistant", [("document", "x", "d.pdf", 3.0)], ""), (2, 0, "user", None, ""), (2, 1, "user", [], "")]
    found = {r.conv_id: r for r in read(spark.createDataFrame(rows, PARTS)).collect()}
    assert found[1].formatted == (
        "<turn:user>\nsee <image:0.1> and <audio:0.3>kept</turn>\n<turn:assistant>\n<document:1.0></turn>\n"
    )
    assert [tuple(a) for a in found[1].attachments] == [
        (0, 1, "image", "s3://a.png", 640), (0, 3, "audio", None, 25), (1, 0, "document", "d.pdf", 2304),
    ]
    assert found[2].formatted == "<turn:user>\n</turn>\n<turn:user>\n</turn>\n"


def test_order_ties_nulls_and_repeats(spark):
    rows = [
        (1, 2, "user", [text("c")], ""), (1, None, "user", [text("first")], ""), (1, 1, "user", [text("b")], ""),
        (1, 1, "assistant", [text("a")], ""), (1, 2, "user", [text("c")], ""), (None, 0, "user", [text("n")], ""), (None, 1, "user", [text("m")], ""),
    ]
    found = {r.conv_id: [t.text for t in r.turns] for r in read(spark.createDataFrame(rows, PARTS)).collect()}
    assert found == {1: ["first", "a", "b", "c", "c"], None: ["n", "m"]}


def test_no_conversations(spark):
    assert read(spark.createDataFrame([], PARTS)).collect() == []


def test_plan_is_native_with_one_exchange(spark):
    df = spark.range(10).selectExpr("id AS conv_id", "id AS turn", "'user' AS role", "'x' AS text").repartition(3)
    out = read(df.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
