"""Chat conversations: ordered message lists and batch completion."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicsieve.operators.generation import (
    CHAT_CALLS,
    Answer,
    Calls,
    Generator,
    Reply,
    describe,
    each_within,
    generation_ms,
    reply_function,
    session,
)

# Message roles.
ROLES = ("system", "user", "assistant")

DEFAULT_MODEL = "template"
REPLY_COLUMNS = ["conv_id", "message", "ns", "eval_count", "error"]
PART_TURNS = 256


def bad_role() -> Column:
    return ~F.coalesce(F.col("role").isin(*ROLES), F.lit(False))


def assemble_conversations(messages: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Ordered messages per conversation: (conv_id, part, messages, n_messages, bad_roles).

    A conversation comes in parts of ``part_turns`` turn numbers, so that even one
    holding a third of all messages becomes many bounded arrays on many tasks.
    Ordinary conversations have the single part 0.
    """
    message = F.struct("turn", "role", F.col("text").alias("content"))
    return messages.groupBy("conv_id", F.floor(F.col("turn") / part_turns).alias("part")).agg(
        F.sort_array(F.collect_list(message)).alias("messages"),
        F.count("*").alias("n_messages"),
        F.count_if(bad_role()).alias("bad_roles"),
    )


def answer_conversations(
    messages: DataFrame, generator: Generator, model: str | None = None, calls: Calls = CHAT_CALLS
) -> DataFrame:
    """One reply row per conversation, errors included; none is refused for its size.

    Messages are sorted by conversation and turn within partitions and fed to the
    model one after the other, so a task holds one Arrow batch and whatever the model
    keeps of the conversation: one without ``start`` is given all messages at once, and
    its worker holds them until then. A conversation with an unknown role gets an error
    row, as does one whose reply takes too long.
    Messages without a conversation form one of their own; equal turns are taken by
    role and text.
    """
    spoken = messages.select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), bad_role().alias("bad_role")
    )
    ordered = spoken.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reply = reply_function(generator)
        open_chat: Chat | None = None
        at = None
        for batch in batches:
            rows = []
            keys = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
            for key, role, text, is_bad in zip(keys, batch["role"], batch["text"], batch["bad_role"]):
                if open_chat is None or key != at:
                    if open_chat is not None:
                        rows.append((at, *open_chat.finish()))
                    at, open_chat = key, Chat(reply, calls)
                open_chat.add(role, text, bool(is_bad))
            yield pd.DataFrame(rows, columns=REPLY_COLUMNS)
        if open_chat is not None:
            yield pd.DataFrame([(at, *open_chat.finish())], columns=REPLY_COLUMNS)

    key_type = messages.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key_type}, message string, ns bigint, eval_count bigint, error string"
    return (
        ordered.select("conv_id", "role", "text", "bad_role")
        .mapInPandas(complete, schema)
        .withColumn("model", F.lit(model or DEFAULT_MODEL))
        .withColumn("total_duration_ms", generation_ms(F.col("ns")))
        .drop("ns")
    )


class Chat:
    """One conversation on its way to the model; a failure stays with it."""

    def __init__(self, reply: Reply, calls: Calls):
        self.session, self.calls = None, calls
        self.error: str | None = None
        self._try(lambda: setattr(self, "session", session(reply)))

    def _try(self, call):
        try:
            return call()
        except Exception as failure:  # any failure of a model belongs to its conversation
            self.error = self.error or describe(failure)
            return None

    def add(self, role: str | None, text: str, is_bad: bool) -> None:
        if is_bad:
            self.error = self.error or "unknown role"
        if self.error is None:
            self._try(lambda: self.session.add({"role": role, "content": text}))

    def finish(self) -> tuple[str | None, int | None, int | None, str | None]:
        answer = self._try(self._reply) if self.error is None else None
        if self.error is not None or answer is None:
            return None, None, None, self.error
        return answer.text.strip(), answer.nanoseconds, answer.eval_count, None

    def _reply(self) -> Answer:
        (answer,) = each_within([self.session.finish], self.calls)
        if isinstance(answer, Exception):
            raise answer
        return answer
