"""Rows that every operator on documents has to take."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, ids string, line_hash string, offset int"

LONG = " ".join(f"word{i % 977}, Straße{i % 13}" for i in range(30_000))
TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "Hello world. Hello  world.\tHello\nworld", "hello WORLD again and again and again",
    "The same long line of words\nanother one that is long\nshort", "  the same long line of words \r\nshort",
    "<|endoftext|> is ordinary <|startoftext|>text<|endoftext|>", "\\### Assistant: </turn> ok", "naïve café ÀÉÎ ǅ İstanbul ſ ß",
    "日本語 テキスト 👍🏽 é   nbsp   wide\x1cfs \x85 nel", "don't I'LL we've 'S 12345 3.14 !!! ??? %%% a.b,c",
    "trailing space ", " leading", "tab\tseparated \t values", "x" * 5_000, LONG, LONG, LONG + " end", None, "", "a",
]


def rows():
    out = [
        (i, text, "en", "src0", None if text is None else len(text), "x", "y", "z", 1)
        for i, text in enumerate(TEXTS)
    ]
    repeated = [(5, "a", "de", "src1", 1, None, None, None, None)] * 2
    nameless = [(None, t, None, None, None, None, None, None, None) for t in ("a", None, "only here")]
    return out + repeated + nameless


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
