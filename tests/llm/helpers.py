"""Inputs that every operator must survive."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, fp string, score string, n_tokens string, s string"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 7))) for _ in range(words))


def hard_rows() -> list[tuple]:
    """Nulls, empties, blanks, a long text, repeated rows, odd characters; with columns whose names clash."""
    texts = [None, "", " \n\t ", prose(1, 30000), "x" * 200_000, prose(2, 60), prose(2, 60), "a  b\n\nc ▁ d\x85e　f <|endoftext|> <s> 🙂 É", prose(3, 25) + " #", "one two"]
    rows = [(k, t, "en" if k % 2 else None, f"src{k % 3}" if k % 4 else None, None, "k", "r", "f", "s", "n", "z") for k, t in enumerate(texts)]
    rows += [rows[5], (None, prose(2, 60), "en", "src1", 1, "k", "r", "f", "s", "n", "z"), (None, None, None, None, None, None, None, None, None, None, None)]
    return rows


def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
