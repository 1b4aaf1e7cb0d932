"""Rows that every operator has to bear: nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, fp string, start string, kept string, node string, __id long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "re", "ti", "on", "er", "st", "ou", "li"]) for _ in range(r.randint(1, 4))) for _ in range(n))


TEXTS = [
    None, "", " \n\t ", "one", "two words", prose(1, 400), prose(1, 400), prose(2, 60) + "\n" + prose(2, 60),
    prose(3, 30_000), "\n".join([prose(4, 12)] * 9), "###***%%% " * 40, "a\x00b \x1c c   d   e  f   g",
    "日本語のテキスト \U0001F469‍\U0001F469 ß É K İ", "password = \"" + "x1" * 10 + "\" token=abc AKIA" + "Z9" * 10 + " " + "0f" * 12,
    "Licensed under CC BY-NC 4.0. All Rights Reserved. GNU General Public License", "<|endoftext|> ### </turn> \\### " + prose(5, 80),
]


def documents(spark, texts=None):
    rows = [(i, t, "en" if i % 3 else None, "src0", None if t is None else len(t), "x", "x", "x", "x", "x", 1) for i, t in enumerate(TEXTS if texts is None else texts)]
    rows += [rows[5], (None, prose(6, 70), "xx", None, 7, "x", "x", "x", "x", "x", 1), (None, None, None, None, None, None, None, None, None, None, None)] if texts is None else []
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
