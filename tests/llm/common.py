"""Inputs that every operator must stand: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

WORDS = "the of and river stone green idea table paper window garden night morning letter".split()
SCHEMA = "doc_id long, text string, k string, id long, t string, name string, n string, text_ string"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "s", "er"]) for _ in range(n))


def rows() -> list[tuple]:
    texts = [
        None, "", " \t\n", "one", "One", "one two", prose(1, 40), prose(1, 40), prose(1, 39) + " other", prose(2, 60),
        "First line\n" + prose(3, 30) + "\nFIRST LINE \nlast", "first line", "été Été ÑÑ　x \U0001f600  y",
        prose(4, 6000), "a" * 3000, "x\r\ny\x0bz\x1c", "<|endoftext|> <s> ▁a▁▁b",
    ]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(6, prose(1, 40)), (None, "one two"), (None, None), (9, prose(2, 60) + " more"), (-5, prose(1, 40))]
    return [(i, t, "k", 7, "t", "name", "n", "x") for i, t in out]


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(3)
