"""Small inputs that the tests of this folder share."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, x string, label int, score double, spans string, shard int"


def rows(texts):
    """Documents with extra columns whose names the operators use themselves."""
    return [(i, t, "en" if i is None or i % 3 else None, f"s{0 if i is None or i % 2 else 1}", None if t is None else len(t), 7, "x", 1, 0.5, "q", 3) for i, t in texts]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    """Nulls, empty and blank texts, short and very long ones, ties and repeated rows."""
    rnd = random.Random(11)
    base = prose(rnd, 120)
    passage = prose(rnd, 40, 5000)
    near = base.split(" ")
    near[60] = "changed"
    texts = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "One TWO"), (5, base), (6, base), (7, " ".join(near)), (8, base.upper()), (9, "Ünï cödé 日本 " * 20)]
    texts += [(10 + i, prose(rnd, 30) + " " + passage + " " + prose(rnd, 20)) for i in range(40)]
    texts += [(60, prose(rnd, 30_000, 3000)), (61, "a" * 50_000), (5, base), (62, "the&&& of$$$ and### " * 30), (63, "x y z\n" * 40), (64, "ÀÉ " + base)]
    return texts
