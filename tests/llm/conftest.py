from __future__ import annotations

import random

import pytest

from samplecraft.plans.staging import set_local_folder


@pytest.fixture(scope="session", autouse=True)
def shared(spark):
    set_local_folder(spark)


def sentence(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


def corpus(seed: int = 5, groups: int = 6) -> list[tuple]:
    """(doc_id, text): groups of near and exact copies, loners, and every awkward text."""
    rng = random.Random(seed)
    texts: list = []
    for _ in range(groups):
        base = sentence(rng, rng.randint(40, 120))
        texts.append(" ".join(base))
        texts.append(" ".join(base))
        for edits in (1, 2, 4, 12):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "xyz" + str(rng.randrange(99))
            texts.append(" ".join(copy))
        texts.append(" ".join(sentence(rng, 60)))
    texts += ["", None, "  \n ", "one", "one two three", "one two three", "é ü ß\n\nñ", "x" * 5000, " ".join(sentence(rng, 20000))]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


#: Names that operators use inside.
CLASHING = "text_ string, key string, node long, words string, lines int, cell int, class_id string, place int, w int, at int, _line_ int, start int"


def awkward(spark, rows, extra: bool = True):
    """A documents table with repeated rows, a null key and columns of clashing names."""
    rows = [*rows, *rows[:2], (None, "a text without a key"), (None, None)]
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    rows = [(*r, "t", None, 1, "w", 2, 3, "c", 4, 5, 6, 7, 8) for r in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")
