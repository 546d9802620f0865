from __future__ import annotations

import random

import pytest

SEPARATORS = (" ", "  ", "\n", "\t", "\x0b", " \n\n ")


def prose(rnd: random.Random, words: int, vocabulary: list[str]) -> str:
    return "".join(rnd.choice(vocabulary) + rnd.choice(SEPARATORS) for _ in range(words))


@pytest.fixture(scope="package")
def corpus():
    """(doc_id, text, lang, source): copies, near copies, shared passages, long, empty and null texts, hot groups."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéßxyz") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    base = [prose(rnd, 120, vocabulary) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        kind = i % 5
        if kind == 0:
            text = base[i % 6]
        elif kind == 1:
            at = rnd.randrange(len(words))
            text = " ".join([*words[:at], "Changed", *words[at + 1 :]])
        elif kind == 2:
            text = prose(rnd, 80, vocabulary) + " " + " ".join(words[20:60]) + "\n" + prose(rnd, 30, vocabulary)
        else:
            text = prose(rnd, rnd.randint(1, 150), vocabulary)
        rows.append((1000 + 7 * i, text, ("en", "de")[i % 2], f"s{min(i % 7, 3)}"))
    passage = " ".join(rnd.choice(vocabulary) for _ in range(30))
    rows += [(3000 + i, prose(rnd, 20, vocabulary) + passage + " " + prose(rnd, 20, vocabulary), "en", "hot") for i in range(50)]
    rows += [
        (1, None, "en", "s0"),
        (2, "", None, None),
        (3, " \n ", "en", "s1"),
        (4, "one two", "en", "s1"),
        (5, "One  TWO", "en", "s1"),
        (6, "na " * 30_000, "en", "s2"),
        (7, "x" * 300_000 + " " + base[0], "en", "s2"),
        (8, "é" * 120, "de", "s2"),
        (9, "é" * 130, "de", "s2"),
    ]
    return rows


@pytest.fixture(scope="package")
def frame(spark, corpus):
    """The corpus with columns whose names operators might use themselves, in several partitions."""
    rows = [(*row, "kept", 7) for row in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, row int").repartition(5)


@pytest.fixture(scope="package")
def empty(frame):
    return frame.limit(0)
