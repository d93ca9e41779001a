"""Small tables with every awkward case."""

import random

DOCS = "doc_id long, text string, lang string, source string, kept boolean, component_id long, text_sha256 string"
WORDS = [a + b for a in ("ba", "do", "ki", "lu", "me", "ra", "so", "ti", "vo") for b in ("len", "mir", "nost", "pra", "rus", "tal", "vek", "zan")]


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    words = [draw.choice(WORDS) + draw.choice(["", "", "a", "en", "os"]) + draw.choice(["", "", "", "", ",", "."]) for _ in range(n)]
    return " ".join(words) + "."


def documents(spark, texts, ids=None):
    """Documents with columns whose names operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "xx", "src", True, -1, "clash") for i, t in zip(ids, texts)], DOCS)


def edited(text: str, share: float, seed: int) -> str:
    draw, words = random.Random(seed), text.split()
    for _ in range(int(share * len(words))):
        words[draw.randrange(len(words))] = f"edit{draw.randrange(10**9)}"
    return " ".join(words)


AWKWARD = [None, "", " ", "\n\t ", "word", "WORD", "word", "one two", " one  two ", prose(30_000, 5), "é ü \x0b\x0cz", "\x00 nul", "."]
