"""Small tables with the cases every operator has to handle, and plain versions of text rules."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["the", "on", "er", "ti", "ha", "es", "lo", "mi", "ka", "ru", "do", "be"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 5))) for _ in range(n)]


def documents(seed: int = 1, n: int = 120) -> list[tuple]:
    """Rows of documents: prose, copies, near copies, shared passages, odd texts, repeated rows, nulls."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts: list[str | None] = []
    for i in range(n):
        body = prose(rng, rng.choice([3, 15, 60, 150, 400]))
        if i % 7 == 0:
            at = rng.randrange(len(body))
            body[at:at] = passage
        if i % 11 == 3:
            body = body * 2
        texts.append(" ".join(body).capitalize())
        if i % 5 == 0 and texts:
            near = texts[rng.randrange(len(texts))].split(" ")
            for _ in range(max(1, len(near) // 60)):
                near[rng.randrange(len(near))] = rng.choice(prose(rng, 3))
            texts.append(" ".join(near))
        if i % 13 == 0:
            texts.append(texts[rng.randrange(len(texts))])
    texts += [None, "", "   \n\t ", "one", "two words", "One", "a\x0bb\x0cc\rd", "éàü ñandú 中文 words here", "x" * 5000, " ".join(prose(rng, 6000)), "12 34 !! 56"]
    rows = [
        (i, t, [None, "en", "fr"][i % 3], [None, "a", "b", "a", "a", "é"][i % 6], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return [*rows, (None, "no id at all", "en", "a", 12), (None, None, None, None, None), rows[4], rows[4]]
