"""Small corpora and brute-force versions for the tests of the training-data operators."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def corpus(seed: int = 1, groups: int = 12) -> list[tuple]:
    """Unique, copied and edited texts, shared lines and passages, null and empty texts."""
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("wa", "Lo", "éi", "st", "un") for b in range(60)] + ["the", "of", "and"]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    line = "Shared line of words that many texts hold, " + rnd.choice(vocabulary)
    texts = [None, "", " \n\t", "one", "Two words", "two  WORDS", "###" * 20, "\n", "x\n" * 30, "a" * 700]
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 30, 90, 200, 700]))]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 3, 20])):
                own[rnd.randrange(len(own))] = f"edit{rnd.randrange(10 ** 6)}"
            text = " ".join(own)
            if rnd.random() < 0.4:
                text = text.replace(" the ", "\n") + "\n" + rnd.choice([line, line.upper(), f"  {line}\t"])
            if rnd.random() < 0.3:
                cut = text.find(" ")
                text = text[:cut] + " " + passage + text[cut:]
            texts.append(text)
    texts.append(texts[-1])
    rows = [(i * 3, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows


def crowd(n: int = 40, words: int = 60, seed: int = 4) -> list[tuple]:
    """A group of near copies and a group of exact copies."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        if i % 2:
            own[rnd.randrange(words)] = f"edit{i}"
        rows.append((1000 + i, " ".join(own), "en", "src0", 0))
    return rows
