from __future__ import annotations

import random
import re

import pytest

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(rng: random.Random, n: int) -> str:
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.choice((1, 1, 2, 3, 4)))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, copies, ties, a very long text, repeated rows and columns with clashing names."""
    rng = random.Random(3)
    base = prose(rng, 120)
    words = base.split()
    rows = [(1, base), (2, base), (2, base), (3, " ".join([*words[:60], "zzz", *words[61:]])), (4, None), (5, ""), (6, " \n\t"), (7, "word"), (8, "word"), (9, "two words"), (None, "nobody owns this"), (None, base), (10, prose(rng, 20_000)), (11, base.upper()), (12, "é" * 50 + " x"), (13, prose(rng, 300))]
    full = [(i, t, "en", "src0", len(t or ""), 1, 2, "k", "h") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, h int, id int, kept string, v string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
